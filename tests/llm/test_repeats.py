import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sensorlake.llm import repeats
from tests.llm.nasty import document_frame, documents, empty


def plain(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[s:s + 200] for b in data for s in range(len(b) - 199))
    out = []
    for b in data:
        lost = bytearray(len(b))
        for s in range(len(b) - 199):
            if seen[b[s:s + 200]] > 1:
                lost[s:s + 200] = b"\1" * 200
        spans = sum(lost[i] and not (i and lost[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(lost), spans, hashlib.sha256(bytes(x for x, k in zip(b, lost) if not k)).hexdigest()))
    return out


def check(spark, rows):
    found = repeats.remove_repeats(document_frame(spark, rows)).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, plain([r[1] for r in rows])))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)
    return sum(r["n_removed"] for r in found)


def test_nasty_documents(spark):
    assert check(spark, [r if len(r[1] or "") < 50_000 else (r[0], r[1][:20_000], *r[2:]) for r in documents()]) > 1000


@pytest.mark.parametrize("seed,members", [(0, 2048), (1, 2048), (2, 2048), (2, 4), (0, 1)])
def test_planted_passages(spark, seed, members, monkeypatch):
    """Passages of about the length that counts, cut at every place, in
    texts of few letters; periodic texts; overlaps of several passages."""
    monkeypatch.setattr(repeats, "MEMBERS", members)
    rng = random.Random(seed)
    text = lambda n, letters="ab": "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n, "abcdefgh") for n in (190, 199, 200, 201, 230, 400, 900)]
    rows = []
    for i in range(70):
        p = rng.choice(passages)
        a, b = sorted(rng.sample(range(len(p) + 1), 2)) if i % 3 else (0, len(p))
        q = rng.choice(passages)
        rows.append((i, text(rng.randrange(300), "abcdefgh") + p[a:b] + (text(rng.randrange(3), "xyz") + q if i % 4 == 0 else "") + text(rng.randrange(300), "abcdefgh"), None, None))
    rows += [(100, "ab" * 300, None, None), (101, "ba" * 150, None, None), (102, "x" * 200, None, None), (103, "y" * 201, None, None), (104, "é" * 120 + text(50), None, None), (105, "é" * 101, None, None)]
    rows += [(106, passages[6] + passages[6], None, None), (107, passages[5][:-1], None, None)]
    assert check(spark, rows) > 1000


def test_long_texts_are_cut_with_an_overlap(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = "".join(map(chr, rng.integers(97, 123, 3000)))
    texts = [base, base[500:1900] + "!" * 150, "?" + base[1200:1399], "?" + base[1200:1400]]
    monkeypatch.setattr(repeats, "PIECE", 256)
    want = set()
    for row, place, ids in repeats.anchors([t.encode() for t in texts]):
        want |= set(zip(row.tolist(), place.tolist(), ids.tolist()))
    monkeypatch.setattr(repeats, "PIECE", 1 << 20)
    got = set()
    for row, place, ids in repeats.anchors([t.encode() for t in texts]):
        got |= set(zip(row.tolist(), place.tolist(), ids.tolist()))
    assert got == want


def test_every_string_has_an_anchor_and_equal_ones_the_same():
    rng = np.random.default_rng(1)
    t = bytes(rng.integers(97, 100, 4000, dtype=np.uint8))
    (_, place, _), = repeats.anchors([t])
    for s in range(0, len(t) - 199, 7):
        assert ((place >= s) & (place <= s + 150)).any()
    (_, moved, _), = repeats.anchors([b"#" * 333 + t])
    assert set(place + 333) <= set(moved)


def test_identifiers_tell_orders_apart():
    rng = np.random.default_rng(2)
    base = rng.integers(97, 99, 200, dtype=np.uint8)
    rows = [base] + [np.roll(base, k) for k in range(1, 200)]
    for _ in range(3000):
        x = base.copy()
        i, j = rng.integers(0, 200, 2)
        x[[i, j]] = x[[j, i]]
        rows.append(x)
    for n in (50, 200):
        for of in (0, 1):
            values = {}
            for x in rows:
                values.setdefault(int(repeats.identifiers(x[:n], n, of)[0]), set()).add(x[:n].tobytes())
            assert all(len(v) == 1 for v in values.values())


def test_empty_table(spark):
    assert repeats.remove_repeats(empty(document_frame(spark))).count() == 0
