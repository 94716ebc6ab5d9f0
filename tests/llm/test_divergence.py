import random
import re
from collections import Counter, defaultdict

import pytest

from sensorlake.llm import divergence as dv
from sensorlake.llm.common import Scratch
from tests.llm.nasty import document_frame, documents, empty

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain(rows, least, top=50):
    """Brute force, in Python's integers."""
    docs = [((lang or ""), (source or ""), [lower(x) for x in TERM.findall(text or "")]) for _, text, lang, source in rows]
    held, groups = defaultdict(Counter), sorted({(a, b) for a, b, _ in docs})
    for lang, _, terms in docs:
        held[lang].update(set(terms))
    out = []
    for lang in sorted({a for a, _ in groups}):
        kept = [t for t, n in held[lang].items() if n >= least]
        count = {s: Counter() for a, s in groups if a == lang}
        for a, s, terms in docs:
            if a == lang:
                count[s].update(t for t in terms if t in set(kept))
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        of = {s: p(c) for s, c in count.items()}
        q = p(sum(count.values(), Counter()))
        for s in of:
            found = {"pair": [(x, sum(abs(of[s][t] - of[x][t]) for t in kept)) for x in of if x != s],
                     "term": [(t, of[s][t] - q[t]) for t in kept if count[s][t] and of[s][t] > q[t]]}
            for part, items in found.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


def rows():
    rng = random.Random(3)
    out = documents()
    letters = ["Ab", "ab", "abc", "b", "É", "é", "éa", "日本", "日", "İ", "zeta", "z", "x²", "don't", "a_b"]
    for i in range(200):
        lang = rng.choice(["en", "de", "xx", None])
        source = rng.choice(["a", "b", "é", "z", None, ""])
        out.append((9000 + i, " ".join(rng.choice(letters) + rng.choice(["", "s", "1", "x"]) for _ in range(rng.randrange(0, 40))), lang, source))
    out += [(9900, "lonely words", "only", "a"), (9901, "others", "only", "b"), (9902, None, "only", "c"), (9903, "one", "single", "a")]
    return out


@pytest.mark.parametrize("shard,most", [(500_000, 1 << 28), (7, 1500)])
def test_as_brute_force(spark, shard, most):
    """Also with many transducers and several passes over the texts."""
    data = rows()
    got = dv.divergence(document_frame(spark, data), least_docs=5, shard=shard, most=most)
    want = plain(data, 5)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "only" and r[4] == 0 for r in want)


def test_narrow_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(dv, "CELLS", 40)
    data = rows()
    assert sorted(tuple(r) for r in dv.divergence(document_frame(spark, data), least_docs=5, top=3).collect()) == plain(data, 5, 3)


def test_transducer():
    rng = random.Random(1)
    strings = sorted({bytes(rng.choice(b"abc\xc3") for _ in range(rng.randrange(1, 9))) for _ in range(3000)})
    t = dv.Transducer.load(dv.Transducer.build(strings).dump())
    assert t.ordinals(strings).tolist() == list(range(len(strings)))
    assert [t.string(i) for i in range(len(strings))] == strings
    other = [s for s in (bytes(rng.choice(b"abcd") for _ in range(rng.randrange(0, 9))) for _ in range(3000)) if s not in set(strings)]
    assert set(t.ordinals(other).tolist()) == {-1}
    # minimal: states are as many as distinct sets of suffixes
    suffixes = defaultdict(set)
    for s in strings:
        for i in range(len(s) + 1):
            suffixes[s[:i]].add(s[i:])
    assert len(t.final) == len({frozenset(x) for x in suffixes.values()})
    few = dv.Transducer.build([b"a"])
    assert few.ordinals([b"a", b"", b"aa", b"b"]).tolist() == [0, -1, -1, -1]


def test_probability_is_exact_for_large_counts(spark):
    big = 9 * 10**13
    got = spark.sql("select 1").select(dv.probability(str(big), str(10**14), "77")).first()[0]
    assert got == 1 + 10**9 * (big + 5) // (10**14 + 5 * 77)


def test_no_documents_and_no_terms(spark):
    assert dv.divergence(empty(document_frame(spark))).count() == 0
    got = dv.divergence(document_frame(spark, [(1, "a", "en", "x"), (2, "b", "en", "y"), (3, None, None, None)]), scratch=Scratch(spark, "t"))
    assert sorted(tuple(r) for r in got.collect()) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
