import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from sensorlake.llm import repair as rp
from tests.llm.nasty import CLASHING, empty

SPACES = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Brute force from the back: (cost, audit) from row i in a state, with up
    to two inserted rows before each row. ``rows``: (initial, fault)."""
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    into = {"s": 1, "u": 2, "a": 3}

    @lru_cache(None)
    def best(i, q, inserted):
        out = []
        if inserted < 3:
            c, s = best(i, into[step[q]], inserted + 1)
            out.append((c + 2, "I" + s))
        if i == len(rows):
            if q in (0, 3):
                out.append((0, ""))
        else:
            initial, fault = rows[i]
            c, s = best(i + 1, q, 0)
            out.append((c + 3, "D" + s))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                c, s = best(i + 1, into[step[q]], 0)
                out.append((c + 2 + more, "R" + s))
                if initial == step[q] or initial == "s" and q == 0:
                    c, s = best(i + 1, into[initial], 0)
                    out.append((c + more, "K" + s))
        return min(out, default=(10**9, ""))

    return best(0, 0, 0)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain(rows):
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, found in of.items():
        digest = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), digest(r)))
        seen, faults = set(), []
        for _, role, text in found:
            bare = text.rstrip(SPACES)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, *_ in found if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(found, found[1:])]
        cost, audit = cheapest(tuple((r[1][:1], f) for r, f in zip(found, faults)))
        lines, q, i = [], 0, 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else found[i][1:]
            i += edit != "I"
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                q = 1
            else:
                q = 3 if q == 2 else 2
                role = role if edit == "K" else {2: "user", 3: "assistant"}[q]
            lines.append(f"{role}:{text}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows(seed=1, conversations=150, longest=14):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "sister", "änn"]
    texts = ["Yes.", "No!", "What?", "and so", "", " \n", None, "é.", "Yes. \t", "same words. ", "." * 70 + "a", "." * 70 + "b!"]
    out = []
    for c in [*range(conversations), None]:
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(roles) if rng.random() < 0.4 else ["user", "assistant"][t % 2]
            text = f"Turn {t}." if rng.random() < 0.5 else rng.choice(texts)
            out.append((c, rng.choice([t, t * 3, None, 2**40]) if rng.random() < 0.2 else t, role, text))
    return out + out[:9] + [out[4]] * 5


def frame(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string").select("*", *[rp.F.lit(1).alias(c) for c in [*CLASHING, "kind", "seen", "prefix"]if c != "row"])


def shown(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


@pytest.mark.parametrize("tasks", [2, 37])
def test_as_brute_force(spark, tasks):
    """With many tasks most conversations are cut between them."""
    data = rows()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        assert shown(rp.repair(frame(spark, data))) == plain(data)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("piece,held", [(3, 8 << 20), (1, 8 << 20), (16_384, 10)])
def test_pieces_give_the_same(piece, held, monkeypatch):
    """The same conversation in pieces of a few rows, or without its texts."""
    monkeypatch.setattr(rp, "PIECE_ROWS", piece)
    monkeypatch.setattr(rp, "HELD", held)
    for opens in (False, True):
        for seed in range(40):
            rng = random.Random(seed)
            found = [(rng.choice("suaxuaua"), rng.choice([None, None, "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(1, 25))]
            text = {None: "a.", "truncated": "a", "blank": " ", "duplicate": "a."}
            conv, pieces = rp.Conversation(1, opens), []
            for i, (role, fault) in enumerate(found):
                told = conv.row(i, role, text[fault], fault == "duplicate")
                pieces += [told] if told else []
            told = conv.close(True)
            got = rp.chained(pieces + ([told] if told else []))
            cost, audit = cheapest(tuple(found))
            assert (got["cost"], got["audit"]) == (cost, audit)
            assert got["gaps"] == 0 and got["illegal"] == sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(found, found[1:]))


def test_compares_audits():
    rng = random.Random(5)
    nodes = [rp.Node(None, "")]
    for _ in range(600):
        nodes.append(rp.Node(rng.choice(nodes[-40:]), rng.choice(["D", "I", "K", "R", "KI", "DD"])))
    for _ in range(4000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert rp.before(a, b) == (a.tail() < b.tail())


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(rp, "MODULUS", 3)
    test_compares_audits()


def test_query_and_empty(spark, tmp_path):
    data = rows(7, 400, 9)
    frame(spark, data).write.parquet(f"{tmp_path}/conversations.parquet")
    got = shown(rp.op13_repair(spark, str(tmp_path)))
    want = plain(plain_damage(data))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, none) for c in {r[0] for r in data}}
    assert none in got.values()
    assert rp.repair(empty(frame(spark, data))).count() == 0


def test_whole_table(spark):
    data = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain(plain_damage(data))
    got = shown(rp.op13_repair(spark, "/root/testdata/sf0.01"))
    assert {c: v for c, v in got.items() if c in want} == want
