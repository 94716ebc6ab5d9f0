import json
import random

import pytest
from pyspark.sql import functions as F

from sensorlake.llm import chat
from sensorlake.llm.common import Scratch
from tests.llm.nasty import CLASHING, empty

SCHEMA = "conv_id long, turn long, role string, text string, tool_calls string, tool_call_id string"


def call(key, name="search", after=(), **arguments):
    return {"id": key, "name": name, "arguments": arguments or {"query": "q", "limit": 1}, "after": list(after)}


def messages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("old").alias(c) for c in CLASHING + ["msg", "calls", "used", "level", "result"]])


ROWS = [
    (1, 0, "user", "hi", None, None),
    (1, 1, "assistant", "ok", json.dumps([call("c", after=["b"]), call("b", after=["a"]), call("a")]), None),
    (1, 2, "tool", '{"z":1,"a":[2]}', None, "a"),
    (1, 3, "tool", "not json", None, "b"),
    (1, 4, "tool", "late", None, "a"),
    (1, 5, "tool", "orphan", None, "zzz"),
    (2, 1, "assistant", None, json.dumps([call("a", limit="x"), call("x", after=["y"]), call("y", after=["x"]), call("w", after=["nobody"]), call(None), call("n", name="nothing")]), None),
    (2, 2, "tool", None, None, "a"),
    (3, 1, "assistant", "bad", "{not json", None),
    (3, 2, "assistant", "é ", "[]", None),
    (None, 1, "assistant", "x", json.dumps([call("a")]), None),
    (1, 0, "user", "hi", None, None),
    (None, None, None, None, None, None),
]


def test_links_orders_and_marks(spark):
    found = chat.format_chat(messages(spark, ROWS), chat.TOOLS).collect()
    assert len(found) == len(ROWS)
    of = {(r["conv_id"], r["turn"]): (json.loads(r["json"]), r) for r in found}
    made = of[1, 1][0]["tool_calls"]
    assert [c["id"] for c in made] == ["a", "b", "c"] and made[0]["result"] == {"z": 1, "a": [2]} and made[1]["result"] == "not json" and "result" not in made[2]
    assert of[1, 2][0]["linked"] and of[1, 3][0]["linked"] and not of[1, 4][0]["linked"] and not of[1, 5][0]["linked"]
    odd = {c["id"]: c for c in of[2, 1][0]["tool_calls"]}
    assert odd["a"]["errors"] == ["$.query: missing", "$.limit: not of type integer"] and odd["a"]["result"] is None
    for k in "xyw":
        assert odd[k]["errors"] == ["no place in any order"]
    assert odd[None]["errors"] == ["no identifier"] and odd["n"]["errors"] == ["unknown tool"]
    assert "tool_calls" not in of[3, 1][0] and of[3, 2][0]["content"] == "é "
    assert "result" not in of[None, 1][0]["tool_calls"][0]
    for value, r in of.values():
        assert r["json"] == chat.canonical(value)


def test_matches_a_plain_version(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in chat.with_tool_calls(spark.read.parquet(f"{d}/conversations.parquet")).select("conv_id", "turn", "role", "text", "tool_calls", "tool_call_id").collect()]
    calls, results = {}, {}
    for conv, turn, _, text, made, key in rows:
        for c in json.loads(made) if made else []:
            calls.setdefault((conv, c["id"]), set()).update(c["after"])
        if key is not None:
            results[conv, key] = min(results.get((conv, key), (turn, text)), (turn, text))
    level, n = {}, 0
    while new := [k for k, on in calls.items() if k not in level and all((k[0], x) in level for x in on)]:
        level |= dict.fromkeys(new, n)
        n += 1
    want = []
    for conv, turn, role, text, made, key in rows:
        c = sorted(enumerate(json.loads(made) if made else []), key=lambda x: ((conv, x[1]["id"]) not in level, level.get((conv, x[1]["id"]), 0), x[0]))
        errors = sum(len(chat.violations(x["arguments"], chat.TOOLS[x["name"]])) + ((conv, x["id"]) not in level) for _, x in c)
        want.append((conv, turn, role, len(c), sum((conv, x["id"]) in results for _, x in c), errors, [x["id"] for _, x in c]))
    got = [(r["conv_id"], r["turn"], r["role"], r["n_calls"], r["n_linked"], r["n_errors"], [c["id"] for c in json.loads(r["json"]).get("tool_calls", [])]) for r in chat.op10_chat(spark, d).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(x[5] for x in want) and any(x[4] < x[3] for x in want)


@pytest.mark.parametrize("value,schema,n", [
    (1, {"type": "integer"}, 0), (True, {"type": "integer"}, 1), (1.5, {"type": "integer"}, 1), (1.5, {"type": "number", "maximum": 1}, 1),
    ("", {"type": "string", "minLength": 1}, 1), ({"a": 1, "b": 2}, {"properties": {"a": {"type": "string"}}, "additionalProperties": False, "required": ["c"]}, 3),
    ([1, "x", None], {"type": "array", "items": {"type": "integer"}}, 2), (None, {"type": "null"}, 0), ("z", {"enum": ["x", "y"]}, 1)])
def test_schemas(value, schema, n):
    assert len(chat.violations(value, schema)) == n


def chain(spark, n):
    made = [(5, t, "assistant", None, json.dumps([call(f"c{t}", after=[f"c{t - 1}"] if t else [])]), None) for t in range(n)]
    return messages(spark, made)


def test_a_long_chain_takes_few_rounds(spark):
    calls = chat.calls_of(chain(spark, 1000).withColumn("msg", F.col("turn")), chat.TOOLS)
    scratch = Scratch(spark, "chain")
    got = {r["call_id"]: r["level"] for r in chat.levels(calls, scratch).collect()}
    assert got == {f"c{i}": i for i in range(1000)}
    assert next(scratch.count) <= 4


def test_pieces_give_the_levels_of_one(spark):
    rng = random.Random(2)
    made = []
    for t in range(150):
        after = rng.sample([f"c{i}" for i in range(max(0, t - 12), t)], min(t, rng.randrange(3)))
        after += ["c2"] * (t == 1) + [f"c{t + 9}"] * (t % 40 == 39) + ["nobody"] * (t % 37 == 36)
        made.append((rng.choice([1, 2]) if t > 120 else 1, t, "assistant", None, json.dumps([call(f"c{t}", after=after), call(f"c{t // 2}", after=[])]), None))
    calls = chat.calls_of(messages(spark, made).withColumn("msg", F.col("turn")), chat.TOOLS)
    one, many = ({(r["conv_id"], r["call_id"]): r["level"] for r in chat.levels(calls, Scratch(spark, "pieces"), n).collect()} for n in (50_000, 40))
    on, level, n = {}, {}, 0
    for conv, _, _, _, c, _ in made:
        for x in json.loads(c):
            on.setdefault((conv, x["id"]), set()).update(x["after"])
    while new := [k for k, v in on.items() if k not in level and all((k[0], x) in level for x in v)]:
        level |= dict.fromkeys(new, n)
        n += 1
    assert one == many == level and 5 < n and len(level) < len(on)


def test_empty_table(spark):
    assert chat.format_chat(empty(messages(spark, ROWS)), chat.TOOLS).count() == 0
