"""Chat formatting: tool calls linked to their results, ordered, validated and
written as canonical JSON, one line for each message."""

import functools
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import BATCH_ROWS, Scratch, bounded, if_small, small_batches, table

#: Rows that a task orders at once.
PIECE = 50_000

#: Argument schemas of the tools that the query's calls name.
TOOLS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 20}}},
    "measure": {"type": "object", "required": ["of", "unit"], "additionalProperties": False,
                "properties": {"of": {"type": "array", "items": {"type": "string"}}, "unit": {"type": "string", "enum": ["words", "chars"]}}},
}
TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value) -> str:
    """Keys by code point, no spaces, text as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def has_type(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        return not isinstance(value, bool) and isinstance(value, int if kind == "integer" else (int, float))
    return isinstance(value, TYPES[kind])


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What of a schema a value breaks: type, enum, bounds, lengths, required,
    properties, additionalProperties and items."""
    out = []
    if "type" in schema and not has_type(value, schema["type"]):
        return [f"{at}: not of type {schema['type']}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if has_type(value, "number"):
        out += [f"{at}: under minimum"] * (value < schema.get("minimum", value)) + [f"{at}: over maximum"] * (value > schema.get("maximum", value))
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{at}: too short")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: not allowed")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{i}]")
    return out


def parsed(text: str | None):
    """A JSON value, or None for what is none."""
    try:
        return json.loads(text, parse_constant=lambda _: None) if text is not None else None
    except ValueError:
        return None


CALL = "msg long, conv_id long, turn long, pos int, call_id string, name string, arguments string, after array<string>, errors array<string>"


def calls_of(messages: DataFrame, tools: dict) -> DataFrame:
    """One row for each call that a message makes, its arguments validated."""
    schema = pa.schema([("msg", pa.int64()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("pos", pa.int32()), ("call_id", pa.string()), ("name", pa.string()),
                        ("arguments", pa.string()), ("after", pa.list_(pa.string())), ("errors", pa.list_(pa.string()))])

    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                made = parsed(r["tool_calls"])
                for pos, c in enumerate(made if isinstance(made, list) else []):
                    c = c if isinstance(c, dict) else {}
                    name, arguments, key = c.get("name"), c.get("arguments"), c.get("id")
                    errors = ["unknown tool"] if not isinstance(name, str) or name not in tools else violations(arguments, tools[name])
                    errors += [] if isinstance(key, str) and key else ["no identifier"]
                    after = c.get("after") if isinstance(c.get("after"), list) else []
                    rows.append({"msg": r["msg"], "conv_id": r["conv_id"], "turn": r["turn"], "pos": pos, "call_id": key if isinstance(key, str) and key else None,
                                 "name": name if isinstance(name, str) else None, "arguments": canonical(arguments), "errors": errors,
                                 "after": sorted({x for x in after if isinstance(x, str) and x})})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return messages.where("tool_calls is not null").select("msg", "conv_id", "turn", "tool_calls").mapInArrow(run, CALL)


EDGE = pa.schema([("conv_id", pa.int64()), ("call_id", pa.string()), ("level", pa.int64())])


def place_calls(batches):
    """The levels of the calls among a task's rows (conv_id, call_id, on,
    level) that wait, in the end, for nothing but calls with a level. A row
    with a null ``on`` waits for nothing, one with a level for a placed call."""
    level, missing, behind = {}, {}, {}
    for b in batches:
        for conv, call, on, known in zip(*(b.column(k).to_pylist() for k in ("conv_id", "call_id", "on", "level"))):
            key = (conv, call)
            level[key] = max(level.get(key, 0), 0 if known is None else known + 1)
            missing.setdefault(key, 0)
            if on is not None and known is None:
                missing[key] += 1
                behind.setdefault((conv, on), []).append(key)
    ready = [k for k, n in missing.items() if not n]
    for key in ready:
        for k in behind.get(key, ()):
            level[k] = max(level[k], level[key] + 1)
            missing[k] -= 1
            if not missing[k]:
                ready.append(k)
    for i in range(0, len(ready), BATCH_ROWS):
        part = ready[i:i + BATCH_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in part], pa.int64()), pa.array([k[1] for k in part], pa.string()), pa.array([level[k] for k in part], pa.int64())], schema=EDGE)


def levels(calls: DataFrame, scratch: Scratch, rows: int = PIECE) -> DataFrame:
    """(conv_id, call_id, level): each call's place in a topological order of
    its conversation, the length of the longest chain of calls before it. Calls
    in or behind a cycle, or behind an identifier that no call has, have none.

    Waits are range-partitioned by conversation, turn and place, in pieces of
    some ``rows`` rows. A task orders its piece as far as it goes; what waits
    for calls of other pieces is dealt anew with their levels. So there are as
    many rounds as the longest chain goes from piece to piece, not as it has
    calls, and a long conversation is several tasks'.
    """
    key = ["conv_id", "call_id"]
    known = calls.where("call_id is not null and conv_id is not null")
    start = known.groupBy(key).agg(F.min(F.struct(F.coalesce("turn", F.lit(0)).alias("turn"), "pos")).alias("start"))
    waits = known.select(*key, F.explode_outer("after").alias("on")).distinct()
    pending = scratch.stage(waits.join(start, key).withColumn("level", F.lit(None).cast("long")), "waits")
    placed = []
    while n := pending.count():
        dealt = pending.repartitionByRange(-(-n // rows), "conv_id", "start", "call_id")
        new = scratch.stage(dealt.select(*key, "on", "level").mapInArrow(place_calls, "conv_id long, call_id string, level long"), "placed")
        if not new.limit(1).count():
            break
        placed.append(new)
        done = new.select("conv_id", F.col("call_id").alias("on"), F.col("level").alias("found"))
        rest = pending.join(new.select(key), key, "left_anti").join(done, ["conv_id", "on"], "left")
        rest = scratch.stage(rest.select(*key, "on", "start", F.coalesce("level", "found").alias("level"), F.col("found").isNotNull().alias("news")), "waits")
        scratch.drop(pending)
        # calls that no new level has reached can't be placed
        pending = rest if rest.where("news").limit(1).count() else rest.limit(0)
    empty = pending.select(*key, "level").limit(0)
    return functools.reduce(DataFrame.unionByName, placed, empty)


def format_chat(messages: DataFrame, tools: dict) -> DataFrame:
    """conv_id, turn, role, n_calls, n_linked, n_errors and json of every row
    of ``messages`` (conv_id, turn, role, text, tool_calls, tool_call_id).

    ``tool_calls`` is a JSON list of {id, name, arguments, after}, where after
    names calls of the conversation that come first; a row with tool_call_id is
    a result. A call links to the first result of its identifier in its
    conversation, by turn and then text; further ones and those that no call
    asked for are marked ``linked`` false. A message's calls are written in
    topological order (level, place in the message), those without a level
    last and marked with an error. Null texts stay null, other JSON than a list
    makes no call, rows with a null conv_id or turn are formatted like others
    (calls with a null conv_id link to nothing); repeated rows all stay, and
    calls with the same identifier share its result and level. An empty table
    gives no row. No task needs a whole conversation: one may be very long.
    """
    spark = messages.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "chat")
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "tool_calls", "tool_call_id")
    rows = scratch.stage(rows.withColumn("msg", F.monotonically_increasing_id()), "messages")
    calls = scratch.stage(calls_of(rows, tools), "calls")
    results = rows.where("tool_call_id is not null and conv_id is not null")
    first = results.groupBy("conv_id", F.col("tool_call_id").alias("call_id")).agg(F.min(F.struct(F.col("turn").isNull(), "turn", F.coalesce("text", F.lit("")).alias("t"), "msg", "text")).alias("r"))
    first = scratch.stage(first.select("conv_id", "call_id", F.col("r.text").alias("result"), F.col("r.msg").alias("result_msg")), "results")
    place = levels(calls, scratch)
    key = ["conv_id", "call_id"]
    linked = calls.join(bounded(first), key, "left")
    linked = linked.join(bounded(scratch.stage(place, "levels")), key, "left")
    linked = scratch.stage(linked, "linked")
    per = linked.groupBy("msg").agg(F.sort_array(F.collect_list(F.struct(
        F.col("level").isNull().alias("unplaced"), "level", "pos", "call_id", "name", "arguments", "errors", F.col("result_msg").isNotNull().alias("has_result"), "result"))).alias("calls"))
    taken = linked.where("result_msg is not null").select(F.col("result_msg").alias("msg")).distinct().withColumn("used", F.lit(True))
    per, taken = scratch.stage(per, "per-message"), scratch.stage(taken, "used")
    whole = rows.join(bounded(per), "msg", "left").join(if_small(taken), "msg", "left")
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("n_calls", pa.int32()), ("n_linked", pa.int32()), ("n_errors", pa.int32()), ("json", pa.string())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([formatted(r) for r in b.to_pylist()], schema=schema)

    return whole.select("conv_id", "turn", "role", "text", "tool_call_id", "calls", "used").mapInArrow(run, "conv_id long, turn long, role string, n_calls int, n_linked int, n_errors int, json string")


def formatted(r: dict) -> dict:
    out, calls = {"role": r["role"], "content": r["text"]}, []
    for c in r["calls"] or []:
        errors = (c["errors"] or []) + ["no place in any order"] * bool(c["call_id"] and c["unplaced"])
        call = {"id": c["call_id"], "name": c["name"], "arguments": parsed(c["arguments"])}
        if c["has_result"]:
            value = parsed(c["result"])
            call["result"] = c["result"] if value is None else value
        if errors:
            call["errors"] = errors
        calls.append(call)
    if calls:
        out["tool_calls"] = calls
    if r["tool_call_id"] is not None:
        out |= {"tool_call_id": r["tool_call_id"], "linked": bool(r["used"])}
    return {"conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"], "n_calls": len(calls), "n_linked": sum("result" in c for c in calls),
            "n_errors": sum(len(c.get("errors", ())) for c in calls), "json": canonical(out)}


def with_tool_calls(conversations: DataFrame) -> DataFrame:
    """The driver's conversations hold no tool calls, so each assistant turn is
    given a search for its first words and a measurement that waits for it (and,
    but for every fourth turn, for the search of the assistant turn before);
    results are rows of role tool. Wrong arguments, lost and doubled results,
    results that nobody asked for, waits on unknown calls and cycles come in at
    fixed turns."""
    spark = conversations.sparkSession
    small_batches(spark)
    schema = pa.schema([("turn", pa.int64()), ("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("tool_calls", pa.string()), ("tool_call_id", pa.string())])

    def made(r: dict) -> list[dict]:
        base = {"conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"], "text": r["text"], "tool_calls": None, "tool_call_id": None}
        if r["role"] != "assistant" or r["turn"] is None:
            return [base]
        words, turn, n = (r["text"] or "").split(), r["turn"], (r["conv_id"] or 0) + r["turn"]
        before = [f"search-{turn - 2}"] if turn % 8 > 2 else []
        calls = [{"id": f"measure-{turn}", "name": "measure", "arguments": {"unit": "lines" if n % 17 == 4 else "words", "of": words[:2]}, "after": [f"search-{turn}", *before]},
                 {"id": f"search-{turn}", "name": "search", "arguments": {"query": " ".join(words[:5]), "limit": str(n) if n % 13 == 5 else 1 + n % 20},
                  "after": [f"measure-{turn}"] if n % 29 == 7 else ["never"] if n % 31 == 8 else []}]
        result = [(f"search-{turn}", {"hits": len(words) % 7}), (f"measure-{turn}", {"words": len(words)})]
        out = [base | {"tool_calls": canonical(calls)}]
        for key, value in result[:1 if n % 11 == 3 else 2] + result[:n % 19 == 6]:
            out.append(base | {"role": "tool", "text": canonical(value), "tool_call_id": f"lost-{turn}" if n % 23 == 9 else key})
        return out

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([x for r in b.to_pylist() for x in made(r)], schema=schema)

    return conversations.select("conv_id", "turn", "role", "text").mapInArrow(run, "turn long, conv_id long, role string, text string, tool_calls string, tool_call_id string")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chat(with_tool_calls(table(spark, sf_dir, "conversations")), TOOLS)
