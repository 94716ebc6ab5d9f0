"""Repair of conversation structure by a persistent audit table.

The cheapest edits of a conversation are found row by row. For each state of
the role pattern the best edits so far are a linked node that shares its prefix
with others; a node has ancestors at distances of powers of two and a rolling
hash, so two audits of the same cost are compared by a search for their longest
common prefix.

Rows are range-partitioned by conversation, turn and text, so a conversation
that holds a third of all rows is spread over many tasks. What a task has of a
conversation that may go on elsewhere, or that is long, becomes pieces: the
best edits from each state to each state. Pieces are chained afterwards, one
small row each.
"""

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, same, small_batches, table
from sensorlake.operators.joins import bounded_broadcast

SPACES = " \t\n\x0b\x0c\r"
#: Costs of the edits; an undeleted truncated row adds one.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Rows of a piece, and characters of text that a task holds of a conversation.
PIECE_ROWS, HELD = 16_384, 8 << 20

BASE, MODULUS = 1_000_003, (1 << 61) - 1


class Node:
    """The edits up to here: those of ``parent`` and then ``text``."""

    __slots__ = ("text", "size", "level", "hash", "up")

    def __init__(self, parent: "Node | None", text: str):
        self.text = text
        if parent is None:
            self.size, self.level, self.hash, self.up = len(text), 0, 0, []
        else:
            self.size, self.level, h = parent.size + len(text), parent.level + 1, parent.hash
            for c in text:
                h = (h * BASE + ord(c)) % MODULUS
            self.hash, up = h, [parent]
            while len(up[-1].up) >= len(up):
                up.append(up[-1].up[len(up) - 1])
            self.up = up

    def above(self, level: int) -> "Node":
        node = self
        while (far := node.level - level) > 0:
            node = node.up[far.bit_length() - 1]
        return node

    def tail(self, level: int = 0) -> str:
        """The text of the nodes below ``level``."""
        out, node = [], self
        while node.level > level:
            out.append(node.text)
            node = node.up[0]
        return "".join(reversed(out))


def equal(a: Node, b: Node) -> bool:
    """Whether two nodes of one level spell the same; equal hashes are verified."""
    if a is b:
        return True
    if a.hash != b.hash or a.size != b.size:
        return False
    return a.tail() == b.tail()


def before(x: Node, y: Node) -> bool:
    """Whether x's edits are before y's in ASCII order."""
    level = min(x.level, y.level)
    a, b = x.above(level), y.above(level)
    if equal(a, b):
        return x.size < y.size
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and not equal(a.up[k], b.up[k]):
            a, b = a.up[k], b.up[k]
    if a.text[:1] != b.text[:1]:
        return a.text < b.text
    return x.tail(a.level - 1) < y.tail(a.level - 1)


class Heads:
    """The best (cost, node) for each state."""

    def __init__(self, state: int = START, cost: int = 0):
        self.best: list = [None] * 4
        self.best[state] = (cost, Node(None, ""))

    @staticmethod
    def offer(best: list, state: int, cost: int, parent: Node, text: str) -> None:
        held = best[state]
        if held is None or cost < held[0]:
            best[state] = (cost, Node(parent, text))
        elif cost == held[0]:
            node = Node(parent, text)
            if before(node, held[1]):
                best[state] = (cost, node)

    def insert(self) -> None:
        """Any inserted rows that follow."""
        for a, b in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
            if self.best[a]:
                self.offer(self.best, b, self.best[a][0] + INSERT, self.best[a][1], "I")

    def row(self, initial: str, gone: bool, truncated: bool) -> None:
        """One row, which must be deleted if it is ``gone``."""
        best: list = [None] * 4
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, node = held
            self.offer(best, state, cost + DELETE, node, "D")
            if gone:
                continue
            follows = ASSISTANT if state == USER else USER
            self.offer(best, follows, cost + REROLE + truncated, node, "R")
            if initial == ROLES[follows][0]:
                self.offer(best, follows, cost + KEEP + truncated, node, "K")
            elif initial == "s" and state == START:
                self.offer(best, SYSTEM, cost + KEEP + truncated, node, "K")
        self.best = best
        self.insert()

    def end(self) -> tuple[int, str]:
        """Cost and edits of the cheapest legal conversation."""
        found = None
        for state in ACCEPTING:
            if (held := self.best[state]) and (found is None or held[0] < found[0] or held[0] == found[0] and before(held[1], found[1])):
                found = held
        return found[0], found[1].tail()


class Repaired:
    """The repaired conversation's hash, row by row along its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.some, self.sha = audit, 0, START, False, hashlib.sha256()

    def put(self, role: str | None, text: str) -> None:
        follows = ASSISTANT if self.state == USER else USER
        if role is not None and role[:1] == "s" and self.state == START:
            self.state = SYSTEM
        else:
            role, self.state = ROLES[follows] if role is None else role, follows
        self.sha.update((("\n" if self.some else "") + f"{role}:{text}").encode())
        self.some = True

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.put(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            self.put(role if edit == "K" else None, text)

    def digest(self) -> str:
        self.inserted()
        return self.sha.hexdigest()


class Stats:
    """Counts over rows in order, and what is needed to chain them on."""

    NAMES = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first_turn", "last_turn", "first_initial", "last_initial")

    def __init__(self, values: dict | None = None):
        for k in self.NAMES:
            setattr(self, k, (values or {}).get(k, None if "_" in k or k in ("low", "high") else 0))

    def row(self, turn: int | None, initial: str, fault: str | None) -> None:
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.n == 0:
            self.first_turn, self.first_initial = turn, initial
        elif self.last_initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and (self.n == 0 or turn != self.last_turn):
            self.turns += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.n, self.last_turn, self.last_initial = self.n + 1, turn, initial

    def then(self, o: "Stats") -> None:
        """``o`` follows, in order of turns."""
        if self.n == 0:
            self.__dict__.update(o.__dict__)
            return
        self.illegal += o.illegal + (self.last_initial + o.first_initial not in ("su", "ua", "au"))
        self.turns += o.turns - (o.first_turn is not None and o.first_turn == self.last_turn)
        for k in ("n", "blank", "duplicate", "truncated"):
            setattr(self, k, getattr(self, k) + getattr(o, k))
        self.low, self.high = (o.low if self.low is None else self.low), (self.high if o.high is None else o.high)
        self.last_turn, self.last_initial = o.last_turn, o.last_initial

    def shown(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": min(gaps, (1 << 63) - 1), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


def fault_of(text: str, seen: bool) -> str | None:
    """A row's first fault."""
    if not (bare := text.rstrip(SPACES)):
        return "blank"
    if seen:
        return "duplicate"
    return None if bare[-1] in ".!?" else "truncated"


class Conversation:
    """What a task has of one conversation. ``opens`` if rows of it may be in
    an earlier task: then the edits are found from every state."""

    def __init__(self, conv_id: int | None, opens: bool):
        self.conv_id, self.opens, self.seq, self.pieces = conv_id, opens, 0, []
        self.stats, self.rows, self.held = Stats(), [], 0
        self.heads = [Heads(s) for s in range(4)] if opens else [Heads()]
        if not opens:
            self.heads[0].insert()

    @property
    def whole(self) -> bool:
        return self.rows is not None and not self.opens and self.seq == 0

    def row(self, turn, role: str, text: str, seen: bool) -> dict | None:
        fault, initial = fault_of(text, seen), role[:1]
        self.stats.row(turn, initial, fault)
        for h in self.heads:
            h.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
        if self.rows is not None and not self.opens:
            self.rows.append((role, text))
            self.held += len(text)
            if self.held > HELD:
                self.rows = None
        return self.piece() if self.stats.n == PIECE_ROWS else None

    def piece(self) -> dict:
        """The rows so far as a piece; the next begins from every state."""
        out = {"conv_id": self.conv_id, "begins": not self.opens and self.seq == 0, "part": TaskContext.get().partitionId() if TaskContext.get() else 0, "seq": self.seq}
        out |= {k: getattr(self.stats, k) for k in Stats.NAMES}
        out["edits"] = [{"a": a, "b": b, "cost": held[0], "audit": held[1].tail()} for a, h in enumerate(self.heads) for b, held in enumerate(h.best) if held]
        self.seq, self.stats, self.rows = self.seq + 1, Stats(), None
        self.heads = [Heads(s) for s in range(4)]
        return out

    def close(self, ends: bool) -> dict | None:
        """The finished conversation, or its last piece; ``ends`` if rows of it
        may be in a later task."""
        if self.whole and not ends:
            cost, audit = self.heads[0].end()
            repaired = Repaired(audit)
            for role, text in self.rows:
                repaired.row(role, text)
            return {"conv_id": self.conv_id, **self.stats.shown(), "cost": cost, "audit": audit, "repaired_sha256": repaired.digest()}
        return self.piece() if self.stats.n else None


def chained(pieces) -> dict:
    """The pieces of a conversation, in order, as one."""
    stats, heads = Stats(), Heads()
    for p in pieces:
        if stats.n == 0 and not p["begins"]:
            heads.insert()
        stats.then(Stats(p))
        best: list = [None] * 4
        for e in p["edits"]:
            if held := heads.best[e["a"]]:
                heads.offer(best, e["b"], held[0] + e["cost"], held[1], e["audit"])
        heads.best = best
    cost, audit = heads.end()
    return stats.shown() | {"cost": cost, "audit": audit}


SHOWN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
RESULT = f"{SHOWN}, repaired_sha256 string"
TOLD = (f"{RESULT}, begins boolean, part int, seq int, n long, turns long, low long, high long, first_turn long, last_turn long, "
        "first_initial string, last_initial string, edits array<struct<a:int,b:int,cost:long,audit:string>>")
EDITS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds.get(kind, EDITS)) for name, kind in (x.split(" ", 1) for x in ddl.split(", "))])


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32(conv_id:turn) % 20, with
    nulls as one space: 0 drops the row, 1 empties its text, 2 removes its
    [.!?], 3 repeats it, 4 makes its role user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).cast("int")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    rows = rows.where("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"))


ORDER = ["id_known", "conv_id", "turn_known", "turn", "role", "prefix", "key", "row"]


def marked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with their sort columns and ``seen``: whether an earlier row of the
    conversation has the same role and text (by SHA-256). Only the (conversation,
    role, text) that occur more than once are joined."""
    key = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    rows = rows.select("*", key.alias("key"), F.monotonically_increasing_id().alias("row"))
    rows = scratch.stage(rows.select("*", F.col("conv_id").isNotNull().alias("id_known"), F.col("turn").isNotNull().alias("turn_known"), F.substring("text", 1, 64).alias("prefix")), "rows")
    place = F.struct("turn_known", F.coalesce("turn", F.lit(0)).alias("turn"), "row")
    firsts = rows.groupBy("conv_id", "key").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = scratch.stage(firsts.select(F.col("conv_id").alias("first_id"), F.col("key").alias("first_key"), "first"), "firsts")
    joined = rows.join(bounded_broadcast(firsts), same(F.col("conv_id"), F.col("first_id")) & (F.col("key") == F.col("first_key")), "left")
    seen: Column = F.coalesce(place != F.col("first"), F.lit(False))
    return joined.select(*rows.columns, seen.alias("seen"))


def repair(rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id, turn, role, text):
    gaps, faults, the cheapest edits that give role initials (s?(ua)+)?, their
    cost and the SHA-256 of the repaired conversation.

    A conversation's rows go by turn, nulls first; rows of one turn by role,
    then by the first 64 characters of the text, then by its SHA-256. Null role
    and text count as one space; a role that is none of s, u, a by its initial
    (an empty one too) is never kept. Null conv_ids are one conversation; rows
    of unknown turns count in no gap; repeated rows are duplicates; an empty
    table gives no row; columns of other names are not read.

    Tasks hold at most HELD characters of a conversation's texts and the edits
    of PIECE_ROWS rows. Longer ones, and those cut between tasks, are chained
    from pieces; their hash, a chain by its nature, is streamed in order.
    """
    spark = rows.sparkSession
    small_batches(spark)
    scratch = scratch or Scratch(spark, "repair")
    space = F.lit(" ")
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    all_rows = marked(plain, scratch)
    told_schema, whole_schema = arrow_schema(TOLD), arrow_schema(RESULT)

    def first_pass(batches):
        conv, some = None, False
        for b in batches:
            out = []
            for conv_id, turn, role, text, seen in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "seen"))):
                if conv is None or conv.conv_id != conv_id:
                    if conv is not None and (told := conv.close(False)):
                        out.append(told)
                    conv, some = Conversation(conv_id, not some), True
                if told := conv.row(turn, role, text, seen):
                    out.append(told)
            yield pa.RecordBatch.from_pylist(out, schema=told_schema)
        if conv is not None and (told := conv.close(True)):
            yield pa.RecordBatch.from_pylist([told], schema=told_schema)

    dealt = all_rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    told = scratch.stage(dealt.select("conv_id", "turn", "role", "text", "seen").mapInArrow(first_pass, TOLD), "told")
    finished = told.where("edits is null").select(*arrow_schema(RESULT).names)

    def chain(batches):
        held = []
        for b in batches:
            for p in b.to_pylist():
                if held and held[0]["conv_id"] != p["conv_id"]:
                    yield pa.RecordBatch.from_pylist([{"conv_id": held[0]["conv_id"], **chained(held)}], schema=arrow_schema(SHOWN))
                    held = []
                held.append(p)
        if held:
            yield pa.RecordBatch.from_pylist([{"conv_id": held[0]["conv_id"], **chained(held)}], schema=arrow_schema(SHOWN))

    pieces = told.where("edits is not null").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    long = scratch.stage(pieces.mapInArrow(chain, SHOWN), "chained")

    def hashes(batches):
        row, repaired = None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["kind"] == 0:
                    if row:
                        out.append(row | {"repaired_sha256": repaired.digest()})
                    row, repaired = {k: r[k] for k in whole_schema.names[:-1]}, Repaired(r["audit"])
                else:
                    repaired.row(r["role"], r["text"])
            yield pa.RecordBatch.from_pylist(out, schema=whole_schema)
        if row:
            yield pa.RecordBatch.from_pylist([row | {"repaired_sha256": repaired.digest()}], schema=whole_schema)

    ids = bounded_broadcast(long.select(F.col("conv_id").alias("long_id")))
    texts = all_rows.join(ids, same(F.col("conv_id"), F.col("long_id")), "left_semi").select(*ORDER, "text", F.lit(1).alias("kind"))
    heads = long.select("*", F.col("conv_id").isNotNull().alias("id_known"), F.lit(0).alias("kind"))
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("id_known", "conv_id", "kind", *ORDER[2:])
    return finished.unionByName(both.mapInArrow(hashes, RESULT))


def op13_repair(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair(damaged(rows)).withColumnRenamed("conv_id", "found_id")
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(found, same(F.col("conv_id"), F.col("found_id")), "left")
    zero = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return joined.select("conv_id", *[F.coalesce(F.col(c), v).alias(c) for c, v in zero.items()])
