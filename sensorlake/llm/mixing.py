"""Mixing sources to target weights by a low-discrepancy block schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, beside, bounded, free_name, if_small, same, table

WEIGHTS = (5, 2, 1)
#: A source is taken at most so many times over.
MOST = 3
#: Blocks of the average source and the longest block in words: blocks are as
#: long as the first allows and no longer than the second. A smaller source is
#: cut into as many blocks, or into words if it has fewer.
SLOTS = 4096
BLOCK = 4096
#: Blocks are longer than BLOCK where all uses of them would else be more than
#: twice as many, so that the schedule's 64-bit integers hold any corpus.
USES = 1 << 30
#: A source of fewer blocks has a run of slots of its own.
FEW = 512
#: 2**32 over the golden ratio, and 2**32: slot k is at (k * STEP) mod RING.
STEP = 2654435769
RING = 1 << 32
#: Bits of a place within a cell of the ring: 65,536 cells.
CELL = 16
SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between the six ASCII spaces; null and wordless texts have none."""
    bare = F.regexp_replace(text, rf"^{SPACE}|{SPACE}$", "")
    return F.when(F.length(bare) > 0, F.size(F.split(bare, SPACE))).otherwise(0).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the two hashes of a row's place in the shuffle."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("id_hash"),
                       F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_hash"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source_no (by code point, null last), source_size,
    target, capped. The sources' sums, a row each, go through one task.

    Sources are capped in order of size / weight: one is capped if its share of
    what the ones before it leave is over ``most`` times its size.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # strings compare by their UTF-8 bytes, which is by code point
    all_rows = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(all_rows) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", n.alias("source_no"), weight.alias("w"))
    order = Window.orderBy(F.col("source_size") / F.col("w"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(F.col("source_size") * most).over(order), F.lit(0))
    weight_left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(order), F.lit(0.0))
    per = per.withColumn("share", left / weight_left)
    per = per.withColumn("capped", F.col("w") * F.col("share") > F.col("source_size") * most)
    free = F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("w"), "source_no", "share"))).over(whole)["share"]
    target = F.when(F.col("capped"), F.col("source_size") * float(most)).otherwise(F.col("w") * free)
    return per.select("source", "source_no", "source_size", "capped", target.alias("target"))


def block_lengths(sources: int, words: int, most: int = MOST) -> tuple[int, int]:
    """Words of a block, and the fewest blocks of a source of enough words."""
    block = max(1, min(BLOCK, words // max(1, SLOTS * sources)), -(-most * words // USES))
    return block, max(1, min(SLOTS, USES // max(1, most * sources)))


def cut_targets(targets: DataFrame, block: int, least: int = SLOTS) -> DataFrame:
    """``targets`` with each source's own blocks: how many, and how many uses
    of them, in real numbers, make up its target. A source's blocks differ by
    a word at most, so that none is short."""
    blocks = F.greatest(F.ceil(F.col("source_size") / block), F.least("source_size", F.lit(least))).cast("long")
    targets = targets.withColumn("blocks", blocks)
    return targets.withColumn("shares", F.when(F.col("target") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))


def block_start(block_no: Column) -> Column:
    """The first word of a block: a source's first blocks are a word longer if
    its words don't divide by its blocks."""
    return block_no * F.expr("source_size div blocks") + F.least(block_no, F.expr("source_size % blocks"))


def block_of(word: Column) -> Column:
    """The block that holds a source's word."""
    length, longer = F.expr("source_size div blocks"), F.expr("source_size % blocks")
    return F.when(word < longer * (length + 1), F.floor(word / (length + 1))).otherwise(longer + F.floor((word - longer * (length + 1)) / length))


def schedule(targets: DataFrame, slots: int, most: int, scratch: Scratch) -> DataFrame:
    """(source_no, block_no, uses): golden-ratio slots mapped through the
    cumulative ``shares``, ranked within their source and dealt to its blocks in
    turn, at most ``most`` turns. In a run of its own all slots are the
    source's, as many as its shares to the nearest whole number.

    A source's slots are ranked in chunks of slots: a count of each chunk, and
    a rank within it, so that no source's slots meet in one task.
    """
    spark = targets.sparkSession
    few = targets.where((F.col("shares") > 0) & (F.col("blocks") < FEW)).withColumn("n", F.least(F.round("shares").cast("long"), F.col("blocks") * most)).where("n > 0")
    few = few.select("source_no", "n", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.least("n", "blocks") - 1)).alias("block_no"))
    few = few.select("source_no", "block_no", F.floor((F.col("n") - 1 - F.col("block_no")) / F.col("blocks") + 1).alias("uses"))
    targets = targets.where((F.col("shares") > 0) & (F.col("blocks") >= FEW))
    bounds = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("shares").over(bounds) / F.sum("shares").over(Window.partitionBy())
    ends = targets.select("source_no", "blocks", F.floor(upto * RING).cast("long").alias("upto"))
    ends = ends.withColumn("from", F.coalesce(F.lag("upto").over(Window.orderBy("source_no")), F.lit(0).cast("long")))
    last = F.lead("source_no").over(Window.orderBy("source_no")).isNull()
    ends = ends.withColumn("upto", F.when(last, F.lit(RING)).otherwise(F.col("upto")))
    k = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") * F.lit(STEP)) % RING).alias("at"))
    # each source's range is listed in the cells of the ring that it touches
    cell = F.explode(F.sequence(F.shiftright("from", CELL), F.shiftright(F.col("upto") - 1, CELL))).alias("cell")
    ends = scratch.stage(ends.where(F.col("upto") > F.col("from")).select("*", cell), "ends")
    dealt = k.withColumn("cell", F.shiftright("at", CELL)).join(if_small(ends), "cell")
    dealt = dealt.where((F.col("at") >= F.col("from")) & (F.col("at") < F.col("upto")))
    dealt = dealt.withColumn("chunk", F.floor(F.col("slot") / 1024))
    per_chunk = dealt.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_chunk = per_chunk.select(F.col("source_no").alias("s"), F.col("chunk").alias("c"), before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = dealt.withColumn("rank", rank).join(per_chunk, (F.col("source_no") == F.col("s")) & (F.col("chunk") == F.col("c")))
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).where(F.col("rank") < F.col("blocks") * most)
    return ranked.groupBy("source_no", (F.col("rank") % F.col("blocks")).alias("block_no")).agg(F.count("*").alias("uses")).unionByName(few)


def place(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Each row's place in its source's shuffled words: ``start``. Rows are
    ordered by hash; each of 4,096 ranges of hashes is summed first, so that a
    source's rows are never ordered in one task."""
    t = bounded(targets.select(F.col("source").alias("t_source"), "source_no", "source_size", "target", "blocks"))
    rows = sizes.join(t, same(F.col("source"), F.col("t_source"))).drop("t_source")
    rows = rows.withColumn("part", F.substring(F.md5(F.concat("id_hash", "text_hash")), 1, 3))
    sums = rows.groupBy("source_no", "part").agg(F.sum("size").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(F.col("source_no").alias("s"), F.col("part").alias("p"), before.alias("before"))
    w = Window.partitionBy("source_no", "part").orderBy("id_hash", "text_hash", "size")
    inside = F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("row_no", F.row_number().over(w)).withColumn("inside", inside)
    rows = rows.join(sums, (F.col("source_no") == F.col("s")) & (F.col("part") == F.col("p")))
    return rows.withColumn("start", F.col("before") + F.col("inside")).drop("s", "p", "before", "inside")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the hashes of the row.

    Size is the words of the text (null and empty: 0, never taken). Sources
    weigh ``weights`` in turn, in code-point order with null last; together
    they share as many words as there are, no source over ``most`` times its
    own. A source's words, in the order of the rows' hashes, are cut into
    blocks of the source's own length; the schedule says how often each block is used, and
    ``taken`` is a row's words in used blocks. Reruns agree; rows alike in id
    and text are told apart by nothing but their order, which changes no set
    of results. Rows may repeat and ids be null. An empty table gives no row.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "mix")
    sizes = scratch.stage(sized(docs), "sizes")
    targets = scratch.stage(source_targets(sizes, weights, most), "targets")
    sources, words = targets.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    targets = scratch.stage(cut_targets(targets, *block_lengths(sources, words, most)), "blocks")
    slots = round(targets.where(F.col("blocks") >= FEW).agg(F.coalesce(F.sum("shares"), F.lit(0.0))).first()[0])
    uses = scratch.stage(schedule(targets, slots, most, scratch), "uses")
    rows = scratch.stage(place(sizes, targets), "placed")
    first, last = block_of(F.col("start")), block_of(F.col("start") + F.col("size") - 1)
    cut = rows.where("size > 0").select("source_no", "part", "row_no", "start", "size", "source_size", "blocks", F.explode(F.sequence(first, last)).alias("block_no"))
    used = cut.join(uses, ["source_no", "block_no"])
    overlap = F.least(F.col("start") + F.col("size"), block_start(F.col("block_no") + 1)) - F.greatest("start", block_start(F.col("block_no")))
    taken = used.groupBy("source_no", "part", "row_no").agg(F.sum(overlap * F.col("uses")).alias("taken"))
    return (rows.join(taken, ["source_no", "part", "row_no"], "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "id_hash", "text_hash", "source", "row_no"))


def op9_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, to the nearest
    whole number: only rows at the end of a source's last turn are taken in
    part. Rows that the mix doesn't reach go. Rows alike in id, source and
    text share what they are given."""
    scratch = Scratch(docs.sparkSession, "mixed")
    found = mix(docs, scratch=scratch)
    times = found.groupBy("id_hash", "text_hash", "source").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"), F.count("*").alias("rows"))
    count = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int").alias("times")
    times, (i, h, s, n) = beside(docs, scratch.stage(times.select("id_hash", "text_hash", "source", count).where("times > 0"), "times"))
    a, b, c = (free_name(docs, x) for x in ("id_hash", "text_hash", "turn"))
    rows = docs.withColumn(a, F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))).withColumn(b, F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    found = rows.join(times, (rows[a] == i) & (rows[b] == h) & same(rows["source"], s))
    return found.withColumn(c, F.explode(F.sequence(F.lit(1), n))).select(*docs.columns)
