"""Benchmark decontamination by spaced-seed hashing, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, beside, bounded, free_name, if_small, table

#: An overlap is WINDOW tokens in a row of which SAME or more are equal.
WINDOW = 13
SAME = 11
#: Seeds; a 0 position may differ. Wherever two of thirteen tokens differ, one
#: of these finds six or more equal ones in their places, so that no overlap
#: goes unseen (tests/llm tries all pairs of positions).
MASKS = ("11101011", "110100111")
#: What parts words: ASCII and Latin-1 controls, spaces and signs, general punctuation, ideographic space.
NOT_WORD = r"[\x00-/:-@\[-`{-\u00BF\u2000-\u206F\u3000-\u3003]+"
#: Bits of the filter of first token pairs.
PAIRS = 16


def token_hashes(text: Column) -> Column:
    """Hashes of a text's lower-case words without punctuation."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is used:
    the optimizer would else repeat it at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pair(h: Column, i: Column) -> Column:
    """PAIRS bits of the first two tokens, which every mask keeps."""
    both = F.get(h, i).bitwiseXOR(F.shiftright(F.get(h, i + 1), 7))
    return both.bitwiseAND((1 << PAIRS) - 1).cast("int")


def first(h: Column, i: Column, n: int) -> Column:
    """PAIRS bits of the beginning of a run of ``n`` tokens."""
    return pair(h, i) if n > 1 else F.get(h, i).bitwiseAND((1 << PAIRS) - 1).cast("int")


def run_seed(h: Column, i: Column, n: int) -> Column:
    """The seed of a whole item of ``n`` tokens: a mask that ignores none."""
    return F.xxhash64(F.lit(-n), *[F.get(h, i + o) for o in range(n)])


def seeds(text: Column, known: dict[int, Column] | None = None, lengths: tuple[int, ...] = ()) -> Column:
    """The places and seeds (one for each mask) of a text, and those of its
    runs of ``lengths`` tokens; with ``known``, bitmaps of what items begin
    with (one token or two), only those that begin so. The longer mask's places
    beyond the end are null: they only make hits to verify."""
    def at(h: Column, i: Column) -> Column:
        each = [F.xxhash64(F.lit(k), *[F.get(h, i + o) for o, c in enumerate(m) if c == "1"]) for k, m in enumerate(MASKS)]
        return F.array(*[F.struct(i.alias("place"), x.alias("seed")) for x in each])

    def where(h: Column, least: int, span: int, n: int) -> Column:
        places = F.when(F.size(h) >= least, F.sequence(F.lit(0), F.size(h) - span))
        if known is None:
            return places

        def some(i: Column) -> Column:
            p = first(h, i, n)
            return F.call_function("shiftright", F.get(known[min(n, 2)], F.shiftright(p, 6)), p.bitwiseAND(63)).bitwiseAND(1) == 1

        return F.filter(places, some)

    def runs(h: Column, n: int) -> Column:
        return F.transform(where(h, n, n, n), lambda i: F.struct(i.alias("place"), run_seed(h, i, n).alias("seed")))

    def every(h: Column) -> Column:
        masked = F.flatten(F.transform(where(h, WINDOW, min(map(len, MASKS)), 2), lambda i: at(h, i)))
        if not lengths:
            return masked
        none = F.array().cast("array<struct<place:int,seed:bigint>>")
        return F.concat(*[F.coalesce(x, none) for x in [masked, *[runs(h, n) for n in lengths]]])

    return let(token_hashes(text), every)


def bitmap(found: DataFrame) -> Column:
    """2**PAIRS bits, set for the values of column p. Its size is fixed; with
    many items it lets all places through."""
    found = found.groupBy(F.shiftright("p", 6).alias("at"))
    words = {r["at"]: r["bits"] for r in found.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63))).alias("bits")).collect()}
    # the least long has no literal of its own
    return F.expr(f"array({', '.join(f'(CAST({words.get(i, 0) >> 1} AS BIGINT) * 2 + {words.get(i, 0) & 1})' for i in range((1 << PAIRS) >> 6))})")


def bitmaps(items: DataFrame, lengths: tuple[int, ...] = ()) -> dict[int, Column]:
    """For 2, the token pairs that begin the items' seeds; for 1, the items of
    one token, if there are any."""
    span = min(map(len, MASKS))
    pairs = let(token_hashes(F.col("text")), lambda h: F.transform(
        F.when(F.size(h) >= WINDOW, F.sequence(F.lit(0), F.size(h) - span)).when(F.size(h) > 1, F.array(F.lit(0))), lambda i: pair(h, i)))
    out = {2: bitmap(items.select(F.explode(pairs).alias("p")))}
    if 1 in lengths:
        ones = let(token_hashes(F.col("text")), lambda h: F.when(F.size(h) == 1, first(h, F.lit(0), 1)))
        out[1] = bitmap(items.select(ones.alias("p")).where("p is not null"))
    return out


def short_lengths(items: DataFrame) -> tuple[int, ...]:
    """The numbers of tokens under WINDOW that items have: twelve at most."""
    n = F.size(token_hashes(F.col("text"))).alias("n")
    return tuple(sorted(r["n"] for r in items.select(n).where(F.col("n").between(1, WINDOW - 1)).distinct().collect()))


def short_rows(items: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """One seed, at place 0, for each item of under WINDOW tokens."""
    def whole(h: Column) -> Column:
        return F.coalesce(*[F.when(F.size(h) == n, run_seed(h, F.lit(0), n)) for n in lengths])

    return items.select("item_id", F.lit(0).alias("place"), let(token_hashes(F.col("text")), whole).alias("seed")).where("seed is not null")


def text_key() -> list[Column]:
    """128 bits that stand for a text, so that each text is judged once."""
    return [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2")]


def seed_rows(rows: DataFrame, keys: list[Column], known: dict[int, Column] | None = None, lengths: tuple[int, ...] = ()) -> DataFrame:
    """One row per seed and place of each text."""
    each = rows.select(*keys, seeds(F.col("text"), known, lengths).alias("seeds"))
    # the outer form, as for the other the optimizer would work the array out once more to skip empty ones
    return each.select(*[c for c in each.columns if c != "seeds"], F.inline_outer("seeds")).where("seed is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """(k1, k2, item_id, same): for each text of ``docs`` (by key) and item
    with an overlap, the most equal tokens of a window. Items are told apart by
    their ids, which here stand for their texts."""
    items = scratch.stage(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "benchmark")
    lengths = short_lengths(items)
    marks = seed_rows(items, [F.col("item_id")])
    marks = marks.unionByName(short_rows(items, lengths)) if lengths else marks
    marks = scratch.stage(marks.withColumnRenamed("place", "item_place"), "item-seeds")
    hits = seed_rows(docs, text_key(), bitmaps(items, lengths), lengths).join(if_small(marks), "seed")
    hits = scratch.stage(hits.select("k1", "k2", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).distinct(), "hits")
    wanted = scratch.stage(hits.select("k1", "k2").distinct(), "texts")
    # of equal texts one is verified
    rows = docs.select(*text_key(), "text").join(if_small(wanted), ["k1", "k2"], "left_semi")
    rows = scratch.stage(rows.select("k1", "k2", token_hashes(F.col("text")).alias("h")), "hashes")
    rows = rows.groupBy("k1", "k2").agg(F.any_value("h").alias("h"))
    items = scratch.stage(items.select("item_id", token_hashes(F.col("text")).alias("ih")), "items")
    aligned = rows.join(hits, ["k1", "k2"]).join(bounded(items), "item_id")
    a = F.expr("slice(h, greatest(shift, 0) + 1, size(ih))")
    b = F.expr("slice(ih, greatest(-shift, 0) + 1, size(ih))")
    equal = F.zip_with(a, b, lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)))

    def most(eq: Column) -> Column:
        def total(part: Column) -> Column:
            return F.aggregate(part, F.lit(0), lambda n, x: n + x)

        windows = F.sequence(F.lit(1), F.size(eq) - (WINDOW - 1))
        best = F.array_max(F.transform(windows, lambda s: total(F.slice(eq, s, WINDOW))))
        whole = F.when(total(eq) == F.size("ih"), F.size("ih"))
        return F.when(F.size("ih") < WINDOW, whole).when(F.size(eq) >= WINDOW, F.when(best >= SAME, best))

    best = aligned.select("k1", "k2", "item_id", let(equal, most).alias("same")).where("same is not null")
    return best.groupBy("k1", "k2", "item_id").agg(F.max("same").alias("same"))


def text_items(benchmark: DataFrame) -> DataFrame:
    """Each distinct text of a benchmark, under an id that is its hash."""
    return benchmark.where("text is not null").select(F.xxhash64("text").alias("item_id"), "text").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_ids, n_items and most_same (of 13 tokens) of every row of
    ``docs`` that overlaps a benchmark item.

    An overlap is 13 tokens in a row, in step with the item's, 11 or more of
    them equal without regard to case and punctuation. An item of fewer tokens
    overlaps where all of them stand in a row, however few they are; they count
    as so many equal ones. Null and empty texts, and those of punctuation, have
    no tokens and no overlap. Items go by their text until the end: equal ones
    are looked for once and all named; those with a null item_id can't be named
    and are not looked for (``clean_documents`` looks for them too). Rows may
    repeat, each is judged; null doc_ids stay null. Without documents or items
    no row comes back. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    named = benchmark.where("item_id is not null and text is not null")
    found = overlaps(docs, text_items(named), scratch).withColumnRenamed("item_id", "text_id")
    names = scratch.stage(named.select(F.xxhash64("text").alias("text_id"), F.col("item_id").cast("long").alias("item_id")).distinct(), "names")
    # a text has no more items than it has seeds, but for equal items
    verdicts = found.join(if_small(names), "text_id").groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("same").alias("same"))
    verdicts = scratch.stage(verdicts, "verdicts")
    rows = docs.select("doc_id", *text_key())
    return (rows.join(bounded(verdicts), ["k1", "k2"])
            .select("doc_id", "item_ids", F.size("item_ids").alias("n_items"), F.col("same").alias("most_same")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text overlaps a benchmark item, whatever
    the item's id: items go by their text here, so one without an id counts.
    Otherwise as ``contaminated``."""
    scratch = Scratch(docs.sparkSession, "clean")
    verdicts = scratch.stage(overlaps(docs, text_items(benchmark), scratch).select("k1", "k2").distinct(), "verdicts")
    verdicts, (v1, v2) = beside(docs, verdicts)
    a, b = free_name(docs, "key_1"), free_name(docs, "key_2")
    k1, k2 = text_key()
    rows = docs.withColumn(a, k1).withColumn(b, k2)
    return rows.join(if_small(verdicts), (rows[a] == v1) & (rows[b] == v2), "left_anti").drop(a, b)
