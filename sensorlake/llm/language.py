"""Language identification by words first, then ever shorter n-grams."""

import itertools
import math
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.common import BATCH_ROWS, Scratch, crc_mod, free_name, small_batches, table
from sensorlake.session import remove_path

#: Words of a language that the model keeps, the most frequent first.
WORDS = 20_000
#: n-grams of each length and language that it keeps.
GRAMS = 5_000
LONGEST = 5
#: A word: a run of letters.
WORD = re.compile(r"[^\W\d_]+")
#: Distinct (word, language) counts that a task gathers before it emits them.
HELD = 200_000
#: Scores of unseen words that a task remembers.
REMEMBERED = 200_000

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over the whole texts of rows with a language."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def flush(held: dict[str, Counter]):
        for lang, c in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c)), pa.array(list(c.values()), pa.int64())], schema=schema)
        held.clear()

    def run(batches):
        held: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
                if sum(map(len, held.values())) > HELD:
                    yield from flush(held)
        yield from flush(held)

    rows = docs.select("lang", "text").where("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def edges(rows: DataFrame, by: list[str], col: str, order: Column, need: Column) -> DataFrame:
    """A row for each group: the value ``_at`` of ``col`` where its first
    ``need`` rows in order of ``col`` end, how many of that value's rows are
    among them (``_left``), and whether all are (``_whole``). Only a histogram
    of ``col`` is ranked."""
    bins = rows.groupBy(*by, col).agg(F.count("*").alias("_m"), F.first(need).alias("_need"))
    before = F.sum("_m").over(Window.partitionBy(*by).orderBy(order)) - F.col("_m")
    bins = bins.withColumn("_before", before).where(F.col("_before") < F.col("_need"))
    edge = F.struct(F.col(col).alias("_at"), (F.col("_need") - F.col("_before")).alias("_left"), (F.col("_before") + F.col("_m") <= F.col("_need")).alias("_whole"))
    return bins.groupBy(*by).agg(F.max_by(edge, "_before").alias("_edge")).select(*by, "_edge.*")


def top(counts: DataFrame, by: list[str], key: str, k: int, scratch: Scratch | None = None) -> DataFrame:
    """The k most frequent of each group, ties to the smaller key. Histograms
    of the counts, then of the first two letters among ties, leave only the
    ties of one beginning to be ranked. Ties and the histograms' ends, a row a
    group, are staged, so that plans stay small; ``counts`` is read three times."""
    scratch, names = scratch or Scratch(counts.sparkSession, "top"), counts.columns
    end = scratch.stage(edges(counts, by, "n", F.desc("n"), F.lit(k)), "end")
    near = counts.join(F.broadcast(end), by)
    sure = near.where((F.col("n") > F.col("_at")) | F.col("_whole") & (F.col("n") == F.col("_at"))).select(names)
    ties = near.where(~F.col("_whole") & (F.col("n") == F.col("_at"))).select(*names, F.col("_left").alias("_need"), F.substring(key, 1, 2).alias("_start"))
    ties = scratch.stage(ties, "ties")
    start = scratch.stage(edges(ties, by, "_start", F.asc("_start"), F.col("_need")), "start")
    near = ties.join(F.broadcast(start), by)
    early = near.where((F.col("_start") < F.col("_at")) | F.col("_whole") & (F.col("_start") == F.col("_at"))).select(names)
    last = near.where(~F.col("_whole") & (F.col("_start") == F.col("_at")))
    last = last.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(key))).where((F.col("_r") <= k) & (F.col("_r") <= F.col("_left"))).select(names)
    return sure.unionAll(early).unionAll(last)


def gram_counts(counts: DataFrame, longest: int) -> DataFrame:
    """(lang, size, gram, n): character n-grams of the words with their ends
    marked, weighted by how often each word occurs."""
    marked = F.concat(F.lit("<"), "word", F.lit(">"))
    sized = counts.select("lang", "n", marked.alias("w"), F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length(marked)))).alias("size"))
    at = F.explode(F.expr("transform(sequence(1, length(w) - size + 1), i -> substring(w, i, size))"))
    return sized.select("lang", "size", "n", at.alias("gram")).groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies by language. What it holds is bounded by WORDS, GRAMS
    and LONGEST for each language, whatever the input."""

    def __init__(self, langs: list[str], prior: list[float], words: dict[str, tuple], grams: list[dict[str, tuple]]):
        self.langs, self.prior, self.words, self.grams = langs, prior, words, grams
        self.seen: dict[str, tuple] = {}

    def word(self, w: str) -> tuple:
        """Log frequency by language: the word's if known, else the mean of
        its longest known n-grams'."""
        if (v := self.words.get(w)) is not None:
            return v
        if (v := self.seen.get(w)) is not None:
            return v
        marked, v = f"<{w}>", None
        for size in range(min(len(self.grams), len(marked)), 0, -1):
            known = self.grams[size - 1]
            hits = [known[g] for i in range(len(marked) - size + 1) if (g := marked[i:i + size]) in known and g not in ("<", ">")]
            if hits:
                v = tuple(sum(c) / len(hits) for c in zip(*hits))
                break
        v = v or (0.0,) * len(self.langs)
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        self.seen[w] = v
        return v

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(WORD.findall((text or "").lower()))
        # number signs like \u00bd or \u2167 are word characters, but no letters
        if not self.langs or not any(map(str.isalpha, itertools.chain.from_iterable(counts))):
            return "und", 0.0
        sums = list(self.prior)
        ways = range(len(sums))
        for w, n in counts.items():
            v = self.word(w)
            for i in ways:
                sums[i] += n * v[i]
        best = max(ways, key=lambda i: (sums[i], -i))
        return self.langs[best], 1 / sum(math.exp(max(-700.0, s - sums[best])) for s in sums)


def log_rows(rows: pa.Table, langs: list[str], key: str) -> dict[str, tuple]:
    """Counts to smoothed log frequencies, relative to the mean language, so
    that a key without evidence adds nothing."""
    at, total, of = {x: i for i, x in enumerate(langs)}, Counter(), {}
    for b in rows.to_batches(max_chunksize=BATCH_ROWS):
        for lang, k, n in zip(*(b.column(c).to_pylist() for c in ("lang", key, "n"))):
            total[lang] += n
            of.setdefault(k, [0] * len(langs))[at[lang]] += n
    out = {}
    for k, counts in of.items():
        logs = [math.log((c + 0.5) / (total[x] + 0.5 * len(of))) for c, x in zip(counts, langs)]
        mean = sum(logs) / len(logs)
        out[k] = tuple(v - mean for v in logs)
    return out


def train(docs: DataFrame, words: int = WORDS, grams: int = GRAMS, longest: int = LONGEST) -> Model:
    """Fit on ``docs`` (text, lang): counts are over all their words; the
    model keeps the most frequent. Rows without text or language teach nothing;
    without any the model knows no language."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "langid")
    counts = scratch.stage(word_counts(docs), "words")
    kept = top(counts, ["lang"], "word", words, scratch).toArrow()
    shaped = scratch.stage(gram_counts(counts, longest), "grams")
    shapes = top(shaped, ["lang", "size"], "gram", grams, scratch).toArrow()
    prior = {r["lang"]: r["n"] for r in docs.where("lang is not null and text is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    remove_path(spark, scratch.root)
    langs = sorted(pc.unique(kept["lang"]).to_pylist())
    n = sum(prior[x] for x in langs) or 1
    by_size = [log_rows(shapes.filter(pc.equal(shapes["size"], s)), langs, "gram") for s in range(1, longest + 1)]
    return Model(langs, [math.log(prior[x] / n) for x in langs], log_rows(kept, langs, "word"), by_size)


def predictor(spark, model: Model) -> Column:
    """A function of a text column: lang_pred and score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(x) for x in text], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model, out: str) -> DataFrame:
    """``docs`` with a struct ``out`` of lang_pred and score (0 to 1, the
    posterior of the predicted language).

    A null text, or one without a letter (number signs are none), is ``und`` with score 0, as is any
    text if the model knows no language. Words of letters no n-gram knows add
    nothing: the language is then the most frequent one. Ties go to the
    language first by code point. Rows stay as they are, repeated ones too;
    an empty table gives no row.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(out, predictor(docs.sparkSession, model)(F.col("text")))


def op4_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = train(docs.where(~F.coalesce(held, F.lit(False))))
    found = identify(docs.select("doc_id", "text", held.alias("held_out")), model, "found")
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without rows that have no letter or whose language's posterior
    is under ``least``. The model is learnt from the rows' own labels; if no
    row has one, nothing is known and all rows stay."""
    out, model = free_name(docs, "found"), train(docs.select("text", "lang"))
    if not model.langs:
        return docs
    found = identify(docs, model, out)
    return found.where((F.col(f"{out}.lang_pred") != "und") & (F.col(f"{out}.score") >= least)).drop(out)
