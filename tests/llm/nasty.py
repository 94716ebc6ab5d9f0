"""Small tables with everything that rows can hold, and clashing columns."""

import random

from pyspark.sql import functions as F

#: Names that operators use within; a table may hold columns of these names.
CLASHING = ["text_hash", "fp", "label", "component_id", "found", "score", "lang_pred", "held_out", "k1", "k2", "seed", "seeds", "place", "h",
            "size", "taken", "target", "start", "row", "at", "id_hash", "i", "s", "times", "turn_", "best", "lost_id", "digest", "n", "packed"]


def words(rng, n, vocabulary=("ab", "cd", "ef", "the", "of", "and", "x1", "Zz", "hé")):
    return " ".join(rng.choice(vocabulary) + str(rng.randrange(60)) for _ in range(n))


def documents(rows=60, seed=1):
    """(doc_id, text, lang, source) tuples: nulls in each column, empty and
    blank texts, exact and near copies, repeated rows, one long text."""
    rng = random.Random(seed)
    out = [(i, words(rng, rng.randrange(1, 90)), rng.choice(["en", "de"]), rng.choice(["a", "b", "é", None])) for i in range(rows)]
    base = words(rng, 80)
    out += [(1000 + i, base, "en", "a") for i in range(5)]
    out += [(1100 + i, base + f" tail{i}", "en", "b") for i in range(30)]
    out += [(2000, None, "en", "a"), (2001, "", "de", "b"), (2002, " \t\n\x0b ", None, "a"), (None, words(rng, 50), "en", "a"), (None, None, None, None),
            (2003, "123 456 !!", "en", "a"), (2004, "  lead\ttabs \n\n trail  ", "de", None), (2005, "x" * 700, "en", "b"), (2006, "日本語 テキスト 한국어", None, "c"),
            (2007, words(rng, 40_000), "en", "a"), (2008, "don't they're <|endoftext|> é   ﬁ\x1cx I'LL", "en", "b")]
    return out + [out[3], out[3], out[62], (2001, "", "de", "b")]


def document_frame(spark, rows=None, clashing=True):
    rows = documents() if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    return df.select("*", *[F.lit(f"old {c}").alias(c) for c in CLASHING]) if clashing else df


def empty(df):
    return df.where(F.lit(False))
