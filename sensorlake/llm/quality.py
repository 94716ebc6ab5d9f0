"""Document quality: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, crc_mod, parts, small_batches, table

#: Length of a word vector, signed ones in an index vector, neighbours on each side.
DIM = 64
ONES = 4
REACH = 2
#: Words with a vector of their own; others share one for each shape and end.
WORDS = 8_192
#: Labelled rows that the network learns from and is calibrated on, at most:
#: those with the smallest hash of their doc_id.
SAMPLE = 16_000
HIDDEN = 32
EPOCHS = 60
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|\n")
#: The same for texts of ASCII and Latin letters only, with classes that match faster.
PLAIN = re.compile(r"[\t\n\x20-\x7E\u00C0-\u024F]*")
PLAIN_TOKEN = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+|[0-9]+|[!-/:-@\[-^`{-~\u00D7\u00F7]+|\n")
#: Distinct words a task counts before it emits them.
HELD = 200_000
#: Tokens whose neighbours are added up at once.
PIECE = 500_000


def shape(word: str) -> str:
    """What stands for a word without a vector: its kind, case, length and end."""
    kind = "a" if word.isalpha() else "0" if word.isdigit() else "#"
    case = "A" if word.isupper() and len(word) > 1 else "T" if word[:1].isupper() else "a"
    return f"\0{kind}{case}{min(len(word), 12)}{word[-1:].lower()}" if kind != "#" else f"\0#{min(len(word), 6)}{word[:1]}"


def kind(word: str) -> int:
    return word.isalpha() + 2 * (len(word) > 1 and word.isupper())


def tokens(text: str | None) -> list[str]:
    text = text or ""
    return (PLAIN_TOKEN if PLAIN.fullmatch(text) else TOKEN).findall(text)


CODED = pa.schema([("doc_id", pa.int64()), ("words", pa.string()), ("codes", pa.binary()), ("lines", pa.int32()), ("unlike", pa.int32())])


def code(text: str | None) -> tuple[str | None, bytes, int, int]:
    """A text's distinct tokens, parted by spaces (no token holds one; null if
    there are none), the number among them of each token as 32-bit integers,
    its lines and its distinct lines."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    codes = np.fromiter(map(number.__getitem__, tokens(text)), np.int32)
    lines = (text or "").split("\n")
    return " ".join(number) if number else None, codes.tobytes(), len(lines), len(set(lines))


def tokenised(docs: DataFrame) -> DataFrame:
    """doc_id and ``code`` of every row of ``docs`` (doc_id, text). Staged, it
    spares every later step the texts."""

    def run(batches):
        for b in batches:
            columns = zip(*map(code, b.column("text").to_pylist())) if b.num_rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(CODED)[1:]))], schema=CODED)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, words string, codes binary, lines int, unlike int")


class Coded:
    """A batch of coded texts: the distinct words of each, one text after
    another, as numbers in a list of the batch's words, and the place among them
    of each token."""

    def __init__(self, batch: pa.RecordBatch):
        split = pc.split_pattern(batch.column("words"), " ")
        self.held = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = split.flatten().dictionary_encode()
        self.words, self.which = flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False)
        codes = batch.column("codes")
        self.sizes = pc.binary_length(codes).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        self.first = np.cumsum(self.held) - self.held
        self.codes = np.frombuffer(b"".join(codes.to_pylist()), np.int32) + np.repeat(self.first, self.sizes)
        self.times = np.bincount(self.codes, minlength=len(self.which))
        self.lines, self.unlike = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lines", "unlike"))


def frequent_words(coded: DataFrame, k: int) -> list[str]:
    """The k most frequent tokens over all whole texts, ties by token."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        held: defaultdict = defaultdict(int)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)

        for b in batches:
            c = Coded(b)
            for w, n in zip(c.words, np.bincount(c.which, weights=c.times, minlength=len(c.words)).astype(np.int64).tolist()):
                held[w] += n
            if len(held) > HELD:
                yield rows()
                held.clear()
        yield rows()

    counts = coded.select("words", "codes", "lines", "unlike").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(k).collect()]


class Vocabulary:
    """Row numbers of words: those of the list, and a hashed row for the shape
    of any other."""

    SHAPES = 2048

    def __init__(self, words: list[str]):
        self.words, self.rows = words, len(words) + self.SHAPES
        self.forget()

    def __getstate__(self):
        return {"words": self.words, "rows": self.rows}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.forget()

    def forget(self) -> None:
        """Keeps what the list says only: the row, and 1 for letters plus 2 for
        capitals, of each word seen."""
        self.row, self.kind = {w: i for i, w in enumerate(self.words)}, {w: kind(w) for w in self.words}

    def meet(self, words) -> None:
        """Makes sure that the words are known."""
        if new := set(words).difference(self.row):
            if len(self.row) > len(self.words) + HELD:
                self.forget()
                new = set(words).difference(self.row)
            for w in new:
                self.row[w] = self.rows - 1 - zlib.crc32(shape(w).encode("utf-8", "replace")) % self.SHAPES
                self.kind[w] = kind(w)

    def rows_of(self, words: list[str]) -> np.ndarray:
        self.meet(words)
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))

    def kinds_of(self, words: list[str]) -> np.ndarray:
        self.meet(words)
        return np.fromiter(map(self.kind.__getitem__, words), np.int64, len(words))

    def encode(self, text: str | None) -> np.ndarray:
        found = tokens(text)
        self.meet(found)
        return np.array([*map(self.row.__getitem__, found)], np.int64)


def index_vectors(rows: int, dim: int = DIM, ones: int = ONES) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each row's index vector, from a fixed seed."""
    rng = np.random.default_rng(20_260)
    return rng.integers(0, dim, (rows, ones)), rng.choice([-1.0, 1.0], (rows, ones))


def context_sums(docs: DataFrame, words: list[str]) -> np.ndarray:
    """``neighbour_sums`` of texts (text) as they are."""
    return neighbour_sums(tokenised(docs.select(F.lit(None).alias("doc_id"), "text")), words)


def neighbour_sums(coded: DataFrame, words: list[str]) -> np.ndarray:
    """For each row of the vocabulary the sum of its neighbours' index vectors
    over all whole texts. A task adds up a matrix of fixed size and emits its
    rows, which are dealt by word and added again."""
    vocabulary = Vocabulary(words)
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("word", pa.int32()), ("x", pa.binary())])

    def run(batches):
        v = shared.value
        places, signs = index_vectors(v.rows)
        total = np.zeros(v.rows * DIM)
        for b in batches:
            c = Coded(b)
            # texts are parted by rows that count for nothing
            ids = np.full(len(c.codes) + REACH * len(c.sizes), -1, np.int64)
            ids[np.arange(len(c.codes)) + REACH * np.repeat(np.arange(len(c.sizes)), c.sizes)] = v.rows_of(c.words)[c.which][c.codes]
            for part in range(0, len(ids), PIECE):
                # links from the piece's words to those after them, in the next piece too
                for step in range(1, REACH + 1):
                    two = ids[part:part + PIECE]
                    one = ids[part + step:part + step + PIECE]
                    two = two[:len(one)]
                    ok = (one >= 0) & (two >= 0)
                    one, two = one[ok], two[ok]
                    for w, near in ((one, two), (two, one)):
                        for k in range(places.shape[1]):
                            total += np.bincount(w * DIM + places[near, k], weights=signs[near, k], minlength=len(total))
        total = total.reshape(-1, DIM).astype(np.float32)
        at = np.flatnonzero(total.any(axis=1))
        for i in range(0, len(at), 10_000):
            yield rows(at[i:i + 10_000], total)

    def rows(at: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([x.tobytes() for x in total[at]], pa.binary())], schema=schema)

    def add_up(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for w, x in zip(b.column("word").to_pylist(), b.column("x").to_pylist()):
                total[w] = total.get(w, 0) + np.frombuffer(x, np.float32).astype(np.float64)
        at = np.array(sorted(total), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([total[w].astype(np.float32).tobytes() for w in at.tolist()], pa.binary())], schema=schema)

    parts_of = coded.select("words", "codes", "lines", "unlike").mapInArrow(run, "word int, x binary")
    sums = parts_of.repartition(parts(coded.sparkSession), "word").mapInArrow(add_up, "word int, x binary").toPandas()  # a row for each word of the vocabulary
    out = np.zeros((vocabulary.rows, DIM))
    for w, x in zip(sums["word"], sums["x"]):
        out[w] = np.frombuffer(x, np.float32)
    return out


class Features:
    """A document's pooled word vectors: their mean and spread, the vector of
    the words' shapes, and how often words come back."""

    def __init__(self, words: list[str], context: np.ndarray):
        self.vocabulary = Vocabulary(words)
        places, signs = index_vectors(len(context))
        own = np.zeros_like(context)
        for k in range(places.shape[1]):
            np.add.at(own, (np.arange(len(own)), places[:, k]), signs[:, k])
        length = np.linalg.norm(context, axis=1, keepdims=True)
        # a word's contexts and the word itself, of equal length
        self.vectors = np.hstack([context / np.where(length > 0, length, 1), own / np.sqrt(ONES)]).astype(np.float32)

    def __call__(self, c: Coded) -> np.ndarray:
        """A row for each text of the batch."""
        row, kinds = self.vocabulary.rows_of(c.words)[c.which], self.vocabulary.kinds_of(c.words)[c.which]
        out = np.zeros((len(c.sizes), 2 * self.vectors.shape[1] + 8), np.float32)
        for i, (at, held, n) in enumerate(zip(c.first.tolist(), c.held.tolist(), c.sizes.tolist())):
            if not n:
                continue
            x, times = self.vectors[row[at:at + held]], c.times[at:at + held].astype(np.float32)
            mean = times @ x / n
            spread = np.sqrt(np.maximum(times @ (x * x) / n - mean * mean, 0))
            letters, upper = float(times @ (kinds[at:at + held] & 1)), float(times @ (kinds[at:at + held] >> 1))
            breaks = c.lines[i] - 1
            rest = [np.log1p(n), held / n, upper / max(letters, 1), letters / n, breaks / n,
                    c.unlike[i] / c.lines[i], times.max() / n, min(1.0, 50 / n)]
            out[i] = np.concatenate([mean, spread, rest])
        return out


class Network:
    """tanh layer and a logistic one, fitted by Adam; its logit is divided by a
    temperature fitted on rows that it has not learnt from."""

    def __init__(self, seed: int = 7):
        self.rng, self.temperature, self.shift = np.random.default_rng(seed), 1.0, 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -60, 60)))

    def fit(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS) -> "Network":
        fold = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.zeros(len(y), bool)
        train, rest = ~fold, fold if fold.any() else np.ones(len(y), bool)
        self.mean, self.scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
        a, t = (x[train] - self.mean) / self.scale, y[train].astype(float)
        r, d = self.rng, x.shape[1]
        p = [r.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), r.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
        for _ in range(epochs):
            for at in np.array_split(r.permutation(len(t)), max(1, len(t) // 128)):
                z = np.tanh(a[at] @ p[0] + p[1])
                e = (1 / (1 + np.exp(-np.clip(z @ p[2] + p[3], -60, 60))) - t[at]) / len(at)
                back = np.outer(e, p[2]) * (1 - z * z)
                step += 1
                for i, g in enumerate((a[at].T @ back + 1e-4 * p[0], back.sum(axis=0), z.T @ e + 1e-4 * p[2], np.array([e.sum()]))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p[i] = p[i] - 2e-3 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.w1, self.b1, self.w2, self.b2 = p[0], p[1], p[2], p[3][0]
        z, t = self.logit(x[rest]), y[rest].astype(float)
        loss = {k: np.logaddexp(0, np.where(t > 0.5, -z, z) / k).mean() for k in np.geomspace(0.25, 8, 61)}
        self.temperature = float(min(loss, key=lambda k: (loss[k], k)))
        return self


class Constant:
    """Where nothing, or one class only, is labelled."""

    def __init__(self, p: float):
        self.p = p

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.p)


def chosen_labels(labels: DataFrame, sample: int) -> dict[int, int]:
    """The quality of at most ``sample`` labelled documents; a doc_id labelled
    more than once counts by its lowest label."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("quality"))
    return {r["id"]: r["quality"] for r in known.orderBy(F.xxhash64("id"), "id").limit(sample).collect()}


def train(docs: DataFrame, labels: DataFrame, words: int = WORDS, sample: int = SAMPLE) -> tuple:
    """``train_on`` of texts (doc_id, text), tokenised and staged."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "quality")
    coded = scratch.stage(tokenised(docs), "coded")
    model = train_on(coded, labels, words, sample)
    scratch.drop(coded)
    return model


def train_on(coded: DataFrame, labels: DataFrame, words: int = WORDS, sample: int = SAMPLE) -> tuple:
    """Word vectors from all texts of ``coded`` (staged ``tokenised``); the
    network from those that ``labels`` (doc_id, quality) marks, up to ``sample``."""
    spark = coded.sparkSession
    small_batches(spark)
    vocabulary = frequent_words(coded, words)
    features = Features(vocabulary, neighbour_sums(coded, vocabulary))
    chosen = chosen_labels(labels, sample)
    if not chosen:
        return features, Constant(0.5)
    shared = spark.sparkContext.broadcast((features, chosen))
    schema = pa.schema([("id", pa.int64()), ("quality", pa.int32()), ("x", pa.list_(pa.float32()))])
    ids = pa.array(sorted(chosen), pa.int64())

    def run(batches):
        features, chosen = shared.value
        for b in batches:
            b = b.filter(pc.is_in(b.column("doc_id"), value_set=ids))
            if b.num_rows:
                marks = [chosen[i] for i in b.column("doc_id").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(marks, pa.int32()), pa.array([*features(Coded(b))], pa.list_(pa.float32()))], schema=schema)

    known = coded.mapInArrow(run, "id long, quality int, x array<float>")
    # repeated documents count once, so that the sample's bound holds here too
    rows = known.groupBy("id").agg(F.min(F.struct("x", "quality")).alias("r")).orderBy("id").select("r.*").collect()
    y = np.array([r["quality"] > 0 for r in rows], bool)
    if not len(y) or y.all() or not y.any():
        return features, Constant(float(y.mean()) if len(y) else 0.5)
    return features, Network().fit(np.array([r["x"] for r in rows], np.float64), y)


def score_coded(coded: DataFrame, model: tuple) -> DataFrame:
    """doc_id and score, the probability (0 to 1) of label 1, of every row of
    ``tokenised`` texts; texts without a token have a score like any other."""
    shared = coded.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        features, network = shared.value
        for b in batches:
            if b.num_rows:
                p = network.probability(features(Coded(b)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p, pa.float64())], schema=schema)

    return coded.mapInArrow(run, "doc_id long, score double")


def scorer(spark: SparkSession, model: tuple) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        features, network = shared.value
        if not len(text):
            return pd.Series([], dtype="float64")
        columns = zip(*map(code, text))
        rows = pa.RecordBatch.from_arrays([pa.nulls(len(text), pa.int64()), *(pa.array(c, f.type) for c, f in zip(columns, list(CODED)[1:]))], schema=CODED)
        return pd.Series(network.probability(features(Coded(rows)).astype(np.float64)), dtype="float64")

    return score


def score_quality(docs: DataFrame, model: tuple, out: str) -> DataFrame:
    """``docs`` with ``out``, the probability (0 to 1) of label 1.

    Null and empty texts have the features of an empty text and a score like
    any other. Without labelled rows every score is 0.5, and with one class
    only that class. Rows stay as they are, repeated ones too; an empty table
    gives no row.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(out, scorer(docs.sparkSession, model)(F.col("text")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, x) for x in ("documents", "labels"))
    small_batches(spark)
    coded = Scratch(spark, "quality").stage(tokenised(docs), "coded")
    model = train_on(coded, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    held = crc_mod(F.col("doc_id"), 5) == 0
    return score_coded(coded, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
