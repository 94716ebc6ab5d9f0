"""Source divergence audit: how far the term frequencies of each source are
from those of its language and of the language's other sources.

The kept terms are sorted by language and term. Each range of them becomes a
minimal acyclic transducer, a file in the shared folder that maps a term to
its lexicographic ordinal and back. All texts are streamed through the
transducers again, so that only ordinals and counts are shuffled, and ordinals
break ties in place of terms.
"""

import bisect
import json
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import Commit, Scratch, filesystem, small_batches, sorted_blocks, starts, table
from sensorlake.operators.joins import bounded_broadcast

#: Every byte that is no part of a term becomes a space, A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Distinct terms that a task counts before it emits them.
HELD = 400_000
#: Terms of one transducer at most.
SHARD = 500_000
#: Bytes of transducers that a pass over the texts loads; more take more passes.
LOADED = 256 << 20
#: Cells of a block's matrix of sources and ordinals.
CELLS = 1 << 16
SCALE = 1_000_000_000
SMOOTH = 5


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and of anything beyond ASCII."""
    return text.translate(TERM_BYTES).split()


class Transducer:
    """A minimal acyclic automaton over sorted distinct byte strings. Each edge
    carries how many strings come before those that take it, so the sum along
    a path is the string's ordinal. Edges are arrays sorted by (node, byte);
    many strings walk at once."""

    def __init__(self, root: int, final: np.ndarray, keys: np.ndarray, targets: np.ndarray, skips: np.ndarray):
        self.root, self.final, self.keys, self.targets, self.skips = root, final, keys, targets, skips

    @classmethod
    def build(cls, strings) -> "Transducer":
        """Suffix states are merged as soon as the sorted input has left them."""
        register, nodes, below = {}, [], []

        def settle(final: bool, edges: list) -> int:
            state = (final, tuple(edges))
            if (number := register.get(state)) is None:
                number = register[state] = len(nodes)
                nodes.append(state)
                below.append(final + sum(below[t] for _, t in edges))
            return number

        path, last = [[False, []]], b""  # the states along the last string, not yet settled
        for s in strings:
            shared = 0
            while shared < len(last) and shared < len(s) and last[shared] == s[shared]:
                shared += 1
            while len(path) > shared + 1:
                final, edges = path.pop()
                path[-1][1].append((last[len(path) - 1], settle(final, edges)))
            path += [[False, []] for _ in range(len(s) - shared)]
            path[-1][0], last = True, s
        while len(path) > 1:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, edges)))
        root = settle(*path[0])
        keys, targets, skips = [], [], []
        for n, (final, edges) in enumerate(nodes):
            before = int(final)
            for label, t in edges:
                keys.append(n << 8 | label)
                targets.append(t)
                skips.append(before)
                before += below[t]
        return cls(root, np.array([f for f, _ in nodes], bool), np.array(keys, np.int64), np.array(targets, np.int32), np.array(skips, np.int64))

    def ordinals(self, strings: list[bytes]) -> np.ndarray:
        """The ordinal of each string, -1 for those not held."""
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        data, at = np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size
        state, total = np.full(len(strings), self.root, np.int64), np.zeros(len(strings), np.int64)
        live, depth = np.arange(len(strings)), 0
        while True:
            done = live[size[live] == depth]
            total[done[~self.final[state[done]]]] = -1
            live = live[size[live] > depth]
            if not len(live):
                return total
            key = state[live] << 8 | data[at[live] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            known = self.keys[edge] == key if len(self.keys) else np.zeros(len(live), bool)
            total[live[~known]] = -1
            live, edge = live[known], edge[known]
            state[live], depth = self.targets[edge], depth + 1
            total[live] += self.skips[edge]

    def string(self, ordinal: int) -> bytes:
        """The string with this ordinal."""
        state, out = self.root, bytearray()
        while True:
            if self.final[state] and ordinal == 0:
                return bytes(out)
            a, z = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            edge = a + int(np.searchsorted(self.skips[a:z], ordinal, "right")) - 1
            out.append(int(self.keys[edge]) & 255)
            ordinal -= int(self.skips[edge])
            state = int(self.targets[edge])

    def dump(self) -> bytes:
        head = json.dumps([self.root, len(self.final), len(self.keys)]).encode() + b"\n"
        return head + b"".join(x.tobytes() for x in (self.keys, self.skips, self.targets, self.final))

    @classmethod
    def load(cls, data: bytes) -> "Transducer":
        head, _, body = data.partition(b"\n")
        root, n, m = json.loads(head)
        return cls(root, np.frombuffer(body, bool, n, 20 * m), np.frombuffer(body, np.int64, m), np.frombuffer(body, np.int32, m, 16 * m), np.frombuffer(body, np.int64, m, 8 * m))


@lru_cache(maxsize=1)
def loaded(folder: str, files: tuple) -> list[Transducer]:
    fs, root = filesystem(folder)
    out = []
    for name in files:
        with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
            out.append(Transducer.load(f.read()))
    return out


def plain_columns(docs: DataFrame) -> DataFrame:
    """lang and source with nulls as empty strings, the text as bytes."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.col("text").cast("binary").alias("text"))


def document_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, n): in how many rows of a language a term occurs."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("n", pa.int64())])

    def flush(held):
        for lang, c in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], schema=schema)
        held.clear()

    def run(batches):
        held = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                if text:
                    held.setdefault(lang, Counter()).update(set(terms_of(text)))
            if sum(map(len, held.values())) > HELD:
                yield from flush(held)
        yield from flush(held)

    found = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def build_vocabulary(kept: DataFrame, folder: str, shard: int) -> DataFrame:
    """Write the transducers of the kept terms (lang, term); returns a row for
    each: lang, first term, terms, file, bytes."""
    schema = pa.schema([("lang", pa.string()), ("first", pa.binary()), ("terms", pa.int64()), ("file", pa.string()), ("bytes", pa.int64())])

    def written(lang, strings):
        name = f"{hash_name(lang, strings[0]):032x}.dawg"
        out = Commit(folder, name)
        out.write(Transducer.build(strings).dump())
        out.close()
        return pa.RecordBatch.from_pylist([{"lang": lang, "first": strings[0], "terms": len(strings), "file": name, "bytes": out.size}], schema=schema)

    def run(batches):
        lang, held = None, []
        for b in batches:
            for x, term in zip(b.column("lang").to_pylist(), b.column("term").to_pylist()):
                if held and (x != lang or len(held) == shard):
                    yield written(lang, held)
                    held = []
                lang = x
                held.append(term)
        if held:
            yield written(lang, held)

    dealt = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(run, "lang string, first binary, terms long, file string, bytes long")


def hash_name(lang: str, first: bytes) -> int:
    """A file's name follows from what it holds first, so that a task that runs
    twice writes the same file."""
    return xxhash.xxh3_128_intdigest(lang.encode() + b"\0" + first)


class Vocabulary:
    """The transducers by language: files, first terms and the ordinal each
    begins with. One row a file is held, not the terms."""

    def __init__(self, folder: str, rows: list):
        self.folder, self.rows, base = folder, [], Counter()
        for r in sorted(rows, key=lambda r: (r["lang"], bytes(r["first"]))):
            self.rows.append({"lang": r["lang"], "first": bytes(r["first"]), "file": r["file"], "bytes": r["bytes"], "base": base[r["lang"]]})
            base[r["lang"]] += r["terms"]
        self.size = dict(base)

    def passes(self, most: int) -> list[list[dict]]:
        """The files in groups of at most ``most`` bytes, one file at least."""
        out, size = [], most + 1
        for r in self.rows:
            if size + r["bytes"] > most:
                out.append([])
                size = 0
            out[-1].append(r)
            size += r["bytes"]
        return out

    def counts(self, docs: DataFrame, rows: list[dict]) -> DataFrame:
        """(lang, source, ord, n): occurrences of the terms of some files."""
        folder, schema = self.folder, pa.schema([("lang", pa.string()), ("source", pa.string()), ("ord", pa.int64()), ("n", pa.int64())])
        files = tuple(r["file"] for r in rows)
        of = {}
        for i, r in enumerate(rows):
            of.setdefault(r["lang"], []).append((r["first"], i, r["base"]))

        def flush(held):
            machines, of_lang = loaded(folder, files), {}
            for (lang, source), c in held.items():
                of_lang.setdefault(lang, []).append((source, c))
            for lang, some in of_lang.items():
                # the sources of a language share most terms: each walks once
                terms, known = sorted(set().union(*(c for _, c in some))), {}
                edges = [bisect.bisect_left(terms, first) for first, _, _ in of[lang]] + [len(terms)]
                for (_, i, base), a, z in zip(of[lang], edges, edges[1:]):
                    ordinal = machines[i].ordinals(terms[a:z])
                    hits = np.flatnonzero(ordinal >= 0)
                    known.update(zip((terms[a + k] for k in hits.tolist()), (ordinal[hits] + base).tolist()))
                for source, c in some:
                    both = known.keys() & c.keys()
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(both), pa.string()), pa.array([source] * len(both), pa.string()),
                                                      pa.array([known[t] for t in both], pa.int64()), pa.array([c[t] for t in both], pa.int64())], schema=schema)
            held.clear()

        def run(batches):
            held = {}
            for b in batches:
                for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text").to_pylist()):
                    if text and lang in of:
                        held.setdefault((lang, source), Counter()).update(terms_of(text))
                if sum(map(len, held.values())) > HELD:
                    yield from flush(held)
            yield from flush(held)

        return docs.mapInArrow(run, "lang string, source string, ord long, n long")

    def decoded(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` (with lang and ord) with the term of each ordinal; one
        transducer at a time is held."""
        folder, of = self.folder, {}
        for r in self.rows:
            of.setdefault(r["lang"], ([], []))[0].append(r["base"])
            of[r["lang"]][1].append(r["file"])
        schema = pa.schema([*[(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[f.dataType.simpleString()]) for f in df.schema], (column, pa.string())])

        def run(batches):
            for b in batches:
                out = []
                for lang, number in zip(b.column("lang").to_pylist(), b.column("ord").to_pylist()):
                    bases, files = of[lang]
                    i = bisect.bisect_right(bases, number) - 1
                    out.append(loaded(folder, (files[i],))[0].string(number - bases[i]).decode())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], schema=schema)

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return df.sortWithinPartitions("lang", "ord").mapInArrow(run, f"{kinds}, {column} string")


def probability(count: str, total: str, terms: str):
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exactly."""
    return F.expr(f"1 + (cast({SCALE} as decimal(38, 0)) * ({count} + {SMOOTH})) div (cast({total} as decimal(20, 0)) + {SMOOTH} * {terms})")


def pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) with a before b: the distance of two sources summed
    over all kept terms. A task has all sources of a language for one range of
    ordinals as a matrix of at most CELLS cells; terms that a source lacks have
    its p of a zero count. Partial sums are added up over the ranges."""
    width = F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("sources"))).cast("long")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.max("terms").alias("terms")).select("lang", width.alias("width"))
    sized = groups.join(bounded_broadcast(langs), "lang")
    empty = F.when(F.col("terms") > 0, probability("0", "total", "terms")).otherwise(F.lit(0))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.floor((F.col("terms") - 1) / F.col("width"))).cast("long")))
    heads = sized.select("lang", "source", empty.alias("p"), "terms", "width", blocks.alias("block"))
    heads = heads.select("lang", "block", "source", F.least(F.col("width"), F.col("terms") - F.col("block") * F.col("width")).alias("at"), "p", F.lit(0).alias("kind"))
    cells = counts.join(bounded_broadcast(sized), ["lang", "source"])
    cells = cells.select("lang", F.floor(F.col("ord") / F.col("width")).cast("long").alias("block"), "source", (F.col("ord") % F.col("width")).alias("at"),
                         probability("n", "total", "terms").alias("p"), F.lit(1).alias("kind"))
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

    def run(batches):
        for t in sorted_blocks(batches, ["lang", "block"]):
            at = starts(t, ["lang", "block"])
            for a, z in zip(at.tolist(), np.append(at[1:], t.num_rows).tolist()):
                part = t.slice(a, z - a).combine_chunks()
                kind, p, place = (part.column(c).to_numpy() for c in ("kind", "p", "at"))
                source = part.column("source").to_pylist()
                names = [source[i] for i in np.flatnonzero(kind == 0)]  # in order
                wide = int(place[kind == 0].max(initial=0))
                m = np.repeat(p[kind == 0][:, None], wide, axis=1)
                number = {x: i for i, x in enumerate(names)}
                rows = np.flatnonzero(kind == 1)
                m[[number[source[i]] for i in rows], place[rows]] = p[rows]
                for i in range(len(names) - 1):
                    sums = np.abs(m[i + 1:] - m[i]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array([part.column("lang")[0].as_py()] * len(sums), pa.string()), pa.array([names[i]] * len(sums), pa.string()), pa.array(names[i + 1:], pa.string()), pa.array(sums)], schema=schema)

    dealt = heads.unionByName(cells).repartition("lang", "block").sortWithinPartitions("lang", "block", "kind", "source")
    return dealt.mapInArrow(run, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50, scratch: Scratch | None = None, shard: int = SHARD, most: int = LOADED) -> DataFrame:
    """lang, source, part, item, value, rank for ``docs`` (text, lang, source).

    A language keeps the terms that ``least_docs`` of its documents hold. Part
    ``pair`` compares a source with each other source of its language, part
    ``term`` gives the ``top`` terms that it uses more than its language does.
    Ranks go by value, ties by the item's UTF-8 bytes.

    Null text, lang and source are empty strings; every row is a document,
    repeated rows too. A source without kept terms has a count of zero for each
    term; a language without kept terms has pairs of value 0 and no term rows;
    a language with one source has no pairs; an empty table gives no row. Other
    columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = scratch or Scratch(spark, "divergence")
    docs = plain_columns(docs)
    kept = document_counts(docs).where(F.col("n") >= least_docs).select("lang", "term")
    folder = scratch.path("vocabulary")
    files = scratch.stage(build_vocabulary(scratch.stage(kept, "kept"), folder, shard), "transducers")
    words = Vocabulary(folder, files.collect())  # a row for each file of up to ``shard`` terms
    found = None
    for rows in words.passes(most):
        one = words.counts(docs, rows)
        found = one if found is None else found.unionAll(one)
    if found is None:
        found = spark.createDataFrame([], "lang string, source string, ord long, n long")
    counts = scratch.stage(found.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n")), "counts")
    sizes = files.groupBy("lang").agg(F.sum("terms").alias("terms"))
    groups = (docs.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(bounded_broadcast(sizes), "lang", "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms")))
    groups = scratch.stage(groups, "groups")

    half = scratch.stage(pair_sums(counts, groups), "pairs")
    pairs = half.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionAll(half.select("lang", F.col("b"), F.col("a"), "value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))

    whole = counts.groupBy("lang", "ord").agg(F.sum("n").alias("n_lang"))
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("total_lang"))
    cells = (counts.join(whole, ["lang", "ord"]).join(bounded_broadcast(groups), ["lang", "source"]).join(bounded_broadcast(of_lang), "lang")
             .select("lang", "source", "ord", (probability("n", "total", "terms") - probability("n_lang", "total_lang", "terms")).alias("value")).where("value > 0"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    best = cells.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    terms = words.decoded(best, "item").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
cell AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c FROM grp g JOIN kept k USING (lang) LEFT JOIN cnt USING (lang, source, term)),
p AS (
  SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM cell JOIN size USING (lang)
), lc AS (SELECT lang, term, sum(c) AS c FROM cell GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang) + 5 * v) AS q FROM lc JOIN size USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS a, y.source AS b, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s
    ON s.lang = a.lang AND s.a = a.source AND s.b = b.source
), terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 50
"""
