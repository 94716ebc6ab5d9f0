"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Rows of equal vectors are one node of the graph; a list of a node's smallest
ids stands for them, so that thousands of copies neither crowd each other's
neighbours out nor make a group of their own.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch, if_small, parts, table

#: Neighbours kept of each node.
DEGREE = 32
#: Orders of random projections that the first graph is drawn from, and the rows of a block.
ORDERS = 6
LEAF = 64
#: Rounds of neighbours of neighbours go on until a smaller share of the links is new.
SETTLED = 0.02
#: Nodes that a query holds on to while it searches.
BEAM = 256
#: Queries whose vectors are broadcast, at most; more of them are joined by a shuffle.
QUERIES = 10_000
#: Nodes that every search may begin at.
ENTRIES = 128


def usable(v: str) -> Column:
    """Vectors that are null, zero, or hold null or non-finite components take no part."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(v).isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)


def vectors(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    column = batch.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


LINK = "node long, near long, d double"


def links_of(ids: np.ndarray, x: np.ndarray, k: int, limit: np.ndarray | None = None, fresh: np.ndarray | None = None):
    """Each row's k nearest others within a block, nearer than ``limit``; only
    pairs of which one is ``fresh``, if that is given."""
    d = squared(x, x)
    np.fill_diagonal(d, np.inf)
    if fresh is not None:
        d[np.ix_(~fresh, ~fresh)] = np.inf
    k = min(k, len(ids) - 1)
    if k <= 0:
        return None
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    node, to, dist = np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(d, near, 1).ravel()
    if limit is not None:
        ok = dist < np.repeat(limit, k)
        node, to, dist = node[ok], to[ok], dist[ok]
    return node, to, dist


def link_batch(found: list) -> pa.RecordBatch:
    cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["node", "near", "d"])


def first_links(nodes: DataFrame, dim: int, degree: int) -> DataFrame:
    """Links within blocks of LEAF nodes that are next to each other in the
    order of random projections: signs of some, then the value of another."""
    spark = nodes.sparkSession
    rng = np.random.default_rng(3)
    planes = rng.normal(size=(ORDERS, 5, dim))

    def keys(batches):
        for b in batches:
            x = vectors(b, "v")
            for o in range(ORDERS):
                p = x @ planes[o].T
                # signs around the middle of the projections seen from the origin
                sign = (p[:, 1:] > 0) @ (1 << np.arange(4))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), o, np.int32)), pa.array(sign.astype(np.int32)), pa.array(p[:, 0]), b.column("id"), b.column("v")], names=["o", "sign", "p", "id", "v"])

    def block(batches):
        held, size = [], 0

        def cut(t: pa.Table):
            ids, x, o = t.column("id").to_numpy(), vectors(t, "v"), t.column("o").to_numpy()
            out = []
            for at in range(0, len(ids), LEAF):
                for k in np.unique(o[at:at + LEAF]):
                    s = np.flatnonzero(o[at:at + LEAF] == k) + at
                    out.append(links_of(ids[s], x[s], degree))
            return link_batch([x for x in out if x])

        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= 32 * LEAF:
                t = pa.Table.from_batches(held)
                n = size // LEAF * LEAF
                yield cut(t.slice(0, n))
                held, size = t.slice(n).combine_chunks().to_batches(), size - n
        if size:
            yield cut(pa.Table.from_batches(held))

    keyed = nodes.mapInArrow(keys, "o int, sign int, p double, id long, v array<double>")
    dealt = keyed.repartitionByRange(parts(spark), "o", "sign", "p", "id").sortWithinPartitions("o", "sign", "p", "id")
    return dealt.mapInArrow(block, LINK)


def nearest(links: DataFrame, by: str, to: str, k: int) -> DataFrame:
    """The k nearest distinct ``to`` of each ``by``. Each task ranks its own
    rows of a node and sends k of them, so a node named by very many is no
    large group where they meet."""
    links = links.groupBy(by, to).agg(F.min("d").alias("d"))
    return links.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy("d", to))).where(F.col("r") <= k).drop("r")


def descend(nodes: DataFrame, graph: DataFrame, degree: int, scratch: Scratch, met: DataFrame | None = None) -> tuple[DataFrame, DataFrame, float]:
    """One round: a node, its neighbours, and those it is a neighbour of, are
    compared with each other; a pair is kept where it beats the farthest
    neighbour that one of them has. A member's pairs beyond its ``degree``
    nearest of a meeting can't be among its neighbours. Pairs that met at the
    same node in the round before (``met``) are not compared again.

    Returns the graph, who met where, and the share of links that are new."""
    spark = nodes.sparkSession
    back = nearest(graph.select(F.col("near").alias("node"), F.col("node").alias("near"), "d"), "node", "near", degree // 2)
    around = graph.select("node", "near").unionByName(back.select("node", "near")).select(F.col("node").alias("centre"), F.col("near").alias("id"))
    around = around.unionByName(nodes.select(F.col("id").alias("centre"), "id")).distinct()
    if met is None:
        around = around.withColumn("fresh", F.lit(True))
    else:
        around = around.join(met.select("centre", "id", F.lit(False).alias("fresh")), ["centre", "id"], "left").withColumn("fresh", F.coalesce("fresh", F.lit(True)))
    around = scratch.stage(around, "around")
    reach = graph.groupBy("node").agg(F.max("d").alias("far"), F.count("*").alias("n"))
    reach = scratch.stage(nodes.join(reach, nodes["id"] == reach["node"], "left")
                          .select("id", "v", F.when(F.col("n") >= degree, F.col("far")).otherwise(float("inf")).alias("far")), "reach")
    dealt = around.join(reach, "id").select("centre", "id", "v", "far", "fresh").repartition(parts(spark), "centre").sortWithinPartitions("centre", "id")

    def meet(batches):
        from sensorlake.llm.common import sorted_blocks, starts
        for t in sorted_blocks(batches, ["centre"], 4000):
            first = starts(t, ["centre"])
            ids, x, far = t.column("id").to_numpy(), vectors(t, "v"), t.column("far").to_numpy()
            fresh = t.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
            out = [links_of(ids[a:b], x[a:b], degree, far[a:b], fresh[a:b]) for a, b in zip(first, [*first[1:], len(ids)]) if fresh[a:b].any()]
            yield link_batch([y for y in out if y])

    new = dealt.mapInArrow(meet, LINK).withColumn("new", F.lit(True))
    links = graph.select("node", "near", "d", F.lit(False).alias("new")).unionByName(new).groupBy("node", "near").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    best = Window.partitionBy("node").orderBy("d", "near")
    out = scratch.stage(links.withColumn("r", F.row_number().over(best)).where(F.col("r") <= degree).drop("r"), "graph")
    share = out.agg(F.avg(F.col("new").cast("int"))).first()[0] or 0.0
    scratch.drop(reach)
    return out, around, share


def distance(a: str, b: str) -> Column:
    """Euclidean distance in double precision."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def distances(pairs: DataFrame) -> DataFrame:
    """(query_id, node, q, v) to (query_id, node, d)."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                d = vectors(b, "q") - vectors(b, "v")
                yield pa.RecordBatch.from_arrays([b.column("query_id"), b.column("node"), pa.array((d * d).sum(1))], names=["query_id", "node", "d"])
    return pairs.select("query_id", "node", "q", "v").mapInArrow(run, "query_id long, node long, d double")


class Index:
    """nodes (id, v), graph (node, near, d), and members (id, ids): the
    smallest row ids of each node's vector, at most ``copies`` of them."""

    def __init__(self, rows: DataFrame, scratch: Scratch, copies: int, degree: int = DEGREE, settled: float = SETTLED):
        self.scratch = scratch
        rows = rows.withColumn("h", F.xxhash64("v"))
        # the first ids of each vector; each task sends as many of its own, as one may be that of very many rows
        ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))).where(F.col("r") <= copies)
        grouped = scratch.stage(ranked.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("id"), "ids", "v"), "nodes")
        self.nodes, self.members = grouped.select("id", "v"), grouped.select("id", "ids")
        self.dim = len((self.nodes.select("v").limit(1).collect() or [[[0.0]]])[0][0])
        graph = scratch.stage(nearest(first_links(self.nodes, self.dim, degree), "node", "near", degree), "graph")
        met, share = None, 1.0
        while share > settled:
            old, seen = graph, met
            graph, met, share = descend(self.nodes, graph, degree, scratch, met)
            scratch.drop(old, seen)
        scratch.drop(met)
        # searched both ways: a node may be in no other's list
        both = graph.select("node", "near", "d").unionByName(nearest(graph.select(F.col("near").alias("node"), F.col("node").alias("near"), "d"), "node", "near", degree))
        self.graph = scratch.stage(both.groupBy("node", "near").agg(F.min("d").alias("d")), "graph")
        scratch.drop(graph)

    def search(self, queries: DataFrame, beam: int = BEAM) -> DataFrame:
        """(query_id, node, d): the ``beam`` nearest nodes found for each query
        (query_id, q), by squared distance. A round looks at the neighbours of
        the nodes in the beam that were not looked at; it ends when no query
        has such a node left."""
        scratch = self.scratch
        seeds = self.nodes.orderBy(F.xxhash64("id"), "id").limit(ENTRIES).withColumnsRenamed({"id": "node"})
        # a fixed number of entries against the queries, which come in blocks
        start = distances(queries.join(F.broadcast(seeds.withColumn("all", F.lit(1))), F.lit(1) == F.col("all")))
        at = nearest(start, "query_id", "node", 8)
        # a query whose vector is a node's begins there too, whichever copy it is; the
        # nodes of the queries' vectors are found first, a row for each vector, so that
        # very many copies don't meet in one task
        asked = queries.select(F.xxhash64("q").alias("h")).distinct()
        homes = self.nodes.select(F.xxhash64("v").alias("h"), F.col("id").alias("node"), "v").join(asked, "h", "left_semi")
        homes = if_small(scratch.stage(homes, "homes"), QUERIES)
        own = queries.join(homes, (F.xxhash64("q") == F.col("h")) & (F.col("q") == F.col("v")))
        held = scratch.stage(nearest(at.unionByName(distances(own)), "query_id", "node", beam).withColumn("done", F.lit(False)), "beam")
        queries = if_small(queries, QUERIES)
        while True:
            todo = scratch.stage(held.where("not done").select("query_id", F.col("node").alias("of")), "todo")
            ahead = self.graph.select(F.col("node").alias("of"), F.col("near").alias("node")).join(if_small(todo), "of").select("query_id", "node").distinct()
            ahead = scratch.stage(ahead.join(if_small(held.select("query_id", "node")), ["query_id", "node"], "left_anti"), "ahead")
            if not ahead.limit(1).count():
                break
            pairs = self.nodes.select(F.col("id").alias("node"), "v").join(if_small(ahead), "node").join(queries, "query_id")
            new = distances(pairs).withColumn("done", F.lit(False)).unionByName(held.withColumn("done", F.lit(True)))
            ranked = new.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy("d", "node"))).where(F.col("r") <= beam).drop("r")
            held, old = scratch.stage(ranked, "beam"), held
            scratch.drop(old, ahead, todo)
        return held.drop("done")


def search_table(rows: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest
    rows found for each row of ``rows`` (vec_id, embedding) that ``queries``
    holds for, itself excluded; ties go to the smaller vec_id.

    Vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part, nor do rows with a null vec_id. Of rows
    with equal vec_ids the copies are one if their vectors are equal, and each
    a candidate of its own if not; a query_id with several vectors searches
    with its smallest. Fewer candidates than k all come back. An empty table
    gives no row.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "neighbours")
    base = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable("v"))
    lengths = base.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    base = base.where(F.size("v") == (lengths[0]["n"] if lengths else 0))
    # copies of a row are one; -0.0 is 0.0
    base = scratch.stage(base.select("id", F.transform("v", lambda x: x + 0.0).alias("v")).distinct(), "vectors")
    index = Index(base, scratch, k + 1)
    asked = base.withColumnRenamed("id", "vec_id").where(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    asked = scratch.stage(asked, "queries")
    found = index.search(asked)
    near = (found.join(index.members.withColumnRenamed("id", "node"), "node").select("query_id", "node", F.explode("ids").alias("vec_id"))
            .where("query_id <> vec_id"))
    exact = near.join(index.nodes.withColumnRenamed("id", "node"), "node").join(asked, "query_id").select("query_id", "vec_id", distance("q", "v").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return exact.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_table(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
