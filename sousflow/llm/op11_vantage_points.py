"""Nearest neighbours with vantage-point trees, one for each shard, pruned by the triangle inequality.

A shallow vantage-point tree over a bounded sample deals all rows into shards of near vectors; it
only decides where a row lies, every row is indexed. Each shard's rows become a vantage-point tree of
their own: a node names a point, its rows are halved at the median distance to it, and each half
keeps the least and the greatest distance found. A query at distance d from the point can find
nothing nearer than ``low - d`` or ``d - high`` in a half (triangle inequality). A half, and likewise a
whole shard, is left out where ``factor`` times that bound exceeds the k-th best distance so far:
factor one is exact, a larger one prunes more and may miss neighbours.

A query first searches its own shard and then, with the bound found there, the shards that the bound
leaves in play. Equal vectors are one query, and of equal vectors a tree keeps the k + 1 smallest
ids: no list of k neighbours can hold more of them. A shard with too many rows is dealt into parts by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sousflow.operators.joins import spread_join

from .common import shared, staged

#: Rows of a shard that the sample aims at, and the most that one part of a shard holds on average.
SHARD_ROWS = 4096
#: Shards at most; beyond, shards grow and are dealt into parts.
MAX_SHARDS = 1 << 14
#: Sampled rows for each shard, and the bytes of vectors that the sample may have in all.
SAMPLE_PER_SHARD = 8
SAMPLE_BYTES = 64 << 20
#: Rows of a leaf, and queries that one task searches in one part of a shard on average.
LEAF_ROWS = 64
QUERY_ROWS = 4096

_BLOCK_BYTES = 16 << 20
_SLACK = 1 + 1e-9  # so that rounding of a bound never drops a tie
_KEY = ("h1", "h2")


def valid_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v, h1, h2 (128 bits that name the vector): rows with an id and a vector of finite numbers that are not all zero."""
    v = F.transform(F.col(vector_column).cast("array<double>"), lambda x: x + F.lit(0.0))  # 0 in place of -0
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return rows.where(F.coalesce(whole, F.lit(False)) & F.exists("v", lambda x: x != 0)).select(
        "id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.reverse("v")).alias("h2"))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between rows of ``a`` and the rows of ``b`` that broadcast against them."""
    gap = a - b
    return np.sqrt(np.einsum("...k,...k->...", gap, gap))


class Router:
    """The tree over the sample: points and medians in heap order, and where a vector's shard lies."""

    def __init__(self, sample: np.ndarray, shards: int) -> None:
        self.levels = max(0, int(np.ceil(np.log2(max(1, shards)))))
        inner = (1 << self.levels) - 1
        self.points = np.zeros((inner, sample.shape[1]))
        self.medians = np.zeros(inner)
        self.low = self.high = np.zeros((0, 0))
        groups = {0: sample}
        for node in range(inner):
            rows = groups.pop(node)
            if len(rows):
                far = distances(rows, rows[0])
                self.points[node] = rows[int(np.argmax(far))]
                d = distances(rows, self.points[node])
                self.medians[node] = np.median(d)
                groups[2 * node + 1], groups[2 * node + 2] = rows[d <= self.medians[node]], rows[d > self.medians[node]]
            else:
                groups[2 * node + 1] = groups[2 * node + 2] = rows

    def route(self, v: np.ndarray) -> np.ndarray:
        """The shard of each vector."""
        node = np.zeros(len(v), dtype=np.int64)
        for _ in range(self.levels):
            node = 2 * node + 1 + (distances(v, self.points[node]) > self.medians[node])
        return node - ((1 << self.levels) - 1)

    def above(self, v: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """The distances of each vector to the points above its shard."""
        nodes = [(shard >> (self.levels - level)) + (1 << level) - 1 for level in range(self.levels)]
        return np.stack([distances(v, self.points[x]) for x in nodes], axis=1)

    def bounded(self, ranges: list[tuple[int, int, float, float]]) -> Router:
        """The same with the ranges of distances that the rows of each half have: (shard, level, least, greatest)."""
        nodes = (1 << (self.levels + 1)) - 1
        self.low, self.high = np.full(nodes, np.inf), np.full(nodes, -np.inf)
        for shard, level, low, high in ranges:
            # the child that holds the shard on the level below
            child = (shard >> (self.levels - level - 1)) + (1 << (level + 1)) - 1
            self.low[child], self.high[child] = min(self.low[child], low), max(self.high[child], high)
        return self

    def reached(self, v: np.ndarray, tau: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) of the shards that the bounds of each row leave in play."""
        row, node, bound = np.arange(len(v)), np.zeros(len(v), dtype=np.int64), np.zeros(len(v))
        for _ in range(self.levels):
            d = distances(v[row], self.points[node])
            rows, nodes, bounds = [], [], []
            for side in (1, 2):
                child = 2 * node + side
                least = np.maximum(bound, np.maximum(self.low[child] - d, d - self.high[child]))
                keep = factor * least <= tau[row] * _SLACK
                rows.append(row[keep])
                nodes.append(child[keep])
                bounds.append(least[keep])
            row, node, bound = np.concatenate(rows), np.concatenate(nodes), np.concatenate(bounds)
        return row, node - ((1 << self.levels) - 1)


class Tree:
    """A vantage-point tree over the rows of one part of a shard; rows are kept in the order of the leaves."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, v: np.ndarray) -> None:
        self.points: list[np.ndarray] = []
        #: per node: first row, last row (exclusive), point or -1, and of each child: node, least, greatest distance
        self.nodes: list[list[float]] = []
        order = np.arange(len(ids))
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            here = len(self.nodes)
            self.nodes.append([a, b, -1, -1, 0.0, 0.0, -1, 0.0, 0.0])
            if parent >= 0:
                self.nodes[parent][3 + 3 * side] = here
            if b - a <= LEAF_ROWS:
                continue
            rows = order[a:b]
            point = v[rows[int(np.argmax(distances(v[rows], v[rows[0]])))]]
            d = distances(v[rows], point)
            near = d <= np.median(d)
            if near.all():
                near = d < d.max()
            if not near.any():
                continue  # all rows at one distance: a leaf, however many
            order[a:b] = np.concatenate([rows[near], rows[~near]])
            self.nodes[here][2] = len(self.points)
            self.points.append(point)
            for s, part in enumerate((d[near], d[~near])):
                self.nodes[here][4 + 3 * s], self.nodes[here][5 + 3 * s] = float(part.min()), float(part.max())
            middle = a + int(near.sum())
            todo += [(a, middle, here, 0), (middle, b, here, 1)]
        self.ids, self.keys, self.v = ids[order], keys[order], v[order]

    def search(self, q: np.ndarray, tau: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """For each query the rows of its k nearest with their distances, nearest first; -1 where there are fewer than k within tau."""
        best = np.full((len(q), k), np.inf)
        rows = np.full((len(q), k), -1)
        names = np.append(self.ids, np.iinfo(np.int64).max)
        tau = tau.copy()

        def scan(leaf: int, who: np.ndarray) -> None:
            a, b = int(self.nodes[leaf][0]), int(self.nodes[leaf][1])
            step = max(1, _BLOCK_BYTES // max(1, (b - a) * q.shape[1] * 8))
            for i in range(0, len(who), step):
                w = who[i : i + step]
                d = distances(q[w][:, None, :], self.v[None, a:b])
                all_d = np.concatenate([best[w], np.where(d <= tau[w][:, None] * _SLACK, d, np.inf)], axis=1)
                all_r = np.concatenate([rows[w], np.broadcast_to(np.arange(a, b), d.shape)], axis=1)
                all_r = np.where(np.isinf(all_d), -1, all_r)
                first = np.lexsort((names[all_r], all_d), axis=-1)[:, :k]
                best[w], rows[w] = np.take_along_axis(all_d, first, 1), np.take_along_axis(all_r, first, 1)
                tau[w] = np.minimum(tau[w], best[w, -1])

        if not len(self.ids) or not len(q):
            return rows, best
        # each query's own leaf first, for a bound
        home = np.full(len(q), -1)
        todo = [(0, np.arange(len(q)))]
        while todo:
            node, who = todo.pop()
            x = self.nodes[node]
            if x[2] < 0:
                home[who] = node
                scan(node, who)
                continue
            d = distances(q[who], self.points[int(x[2])])
            near = d <= (x[5] + x[7]) / 2
            todo += [(int(child), who[at]) for child, at in ((x[3], near), (x[6], ~near)) if at.any()]
        todo = [(0, np.arange(len(q)), np.zeros(len(q)))]
        while todo:
            node, who, bound = todo.pop()
            keep = factor * bound <= tau[who] * _SLACK
            who, bound = who[keep], bound[keep]
            if not len(who):
                continue
            x = self.nodes[node]
            if x[2] < 0:
                away = home[who] != node
                if away.any():
                    scan(node, who[away])
                continue
            d = distances(q[who], self.points[int(x[2])])
            for child, low, high in ((x[6], x[7], x[8]), (x[3], x[4], x[5])):
                todo.append((int(child), who, np.maximum(bound, np.maximum(low - d, d - high))))
        return rows, best


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dimension)


def _vectors(v: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.reshape(-1)))


def _keys(batch: pa.RecordBatch | pa.Table, names: tuple[str, str] = _KEY) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy() if isinstance(batch, pa.Table) else batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)


def _fewest(ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that are among the ``k`` smallest different ids of their vector."""
    order = np.lexsort((ids, keys[:, 1], keys[:, 0]))
    i, x = ids[order], keys[order]
    same = np.append(False, (x[1:] == x[:-1]).all(axis=1))
    new = ~(same & np.append(False, i[1:] == i[:-1]))
    order, same = order[new], same[new]
    at = np.arange(len(order))
    start = np.maximum.accumulate(np.where(same, 0, at))
    return np.sort(order[at - start < k])


def _routed(rows: DataFrame, router, dimension: int, k: int, collapse: bool) -> DataFrame:
    """The rows with their shard; equal vectors of a batch beyond the k smallest ids go where ``collapse`` is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = router()
        for batch in batches:
            if collapse and batch.num_rows:
                batch = batch.take(pa.array(_fewest(batch.column("id").to_numpy(), _keys(batch), k)))
            v = _matrix(batch.column("v"), dimension)
            step = max(1, _BLOCK_BYTES // (8 * dimension))
            shard = [tree.route(v[i : i + step]) for i in range(0, len(v), step)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *shard]))], names=[*batch.schema.names, "shard"])

    return rows.mapInArrow(run, f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, shard long")


def _ranges(rows: DataFrame, router, dimension: int) -> DataFrame:
    """shard, level, low, high: the distances of each shard's rows to the points above it (no rows, one aggregate a shard and level)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = router()
        for batch in batches:
            v = _matrix(batch.column("v"), dimension)
            if not len(v) or not tree.levels:
                continue
            shard = batch.column("shard").to_numpy()
            seen = tree.above(v, shard)
            order = np.argsort(shard, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0))
            low, high = np.minimum.reduceat(seen[order], starts), np.maximum.reduceat(seen[order], starts)
            level = np.tile(np.arange(tree.levels), len(starts))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(shard[order][starts], tree.levels)), pa.array(level), pa.array(low.ravel()), pa.array(high.ravel())], names=["shard", "level", "low", "high"])

    partial = rows.select("v", "shard").mapInArrow(run, "shard long, level long, low double, high double")
    return partial.groupBy("shard", "level").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _search(pairs: DataFrame, rows: DataFrame, parts: DataFrame, dimension: int, k: int, factor: float, shard_rows: int) -> DataFrame:
    """The k nearest rows in each (query, shard) of ``pairs``: h1, h2, id, same, d.

    A part of a shard meets its queries in groups: the part's rows are repeated for each block of queries.
    """
    asked = pairs.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_ROWS)).cast("int").alias("blocks"))
    shards = asked.join(parts, "shard")
    block = F.pmod(F.xxhash64(F.lit(3), *_KEY), F.col("blocks")).cast("int").alias("block")
    left = (rows.join(shards, "shard").select("id", *_KEY, "v", "shard", F.pmod(F.xxhash64(F.lit(5), "id", *_KEY), F.col("parts")).cast("int").alias("part"),
                                              F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    right = (pairs.join(shards, "shard").select(*_KEY, "v", "tau", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), block))
    spot = ["shard", "part", "block"]

    def run(held: pa.Table, asks: pa.Table) -> pa.Table:
        none = {"h1": pa.int64(), "h2": pa.int64(), "id": pa.int64(), "same": pa.bool_(), "d": pa.float64()}
        if not held.num_rows or not asks.num_rows:
            return pa.schema(none).empty_table()
        held, asks = held.combine_chunks(), asks.combine_chunks()
        ids, keys = held["id"].to_numpy(), _keys(held)
        keep = _fewest(ids, keys, k)
        v = _matrix(held["v"].combine_chunks(), dimension)[keep]
        tree = Tree(ids[keep], keys[keep], v)
        q, key = _matrix(asks["v"].combine_chunks(), dimension), _keys(asks)
        found, best = tree.search(q, asks["tau"].to_numpy(), k, factor)
        who, place = np.nonzero(found >= 0)
        row = found[who, place]
        same = (tree.keys[row] == key[who]).all(axis=1)
        return pa.table([key[who, 0], key[who, 1], tree.ids[row], same, best[who, place]], schema=pa.schema(none))

    return left.groupBy(*spot).cogroup(right.groupBy(*spot)).applyInArrow(run, "h1 long, h2 long, id long, same boolean, d double")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The k first rows of each query by distance and id; the map side already cuts its rows to k."""
    first = Window.partitionBy(*_KEY).orderBy("d", "id")
    return found.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n")


def nearest_vectors(vectors: DataFrame, queries: Column | str, *, k: int = 10, factor: float = 1.0, id_column: str = "vec_id",
                    vector_column: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of ``vectors`` that fulfils ``queries`` (a column or SQL text), its k nearest other rows by Euclidean distance.

    Nearest first, ties to the smaller id; all candidates where there are fewer than k. ``factor`` one gives exact
    results, a larger one leaves out more and may miss neighbours. Rows without an id, and vectors that are null,
    empty, zero or hold null, NaN or infinity, take no part; neither do vectors of another length than the most
    frequent one (of equally frequent ones the smallest). Rows equal in id and vector count once; an id with several
    vectors has a list for each and may be found by each. Other columns take no part, whatever their names. A table without
    valid vectors gives an empty result; vectors of any length are compared whole.
    """
    if factor < 1:
        raise ValueError("a factor below one would keep what the triangle inequality rules out")
    spark = vectors.sparkSession
    asks = vectors.where(F.expr(queries) if isinstance(queries, str) else queries)
    every = valid_vectors(vectors, id_column, vector_column)
    lengths = every.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, n = lengths[0]["size"], lengths[0]["n"]
    every = every.where(F.size("v") == dimension)
    asked = valid_vectors(asks, id_column, vector_column).where(F.size("v") == dimension)

    # a bounded sample decides on the shards' borders only
    limit = max(1, SAMPLE_BYTES // (8 * dimension))
    shards = min(MAX_SHARDS, max(1, n // shard_rows), max(1, limit // SAMPLE_PER_SHARD))
    sample = every.select("v", "h1", "h2").orderBy(F.xxhash64(F.lit(7), *_KEY)).limit(min(limit, shards * SAMPLE_PER_SHARD)).select("v").toArrow()
    router = Router(_matrix(sample["v"].combine_chunks(), dimension), shards)
    sent = shared(spark, router)

    k1 = k + 1  # a query's own row may be among them
    rows = staged(_routed(every, sent, dimension, k1, collapse=True), "op11-rows")
    parts = rows.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * shard_rows)).cast("int").alias("parts"))
    distinct = asked.groupBy(*_KEY).agg(F.first("v").alias("v"))
    points = staged(_routed(distinct, sent, dimension, k1, collapse=False).select(*_KEY, "v", "shard"), "op11-queries")

    own = points.select("*", F.lit(float("inf")).alias("tau"))
    near = staged(_search(own, rows, parts, dimension, k1, factor, shard_rows), "op11-own")
    full = _nearest(near, k1).groupBy(*_KEY).agg(F.max("d").alias("_last"), F.count(F.lit(1)).alias("_n"))
    tau = F.when(F.col("_n") >= k1, F.col("_last")).otherwise(F.lit(float("inf")))
    bounded = points.join(full, list(_KEY), "left").select(*_KEY, "v", F.col("shard").alias("home"), F.coalesce(tau, F.lit(float("inf"))).alias("tau"))

    # one row a shard and level, so at most MAX_SHARDS * 14
    known = shared(spark, router.bounded([tuple(r) for r in _ranges(rows, sent, dimension).collect()]))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = known()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                v, at = _matrix(part.column("v"), dimension), part.column("tau").to_numpy()
                row, shard = tree.reached(v, at, factor)
                away = shard != part.column("home").to_numpy()[row]
                row, shard = row[away], shard[away]
                picked = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([picked.column("h1"), picked.column("h2"), picked.column("v"), picked.column("tau"), pa.array(shard)], names=["h1", "h2", "v", "tau", "shard"])

    pairs = staged(bounded.mapInArrow(others, "h1 long, h2 long, v array<double>, tau double, shard long"), "op11-pairs")
    far = _search(pairs, rows, parts, dimension, k1, factor, shard_rows)
    best = _nearest(near.unionByName(far).distinct(), k1)
    lists = best.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("d", "id", "same"))).alias("_list"))  # k + 1 at most

    # a hot vector may be the query of a third of all rows
    named = spread_join(asked.select(*_KEY, "id").distinct(), lists, list(_KEY))
    mine = named.select(F.col("id").alias("query_id"), F.slice(F.filter("_list", lambda x: ~(x["same"] & (x["id"] == F.col("id")))), 1, k).alias("_list"))
    ranked = mine.select("query_id", F.posexplode("_list").alias("_place", "_hit"))
    return ranked.select("query_id", (F.col("_place") + 1).alias("rank"), F.col("_hit.id").alias("vec_id"), F.col("_hit.d").alias("score"))
