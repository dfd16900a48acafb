"""Vantage-point trees against brute force: exact at factor one, recall above, shards, ties, copies, invalid vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sousflow.llm.op11_vantage_points import Router, Tree, nearest_vectors

ASKS = "vec_id % 10 = 0"


def brute(rows, k=10, asks=lambda i: i % 10 == 0):
    """Every valid row against every other; rows are (id, vector)."""
    valid = sorted({(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and v is not None and None not in v
                    and np.isfinite(v).all() and any(v)})
    sizes = [len(v) for _, v in valid]
    usual = max(sorted(set(sizes)), key=sizes.count) if sizes else 0
    valid = [(i, v) for i, v in valid if len(v) == usual]
    out = []
    if not valid:
        return out
    ids, m = np.array([i for i, _ in valid]), np.array([v for _, v in valid])
    for n, (i, _) in enumerate(valid):
        if asks(i):
            d = np.sqrt(((m - m[n]) ** 2).sum(axis=1))
            order = [x for x in np.lexsort((ids, d)) if x != n][:k]
            out += [(i, r, int(ids[x]), round(float(d[x]), 9)) for r, x in enumerate(order, 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


def table(spark, rows, kind="float"):
    rows = [(i, v if v is None else [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def clustered(n, dimension, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimension))
    x = centres[rng.integers(0, 12, n)] + 0.1 * rng.normal(size=(n, dimension))
    x[: n // 4] = rng.normal(size=(n // 4, dimension))
    return [(i, [float(y) for y in np.float32(v)]) for i, v in enumerate(x)]


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_equals_brute_force_with_many_shards_and_one(spark, shard_rows):
    rows = clustered(900, 8, 1)
    assert found(nearest_vectors(table(spark, rows).repartition(3), ASKS, shard_rows=shard_rows)) == brute(rows)


def test_hot_vector_ties_and_repeated_rows(spark):
    rows = clustered(300, 6, 2)
    rows += [(1000 + i, [1.0, 0, 0, 0, 0, 0]) for i in range(200)]            # a third of all rows, among them 20 queries
    rows += [(2000 + i, [0.0, 3.0 if i % 2 else -3.0, 0, 0, 0, 0]) for i in range(40)]
    rows += rows[:5] + [(1000, [1.0, 0, 0, 0, 0, 0])] * 3                     # the same rows again
    rows += [(10, [9.0, 9.0, 9.0, 9.0, 9.0, 9.0])]                            # an id with two vectors
    assert found(nearest_vectors(table(spark, rows).repartition(4), ASKS, shard_rows=50)) == brute(rows)


def test_invalid_vectors_take_no_part(spark):
    good = [(i, [float(i + 1), 1.0]) for i in range(30)]
    bad = [(None, [1.0, 2.0]), (100, None), (110, []), (120, [0.0, 0.0]), (130, [1.0, None]), (140, [float("nan"), 1.0]),
           (150, [float("inf"), 1.0]), (160, [1.0, 2.0, 3.0]), (170, [-0.0, 0.0])]
    assert found(nearest_vectors(table(spark, good + bad, "double"), ASKS, k=4)) == brute(good, k=4)


def test_fewer_rows_than_k_empty_and_clashing_columns(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])]
    extra = table(spark, rows).withColumns({c: F.lit("x") for c in ("v", "id", "h1", "shard", "rank", "score", "tau", "_asks")})
    assert found(nearest_vectors(extra, ASKS)) == brute(rows)
    assert nearest_vectors(table(spark, []), ASKS).count() == 0
    assert nearest_vectors(table(spark, [(0, [1.0])]), ASKS).count() == 0
    assert nearest_vectors(table(spark, rows), "CAST(NULL AS BOOLEAN)").columns == ["query_id", "rank", "vec_id", "score"]
    with pytest.raises(ValueError):
        nearest_vectors(table(spark, rows), ASKS, factor=0.5)


def test_equal_distances_make_one_leaf():
    # every row is equally far from every other: nothing can be halved, nothing may be lost
    m = np.eye(300)
    tree = Tree(np.arange(300), np.stack([np.arange(300), np.zeros(300, int)], 1), m)
    rows, d = tree.search(m[:3], np.full(3, np.inf), 5, 1.0)
    assert [sorted(tree.ids[r].tolist())[:2] for r in rows] == [[0, 1], [0, 1], [0, 1]]
    assert np.allclose(d[:, 0], 0) and np.allclose(d[:, 1:], np.sqrt(2))


@pytest.mark.parametrize("factor", [1.0, 1.5, 3.0])
def test_factor_trades_recall(factor):
    rows = clustered(4000, 16, 5)
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    tree = Tree(ids, np.stack([ids, ids], 1), m)
    asks = m[::40]
    got, _ = tree.search(asks, np.full(len(asks), np.inf), 11, factor)
    d = np.sqrt(((m[None] - asks[:, None]) ** 2).sum(-1))
    recall = np.mean([len(set(tree.ids[g]) & set(np.argsort(x)[:11])) / 11 for g, x in zip(got, d, strict=True)])
    assert recall == 1 if factor == 1 else recall >= 0.9


def test_router_bounds_hold():
    rng = np.random.default_rng(3)
    m = rng.normal(size=(2000, 5))
    router = Router(m[:200], 16)
    shard = router.route(m)
    seen = router.above(m, shard)
    router.bounded([(int(s), lv, seen[shard == s, lv].min(), seen[shard == s, lv].max()) for s in np.unique(shard) for lv in range(router.levels)])
    d = np.sqrt(((m[None] - m[:50, None]) ** 2).sum(-1))
    tau = np.sort(d, axis=1)[:, 10]
    row, reached = router.reached(m[:50], tau, 1.0)
    pairs = set(zip(row.tolist(), reached.tolist(), strict=True))
    assert all((q, int(shard[x])) in pairs for q in range(50) for x in np.flatnonzero(d[q] <= tau[q]))
    assert len(pairs) < 50 * len(np.unique(shard))


def test_approximate_search_keeps_recall(spark):
    rows = clustered(1500, 8, 7)
    got = {(q, v) for q, _, v, _ in found(nearest_vectors(table(spark, rows), ASKS, factor=1.3, shard_rows=100))}
    want = {(q, v) for q, _, v, _ in brute(rows)}
    assert len(got & want) / len(want) >= 0.9
