"""Operators: top-n with ties, pivot, flatten, index, dedup, nearest join, group values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sousflow.operators import (
    canonical_rows, closest_per_group, duplicate_keys, flatten, heavy_keys, inverted_index, key_profile,
    nearest_locations, pivot_ranks, sorted_string_agg, spread_join, top_n_with_ties, with_group_values,
)
from sousflow.functions import clean_lower
from sousflow.operators.nearest import LEAF_SIZE


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", None), ("b", 3.0)], "k string, d double")
    got = rows(top_n_with_ties(df, ["k"], [F.col("d").asc_nulls_last()], 1))
    assert got == [("a", 1.0), ("a", 1.0), ("b", 3.0)]


def test_rank_gaps_leave_null_pivot_column(spark):
    df = spark.createDataFrame([(1, "vegan"), (1, "vegan"), (1, "zesty"), (2, "quick")], "c int, t string")
    ranked = top_n_with_ties(df, ["c"], [F.col("t").asc()], n=3, rank_col="r")
    got = rows(pivot_ranks(ranked, ["c"], "r", "t", ["p1", "p2", "p3"]))
    assert got == [(1, "vegan", None, "zesty"), (2, "quick", None, None)]


def test_flatten_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert rows(flatten(df, "xs", "x", index_col="i")) == [(1, 0, "a"), (1, 1, "b")]
    assert rows(flatten(df, "xs", "x")) == [(1, "a"), (1, "b")]


def test_inverted_index_takes_largest_id(spark):
    df = spark.createDataFrame([(1, [" Vegan", "x"]), (5, ["vegan "]), (3, ["x"])], "id int, tags array<string>")
    assert rows(inverted_index(df, "tags", "id", "tag", clean_lower)) == [("vegan", 5), ("x", 3)]


def test_dedup_profile_duplicates_canonical(spark):
    df = spark.createDataFrame([(1, "A", "a"), (4, "A", "a"), (3, " a", "a"), (2, "B", "b")],
                               "id int, raw string, key string")
    assert rows(key_profile(df, {"keys": "key", "ids": "id"})) == [(2, 4)]
    assert rows(duplicate_keys(df, ["key"], "id", "n")) == [("a", 3)]
    assert rows(canonical_rows(df, "id", ["key"], ["key"]), "id") == [(1,), (2,)]
    assert rows(canonical_rows(df, "id", ["raw", "key"], ["key"]), "id") == [(1,), (2,), (3,)]


def test_group_values_match_window(spark):
    df = spark.createDataFrame([("s", 1, "x"), ("s", 3, "y"), ("t", 2, "z"), (None, 7, "p"), (None, 5, "q")], "k string, ts int, v string")
    out = with_group_values(df, ["k"], [F.min("ts").alias("first"), F.max_by("v", "ts").alias("last")])
    assert out.columns == ["k", "ts", "v", "first", "last"]
    got = {(r.k, r.ts, r.first, r.last) for r in out.collect()}
    # rows with a NULL key are a group, as in a window
    assert got == {("s", 1, 1, "y"), ("s", 3, 1, "y"), ("t", 2, 2, "z"), (None, 7, 5, "p"), (None, 5, 5, "p")}


def test_closest_per_group_keeps_ties_and_groups_without_value(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (1, 3.0), (2, None), (2, None), (3, None), (3, 1.0), (None, 4.0), (None, 5.0)], "k int, d double")
    got = sorted(map(str, closest_per_group(df, ["k"], "d").collect()))
    want = sorted(map(str, top_n_with_ties(df, ["k"], [F.col("d").asc_nulls_last()]).collect()))
    assert got == want and len(got) == 6


def test_sorted_string_agg(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None)], "g int, v string")
    assert rows(df.groupBy("g").agg(sorted_string_agg("v").alias("s"))) == [(1, "a, b"), (2, "")]


def haversine(a, b, R=6371008.8):
    (la1, lo1), (la2, lo2) = a, b
    p1, p2 = math.radians(la1), math.radians(la2)
    h = math.sin(math.radians(la2 - la1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lo2 - lo1) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(min(1.0, h)))


def brute(queries, targets, exclude_zero=False):
    out = set()
    for q in set(queries):
        ds = [(haversine(q, t), t) for t in set(targets)]
        ds = [x for x in ds if not exclude_zero or x[0] > 0]
        if not ds:
            continue
        best = min(d for d, _ in ds)
        out |= {(q, t) for d, t in ds if d <= best * (1 + 1e-12)}
    return out


def pairs(df):
    return {((r.q_lat, r.q_lon), (r.t_lat, r.t_lon)) for r in df.collect()}


@pytest.mark.parametrize("n_targets,clustered", [(40, False), (3000, False), (3000, True)])
def test_nearest_matches_brute_force(spark, n_targets, clustered):
    rnd = random.Random(n_targets + clustered)
    def point():
        if clustered and rnd.random() < 0.8:
            return (round(40 + rnd.random(), 4), round(-90 + rnd.random(), 4))
        return (round(rnd.uniform(-80, 80), 4), round(rnd.uniform(-180, 180), 4))
    targets = [point() for _ in range(n_targets)]
    queries = [point() for _ in range(150)] + targets[:20]
    q = spark.createDataFrame(queries, "lat double, lon double")
    t = spark.createDataFrame(targets, "lat double, lon double")
    if n_targets > 1000:
        assert len(set(targets)) > LEAF_SIZE  # exercises the multi-round walk
    assert pairs(nearest_locations(q, t)) == brute(queries, targets)
    assert pairs(nearest_locations(q, t, exclude_zero=True)) == brute(queries, targets, exclude_zero=True)


def test_nearest_far_from_dense_cluster(spark):
    rnd = random.Random(7)
    cluster = [(round(10 + rnd.random() * 0.01, 6), round(20 + rnd.random() * 0.01, 6)) for _ in range(2000)]
    others = [(-40.0, 150.0), (60.0, -120.0)]
    queries = [(-45.0 + i, -60.0 + i) for i in range(10)] + [(10.005, 20.005)]
    q = spark.createDataFrame(queries, "lat double, lon double")
    t = spark.createDataFrame(cluster + others, "lat double, lon double")
    assert pairs(nearest_locations(q, t)) == brute(queries, cluster + others)


def test_nearest_near_zero_boxes(spark):
    # boxes that shrink to the query point (the pole in several spellings) must not
    # hide the nearest other place
    queries = [(90.0, 0.0), (0.0, 0.0)]
    targets = [(90.0, 0.0), (90.0, 45.0), (0.0, 0.0), (0.0, 1e-12)] + [(80.0 - i * 0.5, i * 1.0) for i in range(100)]
    q = spark.createDataFrame(queries, "lat double, lon double")
    t = spark.createDataFrame(targets, "lat double, lon double")
    assert pairs(nearest_locations(q, t, exclude_zero=True)) == brute(queries, targets, exclude_zero=True)


def test_nearest_ties_and_empty(spark):
    q = spark.createDataFrame([(0.0, 0.0), (None, 1.0)], "lat double, lon double")
    t = spark.createDataFrame([(0.0, 1.0), (0.0, -1.0), (5.0, 5.0)], "lat double, lon double")
    assert pairs(nearest_locations(q, t)) == {((0.0, 0.0), (0.0, 1.0)), ((0.0, 0.0), (0.0, -1.0))}
    assert nearest_locations(q, t.where("lat > 100")).count() == 0
    same = spark.createDataFrame([(1.0, 1.0)], "lat double, lon double")
    assert nearest_locations(same, same, exclude_zero=True).count() == 0


def test_tables_from_catalog_and_parquet(spark):
    from sousflow.sources.tables import Tables

    spark.createDataFrame([(1, "a")], "k int, v string").createOrReplaceGlobalTempView("tiny")
    assert Tables.catalog(spark, "global_temp").tiny.count() == 1
    assert Tables(spark, "/root/testdata/sf0.001").nation.count() == 25


def test_tables_see_appended_files(spark, tmp_path):
    from sousflow.sources.tables import Tables

    path = str(tmp_path / "grows.parquet")
    spark.range(5).write.parquet(path)
    assert Tables(spark, str(tmp_path)).grows.count() == 5
    spark.range(7).write.mode("append").parquet(path)
    assert Tables(spark, str(tmp_path)).grows.count() == 12
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert Tables(spark, str(tmp_path)).plain.count() == 3


@pytest.mark.parametrize("n_targets", [15, 16, 17, 64, 65])
def test_nearest_is_the_same_walk_around_the_leaf_size(spark, n_targets):
    rnd = random.Random(n_targets)
    targets = [(round(10 + rnd.random(), 4), round(20 + rnd.random(), 4)) for _ in range(n_targets)]
    queries = [(round(10 + rnd.random(), 4), round(20 + rnd.random(), 4)) for _ in range(20)]
    q, t = (spark.createDataFrame(x, "lat double, lon double") for x in (queries, targets))
    assert pairs(nearest_locations(q, t)) == brute(queries, targets)


def test_nearest_keeps_symmetric_ties_through_the_walk(spark):
    # targets on a 1-degree grid, queries half-way along a parallel: two exact ties each
    targets = [(float(a), float(b)) for a in range(30, 50) for b in range(-100, -80)]
    queries = [(30.0 + i, -99.5 + i) for i in range(15)] + [(10.0, -120.0)]
    q = spark.createDataFrame(queries, "lat double, lon double")
    t = spark.createDataFrame(targets, "lat double, lon double")
    assert len(targets) > LEAF_SIZE
    want = brute(queries, targets)
    assert sum(1 for (qq, _) in want if qq == (30.0, -99.5)) == 2
    assert pairs(nearest_locations(q, t)) == want
    assert pairs(nearest_locations(q, t, exclude_zero=True)) == brute(queries, targets, exclude_zero=True)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_join(spark, how, null_safe):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 30}" if i % 2 else None) for i in range(600)], "id long, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), (None, 4), ("other", 5)], "k string, v int")
    same = left.k.eqNullSafe(right.k) if null_safe else left.k == right.k
    want = left.join(right, same, how).select(left.k, "id", *(["v"] if how in ("inner", "left") else []))
    got = spread_join(left, right, ["k"], how, share_rows=50, null_safe=null_safe)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_heavy_keys_are_few_and_their_rows_spread(spark):
    left = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    assert [(r.k, r["_shares"]) for r in heavy_keys(left, ["k"], share_rows=200).collect()] == [(0, 15)]
    # a key has to hold more than the max_keys-th part of all rows, whatever share_rows says
    assert heavy_keys(left, ["k"], share_rows=1, max_keys=2).count() == 0
    right = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = spread_join(left, right, ["k"], share_rows=200)
        # without adaptive execution and with one partition a share at most, no task holds the hot key's rows
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 9000 and max(sizes) < 4000
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
