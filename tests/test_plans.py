"""Physical-plan checks: no Python evaluation, early group limits, one event shuffle."""

import pytest

from sousflow.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join_in_plans(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_n_uses_group_limit(spark):
    from pyspark.sql import functions as F

    from sousflow.operators import top_n_with_ties

    df = top_n_with_ties(spark.range(100).select((F.col("id") % 7).alias("k"), "id"), ["k"], [F.col("id").desc()], 2)
    df.collect()
    assert "WindowGroupLimit" in plan(df)


def test_event_path_reads_only_needed_columns(spark):
    scans = [line for line in plan(QUERIES["daily_report"](spark, SF)).splitlines() if "FileScan parquet" in line]
    for scan in scans:
        read = scan.split("[", 1)[1].split("]", 1)[0]
        assert "value" not in read and "props" in read  # the unused measure column is pruned


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["daily_report", "most_viewed_daily"])
def test_daily_jobs_use_no_window_and_no_lists(spark, name):
    # a day's top count is an aggregate joined back; only winners reach the string aggregate
    text = final_plan(QUERIES[name](spark, SF))
    assert "Window" not in text and "collect_list" not in text


def test_store_rows_need_no_join(spark):
    # the stores' rows are a scalar subquery: no key, no exchange of the customers for it
    from sousflow.plans import customers

    text = optimized(QUERIES["store_distances"](spark, SF))
    assert "scalar-subquery" in text
    people = spark.createDataFrame([("a", "b", "c", "d", 1, 1.0, 2.0)],
                                   "first_name string, last_name string, customer_city string, customer_state string, food_pref_count int, lat double, lon double")
    cities = spark.createDataFrame([("CHICAGO", "IL", 41.0, -87.0), ("GARY", "IN", 41.5, -87.3)], "city_name string, state_abbr string, lat double, lon double")
    text = plan(customers.store_distances(people, cities)).split("Subqueries")[0]
    assert not any(node in text for node in ("Join", "Exchange hashpartitioning(customer"))


@pytest.mark.parametrize("name,jobs", [("nearest_supplier", 60), ("backup_supplier", 60)])
def test_nearest_search_takes_few_jobs(spark, name, jobs):
    spark.sparkContext.setJobGroup(f"count-{name}", name)
    try:
        QUERIES[name](spark, "/root/testdata/sf0.01").collect()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"count-{name}")) <= jobs
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_supplier_places_read_two_databases(spark):
    text = plan(QUERIES["supplier_places"](spark, SF))
    assert "supply_" in text and "resources_" in text


def test_recipe_suggestion_broadcasts_the_tag_index(spark):
    text = final_plan(QUERIES["recipe_suggestion"](spark, SF))
    assert not any("SortMergeJoin [food_preference_1" in line for line in text.splitlines())


def test_session_summary_single_shuffle(spark):
    df = QUERIES["session_summary"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1  # events -> sessions, once
    assert "Window" not in final                          # no per-session window buffering


def test_session_values_without_window(spark):
    # MIN() OVER / LAST_VALUE() OVER the session become aggregates joined back
    df = QUERIES["window_min_last"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in final
