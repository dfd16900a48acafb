"""Property tests: random inputs, Spark jobs vs the independent SQL (DuckDB).

PROPERTY_EXAMPLES=40 runs more examples than the default 8."""

import datetime as dt
import os
import hashlib
from collections import Counter

import duckdb
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sousflow.plans import sessions
from sousflow.plans.oracle import oracle_queries

SCHEMA = "event_id bigint, session_id string, user_id bigint, event_timestamp timestamp_ntz, event_details string"
BASE = dt.datetime(2024, 5, 1, 22, 0, 0)
DETAILS = {
    "home": '{"event": "home"}',
    "search": '{"event": "search"}',
    "bad": "{not json",
}


def details(kind, recipe):
    return '{"event": "view_recipe", "recipe_id": "%d"}' % recipe if kind == "view" else DETAILS[kind]


event = st.tuples(
    st.integers(0, 5),                                   # session
    st.integers(0, 3 * 24 * 60),                         # minute offset (crosses midnights)
    st.integers(0, 1_999_999),                           # sub-minute microseconds (ties possible)
    st.sampled_from(["home", "search", "view", "view", "bad"]),
    st.integers(1, 4),                                   # recipe id
)


def digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    c = Counter(repr(tuple(norm(r[i]) for i in order)) for r in data)
    return hashlib.sha256("".join(f"{k}:{c[k]}\n" for k in sorted(c)).encode()).hexdigest()


@settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "8")), deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=40))
def test_session_jobs_match_sql(spark, events):
    rows = [(i, f"s{s}", s, BASE + dt.timedelta(minutes=m, microseconds=us // 2 * 2), details(kind, r))
            for i, (s, m, us, kind, r) in enumerate(events)]
    df = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    cols = list(zip(*rows))
    con.register("wa", pa.table({
        "event_id": pa.array(cols[0], pa.int64()), "session_id": pa.array(cols[1], pa.string()),
        "user_id": pa.array(cols[2], pa.int64()), "event_timestamp": pa.array(cols[3], pa.timestamp("us")),
        "event_details": pa.array(cols[4], pa.string())}))
    con.execute("CREATE TABLE website_activity AS SELECT * FROM wa")
    sql = oracle_queries(bridge=False)
    for name, job in [("session_summary", sessions.session_summary), ("most_viewed_daily", sessions.most_viewed_daily),
                      ("daily_sessions", sessions.daily_sessions), ("daily_report", sessions.daily_report),
                      ("window_min_last", sessions.session_start_and_last_event)]:
        out = job(df)
        got = [tuple(r) for r in out.collect()]
        rel = con.sql(sql[name])
        want = rel.fetchall()
        assert len(got) == len(want), name
        assert digest(out.columns, got) == digest(rel.columns, want), name


TAGS = [" Vegan", "vegan ", "SPICY", "quick", "zesty", "<NA>", None]

survey_row = st.tuples(st.integers(1, 6), st.integers(0, len(TAGS) - 1), st.sampled_from([True, False, None]))


@settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "8")), deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(survey_row, min_size=1, max_size=30), st.lists(st.integers(1, 7), min_size=1, max_size=10))
def test_top_preferences_match_sql_rank(spark, survey, people_ids):
    from sousflow.plans import preferences

    people = [(c, f"F{c % 3}", f"L{c}", f"e{c}@x.test") for c in people_ids]  # repeated ids = repeated rows
    tags = [(i, t) for i, t in enumerate(TAGS)]
    rows = [(c, t, a) for c, t, a in survey]
    eligible = spark.createDataFrame(people, "customer_id bigint, first_name string, last_name string, email string")
    s_df = spark.createDataFrame(rows, "customer_id bigint, tag_id bigint, is_active boolean")
    t_df = spark.createDataFrame(tags, "tag_id bigint, tag_property string")
    out = preferences.top_preferences(eligible, s_df, t_df)
    got = [tuple(r) for r in out.collect()]

    con = duckdb.connect()
    con.register("p", pa.table({"customer_id": pa.array([p[0] for p in people], pa.int64()),
                                "first_name": [p[1] for p in people], "last_name": [p[2] for p in people],
                                "email": [p[3] for p in people]}))
    con.register("s", pa.table({"customer_id": pa.array([r[0] for r in rows], pa.int64()),
                                "tag_id": pa.array([r[1] for r in rows], pa.int64()),
                                "is_active": pa.array([r[2] for r in rows], pa.bool_())}))
    con.register("t", pa.table({"tag_id": pa.array([t[0] for t in tags], pa.int64()),
                                "tag_property": pa.array([t[1] for t in tags], pa.string())}))
    want = con.sql("""
        WITH tagged AS (SELECT s.customer_id, t.tag_property, trim(lower(t.tag_property)) AS tag
                        FROM s LEFT JOIN t ON s.tag_id = t.tag_id),
             ranked AS (SELECT p.customer_id, p.first_name, p.last_name, p.email, tagged.tag,
                               rank() OVER (PARTITION BY p.customer_id ORDER BY tagged.tag) AS r
                        FROM p LEFT JOIN tagged ON p.customer_id = tagged.customer_id
                        WHERE tagged.tag_property != '<NA>')
        SELECT customer_id, first_name, last_name, email,
               min(CASE WHEN r = 1 THEN tag END) AS food_preference_1,
               min(CASE WHEN r = 2 THEN tag END) AS food_preference_2,
               min(CASE WHEN r = 3 THEN tag END) AS food_preference_3
        FROM ranked GROUP BY customer_id, first_name, last_name, email""").fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)
