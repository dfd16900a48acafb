"""Small business tables built in memory, one edge case per row (see FIXTURES.md).

Each table is a (schema, rows) pair so the same rows load into Spark and DuckDB.
"""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import types as T

L, S, D, B = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


CHICAGO = (41.8781, -87.6298)
GARY = (41.6020, -87.3371)

TABLES = {
    "us_cities": (_schema(("city_id", L), ("city_name", S), ("state_abbr", S), ("lat", D), ("lon", D)), [
        (1, "CHICAGO", "IL", *CHICAGO),
        (4, "CHICAGO", "IL", *CHICAGO),          # same spelling, larger id: dropped
        (3, " chicago ", "il", *CHICAGO),        # second spelling of one city (B1)
        (2, "GARY", "IN", *GARY),
        (5, "GARY", "IN", *GARY),                # a store stored twice (B6)
        (6, "LOUISVILLE", "KY", 38.2527, -85.7585),
        (7, "ASHLAND", "KY", 38.4784, -82.6379),
        (8, "OAKLAND", "CA", 37.8044, -122.2712),
        (9, "SPRINGFIELD", "IL", 39.7817, -89.6501),
        (10, "SPRINGFIELD", "MO", 37.2090, -93.2923),  # same name, other state
        (11, "EVANSTON", "IL", 42.0451, -87.6877),
        (12, "ARLINGTON", "TX", 32.7357, -97.1081),
        (13, "NOWHERESVILLE", "IL", None, None),       # a known city without coordinates
    ]),
    "customer_address": (_schema(("customer_id", L), ("customer_city", S), ("customer_state", S)), [
        (1, "  Chicago ", "il"),        # dirty but eligible
        (2, "Atlantis", "IL"),          # unknown city
        (3, "ashland", " KY"),          # padded state: joins, fails the literal filter (B7)
        (4, None, "IL"),                # NULL city
        (5, "\tSpringfield", "IL"),     # tab is not trimmed: no match
        (6, "Ashland", "KY"),
        (7, "springfield", "mo"),
        (8, "Evanston", "IL"),          # no customer_data row
        (9, "Oakland", "CA"),
        (10, "Arlington", "TX"),
        (11, "Nowheresville", "IL"),   # eligible, but no distance can be computed
    ]),
    "customer_data": (_schema(("customer_id", L), ("first_name", S), ("last_name", S), ("email", S)), [
        (1, "Ann", "Smith", "ann@x.test"),
        (2, "Bob", "Jones", "bob@x.test"),
        (3, "Cy", "Smith", "cy@x.test"),
        (4, "Di", "Lee", "di@x.test"),
        (5, "Ed", "Kim", "ed@x.test"),
        (6, None, "Ray", "ray@x.test"),   # NULL first name: concatenated name is NULL
        (7, "Flo", "Smith", "flo@x.test"),
        (9, "Gus", "Oak", "gus@x.test"),
        (10, "Hal", "Arl", "hal@x.test"),
        (11, "Ivy", "Null", "ivy@x.test"),
    ]),
    "supplier_info": (_schema(("supplier_id", L), ("supplier_name", S), ("supplier_city", S), ("supplier_state", S)), [
        (1, "Alpha", "Chicago", "IL"),
        (2, "Bravo", "chicago", "IL"),     # same city as Alpha: distance 0, tie (B11, B12)
        (3, "Charlie", "Nowhere", "IL"),   # no location (B3)
        (4, "Delta", "Springfield", "IL"),
        (5, "Echo", " Gary ", "IN"),       # padded: matched by trimmed join only (B2)
        (6, "Foxtrot", "Oakland", "CA"),
        (7, "Golf", "Louisville", "KY"),
    ]),
    "customer_survey": (_schema(("customer_id", L), ("tag_id", L), ("is_active", B)), [
        (1, 10, True), (1, 11, True), (1, 12, True), (1, 13, False), (1, 14, True),   # five preferences
        (6, 10, True), (6, 10, True), (6, 14, None),                                # same tag twice (B5)
        (7, 15, True),                                                              # '<NA>' only (B4)
        (9, 99, True),                                                              # unknown tag
        (9, 12, True),
        (10, 11, True), (10, 13, True), (10, 16, True),
        (3, 12, True),
    ]),
    "recipe_tags": (_schema(("tag_id", L), ("tag_property", S)), [
        (10, " Vegan "), (11, "gluten free"), (12, "SPICY"), (13, "quick"), (14, "zesty"),
        (15, "<NA>"), (16, None),
    ]),
    "recipe": (_schema(("recipe_id", L), ("recipe_name", S), ("tag_list", T.ArrayType(S)), ("ingredients", T.ArrayType(S))), [
        (100, "birthday cookie", ["vegan", " Spicy"], ['"flour"', "sugar ", "butter"]),
        (101, "frosted lemon cookies", ["vegan"], ["flour", "lemon"]),
        (102, "snickerdoodles cinnamon cookies", [], ["cinnamon"]),
        (103, "plain bread", None, ["flour"]),
        (104, "honey oatmeal raisin cookies", ["quick"], ["oats", "unknownthing"]),
        (105, "a perfect sugar cookie", ["gluten free"], []),
    ]),
    "nutrition": (_schema(("ingredient_name", S), ("calories", L), ("total_fat", S)), [
        ("flour, white", 100, "1g"),
        ("flour, rye", 90, "2g"),
        ("sugar, cane", 50, "0g"),
        ("butter, salted", 200, "9g"),
        ("butter, unsalted", 210, "10g"),   # text maximum is '9g' (B8)
        ("lemon", 10, "0g"),                # no comma: key '' (B9)
        ("cinnamon", 5, "1.5g"),            # no comma, decimal fat (D6)
        ("oats, rolled", 150, None),
    ]),
}


def _t(day, h, m, s, us=0):
    return dt.datetime(2024, 3, day, h, m, s, us)


def _ev(event, recipe=None):
    return '{"event": "%s", "recipe_id": "%s"}' % (event, recipe) if recipe else '{"event": "%s"}' % event


# event_id, session_id, user_id, event_timestamp, event_details
EVENTS = [
    # s1: two searches then a view of recipe 7; the home event is logged twice (B17)
    (1, "s1", 1, _t(1, 10, 0, 0), _ev("home")),
    (2, "s1", 1, _t(1, 10, 0, 0), _ev("home")),
    (3, "s1", 1, _t(1, 10, 1, 0), _ev("search")),
    (4, "s1", 1, _t(1, 10, 2, 0), _ev("search")),
    (5, "s1", 1, _t(1, 10, 3, 0), _ev("view_recipe", 7)),
    # s2: a view then ends on a search: not counted (B16)
    (6, "s2", 2, _t(1, 11, 0, 0), _ev("view_recipe", 8)),
    (7, "s2", 2, _t(1, 11, 5, 0), _ev("search")),
    # s3: crosses midnight, ends on a view of 8 (counted on its start day, B14)
    (8, "s3", 3, _t(1, 23, 59, 0), _ev("search")),
    (19, "s3", 3, _t(2, 0, 1, 0), _ev("view_recipe", 8)),
    (9, "s3", 3, _t(2, 0, 2, 0), _ev("view_recipe", 8)),
    # s4: ends on a view of 7, so 7 and 8 tie on day 1 with 2 views each;
    # sub-second ends: 00.900 -> 01.100 is 1 s by boundaries (D10)
    (10, "s4", 4, _t(1, 12, 0, 0, 900000), _ev("search")),
    (11, "s4", 4, _t(1, 12, 0, 1, 100000), _ev("view_recipe", 7)),
    # day 3: only single-event sessions, average length 0: day dropped (B13)
    (12, "s5", 5, _t(3, 9, 0, 0), _ev("view_recipe", 9)),
    (13, "s6", 6, _t(3, 10, 0, 0), _ev("search")),
    # day 4: no session ends on a view: most viewed is '' (D4); malformed JSON (D15)
    (14, "s7", 7, _t(4, 9, 0, 0), "not json"),
    (15, "s7", 7, _t(4, 9, 0, 30), _ev("search")),
    (16, "s8", 8, _t(4, 10, 0, 0), _ev("home")),
    (17, "s8", 8, _t(4, 10, 1, 0), _ev("view_recipe", 3)),
    (18, "s8", 8, _t(4, 10, 2, 0), _ev("search")),
]

TABLES["website_activity"] = (
    _schema(("event_id", L), ("session_id", S), ("user_id", L), ("event_timestamp", TS), ("event_details", S)),
    EVENTS,
)

_ARROW = {L: pa.int64(), S: pa.string(), D: pa.float64(), B: pa.bool_(), TS: pa.timestamp("us")}


def _arrow_type(t):
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return _ARROW[t]


def spark_tables(spark) -> dict:
    return {name: spark.createDataFrame(rows, schema) for name, (schema, rows) in TABLES.items()}


def register_duckdb(con) -> None:
    for name, (schema, rows) in TABLES.items():
        cols = list(zip(*rows)) if rows else [[] for _ in schema.fields]
        arrow = pa.table({f.name: pa.array(list(c), type=_arrow_type(f.dataType)) for f, c in zip(schema.fields, cols)})
        con.register(f"{name}_arrow", arrow)
        con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM {name}_arrow")
