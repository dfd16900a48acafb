"""Supplier jobs on many distinct places, so the nearest search takes the
multi-round walk (more than LEAF_SIZE target locations), checked against the SQL."""

import hashlib
import math
import random
from collections import Counter

import duckdb
import pyarrow as pa

from sousflow.operators.nearest import LEAF_SIZE
from sousflow.plans import suppliers
from sousflow.plans.oracle import oracle_queries


def digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    c = Counter(repr(tuple(norm(r[i]) for i in order)) for r in data)
    return hashlib.sha256("".join(f"{k}:{c[k]}\n" for k in sorted(c)).encode()).hexdigest()


def build(spark):
    rnd = random.Random(11)
    states = ["IL", "IN", "KY", "CA", "TX"]
    cities = []
    for i in range(300):
        # two dense regions and a scatter, coordinates on a 1e-4 grid
        if i % 3 == 0:
            lat, lon = 41 + rnd.random(), -88 + rnd.random()
        elif i % 3 == 1:
            lat, lon = 34 + rnd.random() * 0.2, -118 + rnd.random() * 0.2
        else:
            lat, lon = rnd.uniform(-60, 70), rnd.uniform(-180, 180)
        cities.append((i + 1, f"CITY{i}", states[i % 5], round(lat, 4), round(lon, 4)))
    picks = [rnd.randrange(300) for _ in range(400)]
    customers = [(c, f"city{j}", states[j % 5].lower()) for c, j in enumerate(picks, start=1)]
    data = [(c, f"F{c % 7}", f"L{c % 13}", f"c{c}@x.test") for c in range(1, 400)]
    spots = [rnd.randrange(300) for _ in range(250)]
    # a few suppliers name a state that does not match: no location
    sups = [(s, f"S{s}", f"City{j}", states[(j + (s % 11 == 0)) % 5]) for s, j in enumerate(spots, start=1)]
    # a few ids used twice, with another name and place
    sups += [(s, f"S{s}bis", f"City{(j * 7) % 300}", states[((j * 7) % 300) % 5]) for s, j in list(enumerate(spots, start=1))[:5]]
    tables = {
        "us_cities": ("city_id bigint, city_name string, state_abbr string, lat double, lon double", cities),
        "customer_address": ("customer_id bigint, customer_city string, customer_state string", customers),
        "customer_data": ("customer_id bigint, first_name string, last_name string, email string", data),
        "supplier_info": ("supplier_id bigint, supplier_name string, supplier_city string, supplier_state string", sups),
    }
    con = duckdb.connect()
    frames = {}
    for name, (schema, rows) in tables.items():
        df = spark.createDataFrame(rows, schema)
        frames[name] = df
        con.register(f"{name}_a", df.toArrow() if hasattr(df, "toArrow") else pa.Table.from_pandas(df.toPandas()))
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_a")
    return frames, con


def test_supplier_jobs_on_many_places(spark):
    t, con = build(spark)
    sql = oracle_queries(bridge=False)
    jobs = {
        "nearest_supplier": suppliers.nearest_supplier(t["customer_address"], t["us_cities"], t["customer_data"],
                                                       t["supplier_info"]),
        "backup_supplier": suppliers.backup_supplier(t["supplier_info"], t["us_cities"]),
    }
    located = suppliers.supplier_geography(t["supplier_info"], t["us_cities"]).select("lat", "lon").distinct().count()
    assert located > LEAF_SIZE
    for name, df in jobs.items():
        got = [tuple(r) for r in df.collect()]
        rel = con.sql(sql[name])
        want = rel.fetchall()
        assert len(got) == len(want) > 0, name
        assert digest(df.columns, got) == digest(rel.columns, want), name


def test_stores_with_many_rows(spark):
    """1,001 rows of one store (two of them equal), one of the other, one of none: every customer row meets each."""
    from sousflow.plans import customers

    near = [("CHICAGO", "IL", 40.0 + i / 1000, -87.0) for i in range(1000)] + [("CHICAGO", "IL", 40.0, -87.0)]
    cities = spark.createDataFrame([*near, ("GARY", "IN", 41.6, -87.3), ("GARY", "IL", 0.0, 0.0), ("chicago", "IL", 0.0, 0.0)],
                                   "city_name string, state_abbr string, lat double, lon double")
    people = spark.createDataFrame([("A", "B", "c1", "KY", 2, 38.0, -84.5), ("A", None, "c2", "KY", 1, None, 1.0)],
                                   "first_name string, last_name string, customer_city string, customer_state string, food_pref_count int, lat double, lon double")
    got = customers.store_distances(people, cities)
    def miles(a, b):
        if None in (*a, *b):
            return None
        p, q = math.radians(a[0]), math.radians(b[0])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return math.floor(2 * 6371008.8 * math.asin(math.sqrt(h)) / 1609 + 0.5)

    rows = [tuple(r) for r in cities.collect()]
    at = {k: [r[2:] for r in rows if r[:2] == key] for k, key in customers.REFERENCE_STORES.items()}
    want = Counter((None if None in r[:2] else f"{r[0]} {r[1]}", *r[2:5], miles(r[5:], x), miles(r[5:], y))
                   for r in map(tuple, people.collect()) for x in at["chicago"] for y in at["gary"])
    assert Counter(map(tuple, got.collect())) == want and got.count() == 2002
    assert customers.store_distances(people, cities.where("city_name = 'GARY'")).count() == 0
