"""Customers affected by store changes: preference counts, city rules, store distances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sousflow.functions.geo import METRES_PER_MILE, great_circle_sql
from sousflow.functions.text import clean_lower, clean_upper, concat_name
from sousflow.plans.places import city_coordinates

# The city rules and stores of the original business report.
# Each rule is (customer state as stored, city-name patterns matched with ILIKE).
REFERENCE_CITY_RULES = [
    ("KY", ["%concord%", "%georgetown%", "%ashland%"]),
    ("CA", ["%oakland%", "%pleasant hill%"]),
    ("TX", ["%arlington%", "%brownsville%"]),
]
REFERENCE_STORES = {"chicago": ("CHICAGO", "IL"), "gary": ("GARY", "IN")}


def active_preference_counts(customer_survey: DataFrame) -> DataFrame:
    """Active survey rows per customer."""
    return (customer_survey.where(F.col("is_active"))
                           .groupBy("customer_id").agg(F.count(F.lit(1)).alias("food_pref_count")))


def city_rule_predicate(rules: Sequence[tuple[str, Sequence[str]]], state: Column, city: Column) -> Column:
    """OR over rules of (state = literal AND trimmed city ILIKE any pattern)."""
    terms = []
    for rule_state, patterns in rules:
        any_city = reduce(lambda a, b: a | b, [F.trim(city).ilike(p) for p in patterns])
        terms.append((state == F.lit(rule_state)) & any_city)
    return reduce(lambda a, b: a | b, terms)


def impacted_customers(customer_address: DataFrame, customer_data: DataFrame, us_cities: DataFrame,
                       customer_survey: DataFrame,
                       rules: Sequence[tuple[str, Sequence[str]]] = REFERENCE_CITY_RULES) -> DataFrame:
    """Customers with active preferences living in a city named by the rules.

    The address matches every city row with the same cleaned name and state (no
    de-duplication), so a city stored twice gives the customer twice. The state
    literal is compared with the address state as stored.
    """
    addr = customer_address.select("customer_id", "customer_city", "customer_state",
                                   clean_lower("customer_city").alias("_city"),
                                   clean_upper("customer_state").alias("_state"))
    cities = city_coordinates(us_cities).select(F.col("city_name").alias("uc_city_name"),
                              clean_lower("city_name").alias("_city"), clean_upper("state_abbr").alias("_state"),
                              "lat", "lon")
    people = customer_data.select("customer_id", "first_name", "last_name")
    named = (addr.join(people, "customer_id", "inner")
                 .join(cities, ["_city", "_state"], "left")
                 .where(city_rule_predicate(rules, F.col("customer_state"), F.col("uc_city_name"))))
    # only the survey rows of these customers are counted
    prefs = active_preference_counts(customer_survey.join(named.select("customer_id").distinct(), "customer_id", "left_semi"))
    return (named.join(prefs, "customer_id", "inner")
                 .select("customer_id", "first_name", "last_name", "customer_city", "customer_state",
                          "food_pref_count", "lat", "lon"))


def store_distances(customers: DataFrame, us_cities: DataFrame,
                    stores: Mapping[str, tuple[str, str]] = REFERENCE_STORES) -> DataFrame:
    """Customer name, place, preference count and whole miles to each fixed store.

    A store is every city row with that exact name and state. One pass over the cities gathers the
    locations of all stores as a scalar subquery of the plan, and each customer row is exploded over them in
    place: no join, no key and no shuffle of the customers. A store stored in n rows gives each customer n
    rows (equal locations are gathered once, with their number), and a store with no row gives no rows, as
    a join with it would. A customer or store without coordinates has NULL distances.
    """
    labels = list(stores)
    wanted = [f"city_name = {_text(city)} AND state_abbr = {_text(state)}" for city, state in stores.values()]
    found = city_coordinates(us_cities).selectExpr(f"array({', '.join(f'{w}' for w in wanted)}) AS _is", "lat", "lon").where("exists(_is, x -> x)")
    counted = found.groupBy("_is", "lat", "lon").agg(F.expr("CAST(count(1) AS INT) AS n"))
    lists = counted.agg(F.struct(*[F.expr(f"collect_list(CASE WHEN _is[{i}] THEN struct(lat, lon, n) END) AS s{i}") for i in range(len(labels))]).alias("_stores"))
    rows = customers.select(concat_name("first_name", "last_name").alias("customer_name"), "customer_city", "customer_state", "food_pref_count", "lat", "lon",
                            lists.scalar().alias("_stores"))
    kept, names = ["customer_name", "customer_city", "customer_state", "food_pref_count"], []
    for i, label in enumerate(labels):
        miles = f"CAST(round({great_circle_sql('lat', 'lon', '_at.lat', '_at.lon')} / {METRES_PER_MILE}) AS INT)"
        each = rows.selectExpr(*kept, *names, "lat", "lon", "_stores", f"explode(_stores.s{i}) AS _at")
        rows = each.selectExpr(*kept, *names, "lat", "lon", "_stores", f"explode(array_repeat({miles}, _at.n)) AS `{label}_distance_miles`")
        names.append(f"`{label}_distance_miles`")
    return rows.selectExpr(*kept, *names)


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
