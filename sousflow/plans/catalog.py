"""Registered queries: name -> callable(spark, data_dir) -> DataFrame.

Each query builds the reference-shaped views over the parquet tables of
``data_dir`` (see ``sousflow.sources.bridge``) and runs one job on them, over the
whole tables. The matching DuckDB SQL is in ``sousflow.plans.oracle``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sousflow.operators.nested import flatten
from sousflow.plans import customers, places, preferences, recipes, sessions, suppliers
from sousflow.session import ensure_checkpoint_dir
from sousflow.sources.bridge import BRIDGE_CITY_RULES, BRIDGE_RECIPES, BRIDGE_STORES, Bridge
from sousflow.sources.tables import Tables, register_external

Query = Callable[[SparkSession, str], DataFrame]


def _b(spark: SparkSession, data_dir: str) -> Bridge:
    return Bridge(Tables(spark, data_dir))


# The business tables that are previewed, each with the columns that order its rows.
PREVIEWS = {
    "us_cities": ["city_id"], "customer_data": ["customer_id"], "customer_address": ["customer_id"],
    "supplier_info": ["supplier_id"], "customer_survey": ["customer_id", "tag_id"], "recipe_tags": ["tag_id"],
    "recipe": ["recipe_id"], "nutrition": ["ingredient_name", "calories"], "website_activity": ["event_id"],
}
PREVIEW_ROWS = 4


def preview(table: DataFrame, order: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a table in a fixed order (a top-n, never a full sort); its arrays as text."""
    top = table.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(rows)
    return top.select(*[F.array_join(c, ",").alias(c) if kind.startswith("array") else F.col(c) for c, kind in top.dtypes])


def preview_limit(spark, d):
    return preview(Tables(spark, d).nation, ["n_nationkey"])


def _preview_of(name: str) -> Query:
    def run(spark, d):
        return preview(getattr(_b(spark, d), name), PREVIEWS[name])
    run.__name__ = f"preview_{name}"
    return run


def clean_keys(spark, d):
    return places.clean_addresses(_b(spark, d).customer_address)


def city_profile(spark, d):
    return places.city_profile(_b(spark, d).us_cities)


def duplicate_cities(spark, d):
    return places.duplicate_cities(_b(spark, d).us_cities)


def canonical_cities(spark, d):
    return places.canonical_cities(_b(spark, d).us_cities, strict=False)


def canonical_cities_strict(spark, d):
    return places.canonical_cities(_b(spark, d).us_cities, strict=True)


def customer_city_left(spark, d):
    b = _b(spark, d)
    return places.customers_with_city(b.customer_address, b.us_cities, b.customer_data)


def eligible_customers(spark, d):
    b = _b(spark, d)
    return places.eligible_customers(b.customer_address, b.us_cities, b.customer_data, strict=True)


def eligible_customers_parity(spark, d):
    b = _b(spark, d)
    return places.eligible_customers(b.customer_address, b.us_cities, b.customer_data, strict=False)


def nearest_supplier(spark, d):
    b = _b(spark, d)
    return suppliers.nearest_supplier(b.customer_address, b.us_cities, b.customer_data, b.supplier_info, strict=True)


def nearest_supplier_parity(spark, d):
    b = _b(spark, d)
    return suppliers.nearest_supplier(b.customer_address, b.us_cities, b.customer_data, b.supplier_info, strict=False)


def backup_supplier_parity(spark, d):
    b = _b(spark, d)
    return suppliers.backup_supplier(b.supplier_info, b.us_cities, strict=False)


def backup_supplier(spark, d):
    b = _b(spark, d)
    return suppliers.backup_supplier(b.supplier_info, b.us_cities, strict=True)


# Which database of the catalog holds which tables.
DATABASES = {"supply": ["supplier"], "resources": ["nation", "region", "customer"]}


def supplier_places(spark, d):
    """Suppliers of one database located by the cities of another one; both are in the session's catalog."""
    mark = hashlib.sha256(d.encode()).hexdigest()[:12]
    for name, tables in DATABASES.items():
        register_external(spark, f"{name}_{mark}", d, tables, ensure_checkpoint_dir(spark))
    b = Bridge(Tables.across(spark, {f"{name}_{mark}": tables for name, tables in DATABASES.items()}))
    return suppliers.supplier_geography(b.supplier_info, b.us_cities)


def _top3(b: Bridge, strict: bool = True) -> DataFrame:
    eligible = places.eligible_customers(b.customer_address, b.us_cities, b.customer_data, strict=strict)
    return preferences.top_preferences(eligible, b.customer_survey, b.recipe_tags, n=3)


def top3_preferences(spark, d):
    return _top3(_b(spark, d))


def top3_preferences_parity(spark, d):
    return _top3(_b(spark, d), strict=False)


def top3_preferences_distinct(spark, d):
    b = _b(spark, d)
    eligible = places.eligible_customers(b.customer_address, b.us_cities, b.customer_data, strict=True)
    return preferences.top_preferences(eligible, b.customer_survey, b.recipe_tags, n=3, distinct_tags=True)


def recipe_index(spark, d):
    return preferences.recipe_by_tag(_b(spark, d).recipe)


def recipe_suggestion(spark, d):
    b = _b(spark, d)
    return preferences.recipe_suggestion(_top3(b), b.recipe)


def active_pref_count(spark, d):
    return customers.active_preference_counts(_b(spark, d).customer_survey)


def _impacted(b: Bridge) -> DataFrame:
    return customers.impacted_customers(b.customer_address, b.customer_data, b.us_cities, b.customer_survey,
                                        rules=BRIDGE_CITY_RULES)


def impacted_customers(spark, d):
    return _impacted(_b(spark, d))


def store_distances(spark, d):
    b = _b(spark, d)
    return customers.store_distances(_impacted(b), b.us_cities, stores=BRIDGE_STORES)


def recipe_nutrition(spark, d):
    b = _b(spark, d)
    return recipes.recipe_nutrition(b.recipe, b.nutrition, names=BRIDGE_RECIPES)


def recipe_nutrition_numeric(spark, d):
    b = _b(spark, d)
    return recipes.recipe_nutrition(b.recipe, b.nutrition, names=BRIDGE_RECIPES, numeric=True)


def flatten_index(spark, d):
    r = _b(spark, d).recipe.select("recipe_id", "ingredients")
    return flatten(r, "ingredients", value_col="ingredient", index_col="ingredient_index", keep=["recipe_id"])


def json_path_filter(spark, d):
    return sessions.recipe_views(_b(spark, d).website_activity)


def window_min_last(spark, d):
    return sessions.session_start_and_last_event(_b(spark, d).website_activity)


def session_summary(spark, d):
    return sessions.session_summary(_b(spark, d).website_activity)


def most_viewed_daily(spark, d):
    return sessions.most_viewed_daily(_b(spark, d).website_activity)


def daily_sessions(spark, d):
    return sessions.daily_sessions(_b(spark, d).website_activity)


def daily_report(spark, d):
    return sessions.daily_report(_b(spark, d).website_activity)


QUERIES: dict[str, Query] = {
    "preview_limit": preview_limit,
    **{f"preview_{name}": _preview_of(name) for name in PREVIEWS},
    "clean_keys": clean_keys,
    "city_profile": city_profile,
    "duplicate_cities": duplicate_cities,
    "canonical_cities": canonical_cities,
    "canonical_cities_strict": canonical_cities_strict,
    "customer_city_left": customer_city_left,
    "eligible_customers": eligible_customers,
    "eligible_customers_parity": eligible_customers_parity,
    "nearest_supplier": nearest_supplier,
    "nearest_supplier_parity": nearest_supplier_parity,
    "supplier_places": supplier_places,
    "top3_preferences": top3_preferences,
    "top3_preferences_parity": top3_preferences_parity,
    "top3_preferences_distinct": top3_preferences_distinct,
    "recipe_index": recipe_index,
    "recipe_suggestion": recipe_suggestion,
    "active_pref_count": active_pref_count,
    "impacted_customers": impacted_customers,
    "store_distances": store_distances,
    "recipe_nutrition": recipe_nutrition,
    "recipe_nutrition_numeric": recipe_nutrition_numeric,
    "flatten_index": flatten_index,
    "backup_supplier": backup_supplier,
    "backup_supplier_parity": backup_supplier_parity,
    "json_path_filter": json_path_filter,
    "window_min_last": window_min_last,
    "session_summary": session_summary,
    "most_viewed_daily": most_viewed_daily,
    "daily_sessions": daily_sessions,
    "daily_report": daily_report,
}

# The headline jobs timed by bench.py.
HEADLINE = ["daily_report", "session_summary", "nearest_supplier", "backup_supplier", "eligible_customers",
            "top3_preferences", "recipe_suggestion", "store_distances", "recipe_nutrition"]
