"""Reference-shaped views derived from the generated TPC-H-style tables.

The jobs expect the business tables (cities, customers, suppliers, survey, recipes,
nutrition, website activity). The test data is a star schema of nations, regions,
customers, suppliers, parts, orders, line items and events; these views derive the
business tables from it with fixed rules, including deliberately dirty spellings
so that cleaning and de-duplication have work to do. Every view is a lazy
DataFrame over the parquet scans, so its size follows the source tables.

No rule drops rows: the modulo rules only pick a spelling, a known or unknown
city, or a flag for each row, and every source row is kept.

The same rules are written in DuckDB SQL in ``sousflow.plans.oracle``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sousflow.functions.time import epoch_seconds
from sousflow.sources.tables import Tables

# Fixed values of the bridge.
PLACE_CUSTOMERS = 200         # customer keys per block; a nation has one place for each block of customers
PLACE_SUPPLIERS = 13          # supplier keys per block: the same blocks, as suppliers are so much fewer
NATIONS = 25                  # place number = nation key + 25 * block
DIRTY_CITY_EVERY = 4          # every 4th place gets a second, dirty city row
INELIGIBLE_CUSTOMER_EVERY = 7 # these customers live in a city that is not in the table
UNKNOWN_CITY = "NOWHERE"
UNLOCATED_SUPPLIER_EVERY = 3  # suppliers of every 3rd nation have an unknown city
INACTIVE_SURVEY_EVERY = 5     # survey rows of these customers are inactive
MISSING_TAG_TYPE = "PROMO"    # this part type is recorded as the text '<NA>'
MISSING_TEXT = "<NA>"
SESSION_BUCKET_SECONDS = 129600  # 36 hours: a user's events in one bucket form a session
EVENT_NAMES = {"view": "view_recipe", "click": "search"}
EMAIL_DOMAIN = "@example.com"
# Stand-ins for the business lists, in terms of the generated places and parts.
BRIDGE_CITY_RULES = [("AFRICA", ["%nation_1%", "%nation_5"]), ("ASIA", ["%2%"])]
BRIDGE_STORES = {"chicago": ("NATION_5", "AFRICA"), "gary": ("NATION_9", "MIDDLE EAST")}
BRIDGE_RECIPES = ["red plate", "small widget", "hot ring", "old rod", "large rod"]


def _coordinate(key: str, mult: int, modulo: int, shift: int, frac: int) -> str:
    """((key*mult) % modulo - shift) + ((key*frac) % 10000)/10000, exact integers then one division."""
    return f"CAST((pmod({key} * {mult}, {modulo}) - {shift}) * 10000 + pmod({key} * {frac}, 10000) AS DOUBLE) / 10000.0D"


def _block(key: str, size: int) -> str:
    return f"CAST(floor({key} / {size}) AS BIGINT)"


def _place_name(block: str) -> str:
    """A nation's first place has the nation's name, the others its name and the block."""
    return f"CASE WHEN {block} = 0 THEN n_name ELSE concat_ws(' ', n_name, CAST({block} AS STRING)) END"


class Bridge:
    """The views; their expressions are SQL text, which reaches the JVM in one call each."""

    def __init__(self, tables: Tables):
        self.t = tables

    # -- places -----------------------------------------------------------
    @cached_property
    def _nations(self) -> DataFrame:
        n = self.t.nation.selectExpr("CAST(n_nationkey AS BIGINT) AS k", "n_name", "n_regionkey AS r_regionkey")
        return n.join(self.t.region.select("r_regionkey", "r_name"), "r_regionkey", "inner").select("k", "n_name", "r_name")

    @cached_property
    def _places(self) -> DataFrame:
        """One row per (nation, block) that has customers: the places grow with the customers."""
        blocks = self.t.customer.selectExpr("CAST(c_nationkey AS BIGINT) AS k", f"{_block('c_custkey', PLACE_CUSTOMERS)} AS block").distinct()
        place = f"k + {NATIONS} * block"
        return blocks.join(self._nations, "k", "inner").selectExpr(
            f"{place} AS place", f"{_place_name('block')} AS name", "r_name",
            f"{_coordinate(f'({place})', 37, 110, 55, 137)} AS lat", f"{_coordinate(f'({place})', 71, 340, 170, 291)} AS lon")

    @cached_property
    def us_cities(self) -> DataFrame:
        """city_id, city_name, state_abbr, lat, lon; some cities twice, dirty (with an odd id)."""
        # only every DIRTY_CITY_EVERY-th place has the second row
        dirty = f"CASE WHEN pmod(place, {DIRTY_CITY_EVERY}) = 0 THEN struct(2 * place + 1 AS city_id, concat('  ', lower(name), ' ') AS city_name, lower(r_name) AS state_abbr, lat, lon) END"
        rows = self._places.selectExpr(f"explode(array(struct(2 * place AS city_id, name AS city_name, r_name AS state_abbr, lat, lon), {dirty})) AS _row")
        return rows.where("_row IS NOT NULL").selectExpr("_row.*")

    # -- customers --------------------------------------------------------
    @cached_property
    def customer_data(self) -> DataFrame:
        return self.t.customer.selectExpr("c_custkey AS customer_id", "c_mktsegment AS first_name", "c_name AS last_name",
                                          f"concat(lower(replace(c_name, '#', '.')), '{EMAIL_DOMAIN}') AS email")

    @cached_property
    def customer_address(self) -> DataFrame:
        """City names in mixed case and padded (states as stored); some cities unknown."""
        keyed = self.t.customer.selectExpr("c_custkey AS customer_id", "CAST(c_nationkey AS BIGINT) AS k", f"{_block('c_custkey', PLACE_CUSTOMERS)} AS block")
        placed = keyed.join(self._nations, "k", "inner").selectExpr("customer_id", f"{_place_name('block')} AS place_name", "r_name AS customer_state")
        city = (f"CASE WHEN pmod(customer_id, {INELIGIBLE_CUSTOMER_EVERY}) = 0 THEN '{UNKNOWN_CITY}' WHEN pmod(customer_id, 3) = 0 THEN place_name "
                "WHEN pmod(customer_id, 3) = 1 THEN lower(place_name) ELSE concat('  ', place_name, ' ') END")
        return placed.selectExpr("customer_id", f"{city} AS customer_city", "customer_state")

    # -- suppliers --------------------------------------------------------
    @cached_property
    def supplier_info(self) -> DataFrame:
        s = self.t.supplier.selectExpr("s_suppkey", "s_name", "CAST(s_nationkey AS BIGINT) AS k", f"{_block('s_suppkey', PLACE_SUPPLIERS)} AS block")
        city = f"CASE WHEN pmod(k, {UNLOCATED_SUPPLIER_EVERY}) = 0 THEN '{UNKNOWN_CITY}' ELSE {_place_name('block')} END"
        return s.join(self._nations, "k", "inner").selectExpr("s_suppkey AS supplier_id", "s_name AS supplier_name", f"{city} AS supplier_city", "r_name AS supplier_state")

    # -- survey and tags --------------------------------------------------
    @cached_property
    def _tag_ids(self) -> DataFrame:
        return self.t.part.groupBy("p_type").agg(F.expr("CAST(min(p_partkey) AS BIGINT) AS tag_id"))

    @cached_property
    def recipe_tags(self) -> DataFrame:
        """tag_id = smallest part key of the type; the missing type reads '<NA>'."""
        prop = f"CASE WHEN p_type = '{MISSING_TAG_TYPE}' THEN '{MISSING_TEXT}' ELSE concat(' ', p_type) END"
        return self._tag_ids.selectExpr("tag_id", f"{prop} AS tag_property")

    @cached_property
    def customer_survey(self) -> DataFrame:
        """One row per (customer, part type ordered); inactive for every 5th customer."""
        li = self.t.lineitem.selectExpr("l_orderkey AS o_orderkey", "l_partkey AS p_partkey")
        ordered = (li.join(self.t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "inner")
                     .join(self.t.part.select("p_partkey", "p_type"), "p_partkey", "inner")
                     .selectExpr("o_custkey AS customer_id", "p_type").distinct())
        return ordered.join(self._tag_ids, "p_type", "inner").selectExpr("customer_id", "tag_id", f"pmod(customer_id, {INACTIVE_SURVEY_EVERY}) <> 0 AS is_active")

    # -- recipes ----------------------------------------------------------
    @cached_property
    def recipe(self) -> DataFrame:
        return self.t.part.selectExpr("p_partkey AS recipe_id", "p_name AS recipe_name", "split(p_name, ' ') AS tag_list", "split(p_name, ' ') AS ingredients")

    @cached_property
    def nutrition(self) -> DataFrame:
        return self.t.part.selectExpr("replace(p_name, ' ', ', ') AS ingredient_name", "CAST(p_size AS BIGINT) AS calories", "concat(CAST(p_size AS STRING), 'g') AS total_fat")

    # -- website activity -------------------------------------------------
    @cached_property
    def website_activity(self) -> DataFrame:
        """Events with a session id (user and 36-hour bucket) and JSON details."""
        e = self.t.events.select("event_id", "ts", "user_id", "event_type", "props", epoch_seconds("ts").alias("_sec"))
        name = "CASE event_type " + " ".join(f"WHEN '{raw}' THEN '{mapped}'" for raw, mapped in EVENT_NAMES.items()) + " ELSE event_type END"
        bucket = f"CAST((_sec - pmod(_sec, {SESSION_BUCKET_SECONDS})) / {SESSION_BUCKET_SECONDS} AS BIGINT)"
        return e.selectExpr("event_id", f"concat(CAST(user_id AS STRING), '-', CAST({bucket} AS STRING)) AS session_id", "user_id", "ts AS event_timestamp",
                            f"to_json(struct({name} AS event, get_json_object(props, '$.k') AS recipe_id)) AS event_details")
