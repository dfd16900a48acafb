"""Nearest supplier per customer and nearest backup supplier per supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sousflow.functions.geo import METRES_PER_KM, METRES_PER_MILE
from sousflow.functions.text import clean_upper
from sousflow.operators.dedup import canonical_rows
from sousflow.operators.nearest import nearest_locations
from sousflow.operators.topn import closest_per_group
from sousflow.plans.places import canonical_cities, city_coordinates, eligible_customers
from sousflow.session import materialised


def located_suppliers(supplier_info: DataFrame, us_cities: DataFrame, strict: bool = True,
                      cities: DataFrame | None = None) -> DataFrame:
    """Suppliers with the location of their city; NULL location when no city matches.

    The city match is lower-case name and the state as stored on the supplier
    against the upper-cased city state (no trimming on the supplier side).
    """
    cities = (cities if cities is not None else canonical_cities(us_cities, strict)).select(
        F.lower("city_name").alias("_city"), F.upper("state_abbr").alias("_state"), "lat", "lon")
    sup = supplier_info.select("supplier_id", "supplier_name",
                               F.lower("supplier_city").alias("_city"), F.col("supplier_state").alias("_state"))
    return (sup.join(cities, ["_city", "_state"], "left")
               .select("supplier_id", "supplier_name", "lat", "lon"))


def nearest_supplier(customer_address: DataFrame, us_cities: DataFrame, customer_data: DataFrame,
                     supplier_info: DataFrame, strict: bool = True, round_km: int | None = 3) -> DataFrame:
    """Each eligible customer with the closest supplier(s), ties kept, distance in km.

    Distance depends on location only, and every customer location is a city
    location, so the search runs once per distinct city location (a dimension)
    against distinct supplier locations. Customers then take their location's best
    distance, keep the rows at their overall minimum (a customer may have several
    address rows) and fan out to the tied suppliers through a
    location equi-join. Suppliers without a location never win; a customer with no
    distance at all (its city has no coordinates, or no supplier has a location)
    is returned once per address row with NULL supplier and distance.
    """
    # the city dimension feeds four branches; it is materialised once
    cities = materialised(canonical_cities(us_cities, strict))
    cust = eligible_customers(customer_address, us_cities, customer_data, strict, cities=cities).select(
        "customer_id", "first_name", "last_name", "email", "lat", "lon")
    sup = located_suppliers(supplier_info, us_cities, strict, cities=cities)
    # feeds the search and the last join
    located = materialised(sup.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()))

    near = nearest_locations(cities, located).select(F.col("q_lat").alias("lat"), F.col("q_lon").alias("lon"), "t_lat", "t_lon", "distance_m")
    # a customer row without any distance finds no place and keeps NULL supplier columns
    closest = closest_per_group(cust.join(near, ["lat", "lon"], "left"), ["customer_id"], "distance_m")
    shops = located.select(F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"), "supplier_id", "supplier_name")
    cols = ["customer_id", "first_name", "last_name", "email", "supplier_id", "supplier_name", "distance_m"]
    rows = closest.join(shops, ["t_lat", "t_lon"], "left").select(*cols)

    km = F.col("distance_m") / METRES_PER_KM
    if round_km is not None:
        km = F.round(km, round_km)
    return (rows.select(*cols[:-1], km.alias("shipping_distance_km"))
                .orderBy(F.col("last_name").asc_nulls_last(), F.col("first_name").asc_nulls_last()))


def supplier_geography(supplier_info: DataFrame, us_cities: DataFrame, strict: bool = True) -> DataFrame:
    """Suppliers matched to one city row by trimmed upper-case city and state."""
    suppliers = supplier_info.select(
        "supplier_id", "supplier_name",
        F.concat(F.col("supplier_city"), F.lit(", "), F.col("supplier_state")).alias("supplier_location"),
        clean_upper("supplier_city").alias("_city"), clean_upper("supplier_state").alias("_state"))
    cities = city_coordinates(us_cities).select("city_id", "city_name", "state_abbr",
                              clean_upper("city_name").alias("_city"), clean_upper("state_abbr").alias("_state"),
                              "lat", "lon")
    if strict:
        firsts = canonical_rows(cities, "city_id", ["_city", "_state"], ["_city", "_state"])
    else:
        ids = cities.groupBy("city_name", "state_abbr").agg(F.min("city_id").alias("city_id"))
        firsts = cities.join(ids.select("city_id"), "city_id", "inner")
    return (suppliers.join(firsts.select("_city", "_state", "lat", "lon"), ["_city", "_state"], "inner")
                     .select("supplier_id", "supplier_name", "supplier_location", "lat", "lon"))


def backup_supplier(supplier_info: DataFrame, us_cities: DataFrame, strict: bool = True) -> DataFrame:
    """Each located supplier with the closest supplier(s) in a *different* place, miles.

    Distance 0 (same place, including the supplier itself) is excluded. Ties give
    one row per tied backup supplier. The search runs on distinct locations; the
    minimum is taken at the supplier grain, then rows fan out to tied backups by location.
    """
    # feeds the search (both sides) and both join-backs: materialised once
    geo = materialised(supplier_geography(supplier_info, us_cities, strict))
    near = nearest_locations(geo, geo, exclude_zero=True).select(F.col("q_lat").alias("lat"), F.col("q_lon").alias("lon"), "t_lat", "t_lon", "distance_m")
    mains = closest_per_group(geo.join(near, ["lat", "lon"], "inner"), ["supplier_id"], "distance_m")
    backups = geo.select(F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"), F.col("supplier_location").alias("location_backup"))
    pairs = mains.join(backups, ["t_lat", "t_lon"], "inner").select(
        "supplier_id", F.col("supplier_location").alias("location_main"), "location_backup",
        F.round(F.col("distance_m") / METRES_PER_MILE).alias("travel_miles"))
    # the supplier's name comes from the supplier table by id (every row of that id)
    names = supplier_info.select("supplier_id", "supplier_name")
    return (pairs.join(names, "supplier_id", "inner")
                 .select("supplier_id", "supplier_name", "location_main", "location_backup", "travel_miles")
                 .orderBy(F.col("supplier_name").asc_nulls_last()))
