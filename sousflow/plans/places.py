"""Cities and customer addresses: cleaning, profiling, de-duplication, eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sousflow.functions.text import clean_lower, clean_upper
from sousflow.operators.dedup import canonical_rows, duplicate_keys, key_profile

CITY_KEYS = ["city_name_cleaned", "state_abbr_cleaned"]
ADDRESS_KEYS = ["customer_city_cleaned", "customer_state_cleaned"]


def city_coordinates(us_cities: DataFrame) -> DataFrame:
    """The city table with its longitude as ``lon`` (the warehouse table calls it ``long``)."""
    if "lon" not in us_cities.columns and "long" in us_cities.columns:
        return us_cities.withColumnRenamed("long", "lon")
    return us_cities


def clean_cities(us_cities: DataFrame) -> DataFrame:
    """Cities with a lower-case trimmed name and an upper-case trimmed state."""
    return city_coordinates(us_cities).select("city_id", "city_name", "state_abbr",
                            clean_lower("city_name").alias("city_name_cleaned"),
                            clean_upper("state_abbr").alias("state_abbr_cleaned"),
                            "lat", "lon")


def clean_addresses(customer_address: DataFrame) -> DataFrame:
    return customer_address.select("customer_id", "customer_city", "customer_state",
                                   clean_lower("customer_city").alias("customer_city_cleaned"),
                                   clean_upper("customer_state").alias("customer_state_cleaned"))


def city_profile(us_cities: DataFrame) -> DataFrame:
    """Distinct cleaned names, cleaned states and ids (one row)."""
    return key_profile(clean_cities(us_cities), {
        "num_city_names": "city_name_cleaned",
        "num_state_abbrs": "state_abbr_cleaned",
        "num_city_ids": "city_id",
    })


def duplicate_cities(us_cities: DataFrame) -> DataFrame:
    """Cleaned (city, state) keys carrying more than one id."""
    return duplicate_keys(clean_cities(us_cities), CITY_KEYS, "city_id", "num_cities")


def canonical_cities(us_cities: DataFrame, strict: bool = False) -> DataFrame:
    """One row per city: the row with the smallest id.

    ``strict=False`` groups by the raw spelling as well as the cleaned key, so two
    spellings of one city both survive (and can multiply joins downstream);
    ``strict=True`` groups by the cleaned key only, one row per city.
    """
    cities = clean_cities(us_cities)
    groups = CITY_KEYS if strict else ["city_name", "state_abbr", *CITY_KEYS]
    return canonical_rows(cities, "city_id", groups, CITY_KEYS).select(
        "city_id", "city_name", "state_abbr", *CITY_KEYS, "lat", "lon")


def customers_with_city(customer_address: DataFrame, us_cities: DataFrame,
                        customer_data: DataFrame) -> DataFrame:
    """Every address with its city location when one matches (all city rows, no dedup)."""
    addr = clean_addresses(customer_address)
    cities = clean_cities(us_cities)
    names = customer_data.select("customer_id", "first_name", "last_name")
    located = addr.join(cities, (addr.customer_city_cleaned == cities.city_name_cleaned)
                        & (addr.customer_state_cleaned == cities.state_abbr_cleaned), "left")
    return (located.select("customer_id", "customer_city", "customer_state", "lat", "lon")
                   .join(names, "customer_id", "left")
                   .select("customer_id", "first_name", "last_name", "customer_city", "customer_state", "lat", "lon"))


def eligible_customers(customer_address: DataFrame, us_cities: DataFrame, customer_data: DataFrame,
                       strict: bool = True, cities: DataFrame | None = None) -> DataFrame:
    """Addresses whose cleaned city/state is a known city, with names and location.

    ``cities`` may pass an already built ``canonical_cities(us_cities, strict)``.
    """
    addr = clean_addresses(customer_address)
    cities = cities if cities is not None else canonical_cities(us_cities, strict)
    people = customer_data.select("customer_id", "first_name", "last_name", "email")
    matched = addr.join(cities, (addr.customer_city_cleaned == cities.city_name_cleaned)
                        & (addr.customer_state_cleaned == cities.state_abbr_cleaned), "inner")
    return (matched.select("customer_id", "customer_city", "customer_state", "lat", "lon")
                   .join(people, "customer_id", "left")
                   .select("customer_id", "first_name", "last_name", "email",
                           "customer_city", "customer_state", "lat", "lon"))
