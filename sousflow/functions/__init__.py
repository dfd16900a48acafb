"""Column expressions. Every helper returns a built-in Spark ``Column``: no UDFs."""

from sousflow.functions.geo import (
    EARTH_RADIUS_M,
    METRES_PER_KM,
    METRES_PER_MILE,
    great_circle_m,
    great_circle_sql,
    haversine_sql,
    unit_vector_sql,
)
from sousflow.functions.json import json_field, parse_json_safe
from sousflow.functions.text import (
    clean_lower,
    clean_upper,
    concat_name,
    int_from_unit_text,
    prefix_before,
    round_to_int,
    strip_quotes,
)
from sousflow.functions.time import epoch_seconds, floor_div, seconds_between

__all__ = [
    "EARTH_RADIUS_M",
    "METRES_PER_KM",
    "METRES_PER_MILE",
    "great_circle_m",
    "great_circle_sql",
    "haversine_sql",
    "unit_vector_sql",
    "json_field",
    "parse_json_safe",
    "clean_lower",
    "clean_upper",
    "concat_name",
    "int_from_unit_text",
    "prefix_before",
    "round_to_int",
    "strip_quotes",
    "epoch_seconds",
    "floor_div",
    "seconds_between",
]
