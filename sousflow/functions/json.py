"""JSON text -> VARIANT once, then typed path access.

Malformed text gives NULL fields instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sousflow.functions._cols import col


def parse_json_safe(c: str | Column) -> Column:
    return F.try_parse_json(col(c))


def json_field(variant: str | Column, path: str, type_: str = "string") -> Column:
    """Typed value at ``path`` ('$.event'); NULL when absent or not castable."""
    if not path.startswith("$"):
        path = "$." + path
    return F.try_variant_get(col(variant), path, type_)
