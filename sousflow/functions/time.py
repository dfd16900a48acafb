"""Timezone-free time arithmetic on TIMESTAMP_NTZ columns.

``unix_*`` and ``timestampdiff`` cast NTZ values through the session timezone, so a
2-hour span across a daylight-saving jump would come out as 1 or 3 hours. These
helpers subtract the NTZ epoch instead, which never consults a timezone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sousflow.functions._cols import col

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
MICROS_PER_SECOND = 1_000_000


def _micros_sql(ts: str) -> str:
    return f"(`{ts}` - {_EPOCH_NTZ}) div interval '0.000001' second"


def floor_div(c: str | Column, n: int) -> Column:
    """Integer division rounding toward minus infinity (SQL ``div`` truncates).

    ``c - pmod(c, n)`` is an exact multiple of ``n``, so the quotient is exact for
    any long below 2^53 (timestamps in microseconds stay far below it).
    """
    c = col(c)
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def epoch_seconds(ts: str) -> Column:
    """Whole seconds since the epoch (floor), timezone-free."""
    m = _micros_sql(ts)
    return F.expr(f"(({m}) - pmod({m}, {MICROS_PER_SECOND})) div {MICROS_PER_SECOND}")


def seconds_between(start_seconds: str | Column, end_seconds: str | Column) -> Column:
    """Second boundaries crossed between two epoch-second values (end - start)."""
    return col(end_seconds) - col(start_seconds)
