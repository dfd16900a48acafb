"""Per-group values attached to every row, without buffering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_values(df: DataFrame, keys: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """Like ``agg(...) OVER (PARTITION BY keys)`` with a whole-partition frame.

    A window would sort and buffer each partition in one task; a group holding a
    third of the rows would then sit in one task. Here the values are a partial
    (map-side) aggregate joined back on the keys: the aggregated side has one row
    per group, and adaptive execution splits a hot key on the large side. As in a
    window, rows with a NULL key form a group of their own.
    """
    grouped = [f"_group_{k}" for k in keys]
    per_group = df.groupBy(*keys).agg(*values).withColumnsRenamed(dict(zip(keys, grouped, strict=True)))
    same = reduce(Column.__and__, [df[k].eqNullSafe(F.col(g)) for k, g in zip(keys, grouped, strict=True)])
    return df.join(per_group, same, "inner").drop(*grouped)
