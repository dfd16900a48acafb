"""Key profiling and de-duplication over cleaned keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_profile(df: DataFrame, distinct: Mapping[str, str | Column]) -> DataFrame:
    """One row: exact distinct count per named column or expression."""
    return df.agg(*[F.count_distinct(c if isinstance(c, Column) else F.col(c)).alias(name)
                    for name, c in distinct.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str], counted: str, count_col: str,
                   min_count: int = 2) -> DataFrame:
    """Keys that occur with at least ``min_count`` non-NULL ``counted`` values."""
    return (df.groupBy(*keys)
              .agg(F.count(counted).alias(count_col))
              .where(F.col(count_col) >= min_count))


def canonical_rows(df: DataFrame, id_col: str, group_keys: Sequence[str],
                   match_keys: Sequence[str]) -> DataFrame:
    """Rows holding the smallest ``id_col`` of their ``group_keys`` group.

    The minimum is a partial (map-side) aggregate, so a hot key never lands whole in
    one task; the rows are then found again by an equi-join on (id, match_keys).
    ``group_keys`` may hold more columns than ``match_keys`` (grouping by raw and
    cleaned spelling keeps one row per spelling).
    """
    firsts = df.groupBy(*group_keys).agg(F.min(id_col).alias(id_col))
    on = [id_col, *match_keys]
    return df.join(firsts.select(*on), on=on, how="inner")
