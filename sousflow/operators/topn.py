"""Top-n per group with ties, and rank -> column pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_with_ties(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[Column],
                    n: int = 1, rank_col: str | None = None) -> DataFrame:
    """Rows whose RANK() within the partition is <= n (ties share a rank).

    Spark plans ``rank() <= n`` with a partial WindowGroupLimit before the shuffle,
    so only candidate winners are exchanged. Order expressions should state their
    NULL placement (``asc_nulls_last``) explicitly.
    """
    name = rank_col or "_rank"
    ranked = df.withColumn(name, F.rank().over(Window.partitionBy(*partition_by).orderBy(*order_by)))
    kept = ranked.where(F.col(name) <= n)
    return kept if rank_col else kept.drop(name)


def pivot_ranks(df: DataFrame, group_cols: Sequence[str], rank_col: str, value_col: str,
                out_cols: Sequence[str], ranks: Sequence[int] | None = None) -> DataFrame:
    """One row per group; column i holds MIN(value) of the rows ranked ranks[i].

    Written as conditional minima rather than ``pivot`` so the output columns are
    fixed without a distinct-values pass, and a rank with no row gives NULL.
    """
    ranks = list(ranks) if ranks is not None else list(range(1, len(out_cols) + 1))
    return df.groupBy(*group_cols).agg(*[
        F.min(F.when(F.col(rank_col) == r, F.col(value_col))).alias(name)
        for r, name in zip(ranks, out_cols)
    ])


def closest_per_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows at the smallest ``value`` of their group, ties kept; all rows of a group that has only NULL values.

    The same rows as RANK() = 1 ordered by ``value`` with NULLs last. The minimum is a
    partial aggregate joined back, so no group is sorted or held in one task, whatever its ties.
    """
    best = df.groupBy(*keys).agg(F.expr(f"min(`{value}`) AS _best"))
    lows = best.selectExpr(*[f"`{k}` AS `_key_{k}`" for k in keys], "_best")
    same = [f"`{k}` <=> `_key_{k}`" for k in keys] + [f"`{value}` <=> _best"]
    return df.join(lows, F.expr(" AND ".join(same)), "left_semi")
