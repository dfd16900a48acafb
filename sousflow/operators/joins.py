"""Equi-joins that stay spread out when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a single task may hold; a key with more is dealt into shares.
SHARE_ROWS = 1_000_000
#: Keys that are dealt at most: a key has to hold more than this part of all rows.
MAX_HEAVY_KEYS = 10_000


def heavy_keys(df: DataFrame, keys: Sequence[str], share_rows: int = SHARE_ROWS, max_keys: int = MAX_HEAVY_KEYS) -> DataFrame:
    """The keys with more than ``share_rows`` rows, and the shares (``_shares``) that their rows make.

    Counted by a partial aggregate, so a hot key sends one row a task. A key also has to hold more
    than the ``max_keys``-th part of all rows, whatever the table's size, so at most ``max_keys`` rows come back.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # the whole table's size is a scalar subquery of the plan, nothing is collected
    rows = df.agg(F.count(F.lit(1)).alias("_rows")).scalar()
    least = F.greatest(F.lit(share_rows).cast("long"), F.floor(rows / F.lit(max_keys)).cast("long"))
    return counts.where(F.col("_n") > least).select(*keys, F.ceil(F.col("_n") / F.lit(share_rows)).cast("int").alias("_shares"))


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", *,
                share_rows: int = SHARE_ROWS, max_keys: int = MAX_HEAVY_KEYS, null_safe: bool = False) -> DataFrame:
    """``left.join(right, keys, how)`` for a ``left`` side with hot keys and a ``right`` side with few rows a key.

    The rows of a heavy key are dealt into shares by a hash of the whole row and the right side's rows of these
    keys are repeated once a share, so no task holds more than about ``share_rows`` rows of a key, whatever
    adaptive execution does. The hash follows from the values alone, so a task that runs again deals alike; rows equal
    in all columns go together (count them first where they may be many). Only the heavy keys, at most
    ``max_keys`` rows, are broadcast; light keys join as ever. With ``null_safe`` a NULL key matches a NULL
    key, else it matches nothing (kept by a left join, and dealt like a heavy key). ``how`` is inner, left,
    left_semi or left_anti; the columns are those of ``join(on=keys)``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"only the left side's rows can be dealt, so not {how!r}")
    names = [f"_heavy_{k}" for k in keys]
    heavy = heavy_keys(left, keys, share_rows, max_keys).withColumnsRenamed(dict(zip(keys, names, strict=True)))
    same = lambda df: reduce(Column.__and__, [df[k].eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    few = F.broadcast(heavy)  # at most max_keys rows
    values = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    place = F.pmod(F.xxhash64(F.lit(17), *values), F.col("_shares")).cast("int")
    dealt = left.join(few, same(left), "left").withColumn("_share", F.when(F.col("_shares").isNull(), F.lit(0)).otherwise(place)).drop("_shares", *names)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1))
    spread = right.join(few, same(right), "left").withColumn("_share", copies).drop("_shares", *names)

    other = spread.withColumnsRenamed({c: f"_right_{c}" for c in [*keys, "_share"]})
    on = [dealt["_share"] == other["_right__share"]]
    on += [dealt[k].eqNullSafe(other[f"_right_{k}"]) if null_safe else dealt[k] == other[f"_right_{k}"] for k in keys]
    joined = dealt.join(other, reduce(Column.__and__, on), how)
    rest = [c for c in left.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        return joined.select(*left.columns)
    return joined.select(*keys, *rest, *[c for c in right.columns if c not in keys])
