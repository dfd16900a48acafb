"""Arrays to rows, and an element -> id index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, array_col: str, value_col: str = "value", index_col: str | None = None,
            keep: list[str] | None = None) -> DataFrame:
    """One row per element; rows with an empty or NULL array vanish (inner flatten).

    ``index_col`` adds the 0-based element position.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != array_col]
    if index_col:
        return df.select(*keep, F.posexplode(array_col).alias(index_col, value_col))
    return df.select(*keep, F.explode(array_col).alias(value_col))


def inverted_index(df: DataFrame, array_col: str, id_col: str, key_col: str,
                   clean: Callable[[Column], Column], pick: str = "max") -> DataFrame:
    """Cleaned element -> one id among the rows holding it (largest by default)."""
    agg = {"max": F.max, "min": F.min}[pick]
    flat = df.select(id_col, F.explode(array_col).alias("_element"))
    return (flat.select(id_col, clean(F.col("_element")).alias(key_col))
                .groupBy(key_col).agg(agg(id_col).alias(id_col)))
