"""Ordered string aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_string_agg(c: str, sep: str = ", ", empty: str | None = "") -> Column:
    """Values joined in ascending order (NULLs skipped); ``empty`` when none.

    Use on groups whose size is bounded by the output itself (tied winners), not on
    raw fact rows.
    """
    joined = F.expr(f"listagg(`{c}`, {sep!r}) WITHIN GROUP (ORDER BY `{c}`)")
    return joined if empty is None else F.coalesce(joined, F.lit(empty))
