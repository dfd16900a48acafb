"""Text cleaning for dirty join keys and number-in-text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sousflow.functions._cols import col


def clean_lower(c: str | Column) -> Column:
    """Lower-case and strip blanks (spaces only, as SQL TRIM does): city names, tags."""
    return F.trim(F.lower(col(c)))


def clean_upper(c: str | Column) -> Column:
    """Upper-case and strip blanks: state codes, ingredient keys."""
    return F.trim(F.upper(col(c)))


def strip_quotes(c: str | Column) -> Column:
    """Remove every double quote (ids that arrive as JSON-quoted text)."""
    return F.replace(col(c), F.lit('"'), F.lit(""))


def prefix_before(c: str | Column, sep: str = ",") -> Column:
    """Text before the first ``sep``; '' when ``sep`` is absent.

    Kept as substring-up-to-the-separator then drop it, so a value with no
    separator becomes the empty string (not the whole value, as split()[0] would).
    """
    c = col(c)
    upto = F.substr(c, F.lit(1), F.locate(sep, c))
    return F.replace(upto, F.lit(sep), F.lit(""))


def int_from_unit_text(c: str | Column, unit: str = "g") -> Column:
    """'12g' -> 12. Decimals round half away from zero; malformed text -> NULL."""
    number = F.replace(col(c), F.lit(unit), F.lit("")).try_cast("decimal(38,6)")
    return F.round(number).cast("int")


def round_to_int(c: str | Column) -> Column:
    """Float to int, rounding half away from zero (a plain cast would truncate)."""
    return F.round(col(c)).cast("int")


def concat_name(first: str | Column, last: str | Column, sep: str = " ") -> Column:
    """first || sep || last; NULL when either part is NULL, like SQL concatenation."""
    return F.concat(col(first), F.lit(sep), col(last))
