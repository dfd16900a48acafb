"""Fill-in-the-middle: texts cut into units and put together in another order, by pyarrow.compute.

A text's units are its lines, each with its line break. Two numbers from a hash of the document's id
cut them into prefix, middle and suffix; a third decides whether the text stays plain, a fourth
in which order the parts stand, each behind its marker:

    psm  <P>prefix<S>suffix<M>middle         spm  <S>suffix<P>prefix<M>middle

A batch is handled as a whole: the texts are split into list arrays of units, flattened with the
index of each unit's text, numbered within their text, filtered by role, made lists again and
joined. No Python string is made and no loop runs over documents. Every document is a row of its
own, so nothing is shuffled and a task holds one slice of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_of

# What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"

_LONG = pa.int64()
_TEXT = pa.large_string()


def hash_numbers(column: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:id`` as integers; a null id is written as no characters."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _check(markers: tuple[str, str, str], separator: str) -> None:
    """A marker can only be found where it was put if its first character stands nowhere else in the markers."""
    whole = "".join(markers)
    if len(markers) != 3 or not all(markers) or len(set(markers)) != 3 or any(whole.count(m[0]) != sum(m[0] == x[0] for x in markers) for m in markers):
        raise ValueError(f"three different markers, whose first characters stand nowhere else in them, not {markers!r}")
    if not separator:
        raise ValueError("units end with a separator of at least one character")


def _texts(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(_TEXT), "")


def units_of(text: pa.Array, separator: str) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """All units in order, the index of each one's text, its number within the text, and the units of each text.

    A unit ends with its separator; characters after the last separator are a unit of their own.
    """
    lists = pc.split_pattern(text, pattern=separator)
    pieces, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(_LONG)
    counts = pc.list_value_length(lists).cast(_LONG)
    starts = pc.subtract(pc.cumulative_sum(counts), counts)
    ordinal = pc.subtract(pa.array(range(len(pieces)), _LONG), pc.take(starts, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(counts, parent), 1))
    # what follows the last separator is no unit if it is empty
    nothing = pc.and_(last, pc.equal(pc.binary_length(pieces), 0))
    ended = pc.if_else(last, pa.scalar("", _TEXT), pa.scalar(separator, _TEXT))
    units = pc.binary_join_element_wise(pieces, ended, pa.scalar("", _TEXT))
    there = pc.invert(nothing)
    number = pc.subtract(counts, pc.if_else(pc.take(nothing, pc.subtract(pc.add(starts, counts), 1)), 1, 0))
    return units.filter(there), parent.filter(there), ordinal.filter(there), number


def _joined(units: pa.Array, parent: pa.Array, rows: int) -> pa.Array:
    """One string for each of the rows: its units, joined; the parents ascend."""
    found = pc.value_counts(parent)
    held = pc.index_in(pa.array(range(rows), _LONG), value_set=found.field("values"))
    sizes = pc.fill_null(pc.take(found.field("counts"), held), 0).cast(_LONG)
    offsets = pa.concat_arrays([pa.array([0], _LONG), pc.cumulative_sum(sizes)])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, units), pa.scalar("", _TEXT))


def _rest(x: pa.Array, n: pa.Array) -> pa.Array:
    """x modulo n, both positive."""
    return pc.subtract(x, pc.multiply(pc.divide(x, n), n))


def cut_texts(text: pa.Array, h: list[pa.Array], percent: int, spm_percent: int, markers: tuple[str, str, str], separator: str) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of every text."""
    units, parent, ordinal, n = units_of(text, separator)
    places = pc.add(n, 1)
    a, b = _rest(h[0], places), _rest(h[1], places)
    first, second = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    past_first = pc.greater_equal(ordinal, pc.take(first, parent))
    past_second = pc.greater_equal(ordinal, pc.take(second, parent))
    roles = (pc.invert(past_first), pc.and_(past_first, pc.invert(past_second)), past_second)
    prefix, middle, suffix = (_joined(units.filter(role), parent.filter(role), len(text)) for role in roles)

    plain = pc.or_(pc.equal(pc.binary_length(text), 0), pc.greater_equal(_rest(h[2], pa.scalar(100, _LONG)), percent))
    for marker in markers:
        plain = pc.or_(plain, pc.match_substring(text, marker))
    spm = pc.less(_rest(h[3], pa.scalar(100, _LONG)), spm_percent)
    p, s, m, nothing = (pa.scalar(x, _TEXT) for x in (*markers, ""))
    out = pc.if_else(spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing),
                     pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing))
    form = pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM))
    no = pa.scalar(None, _LONG)
    lengths = [pc.if_else(plain, no, pc.utf8_length(x).cast(_LONG)) for x in (prefix, middle)]
    return [n, form, *lengths, pc.if_else(plain, text, out)]


def _around(text: pa.Array, marker: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the one ``marker`` in each text."""
    parts = pc.split_pattern(text, pattern=marker, max_splits=1)
    return pc.list_element(parts, 0), pc.list_element(parts, 1)


def rebuilt(output: pa.Array, form: pa.Array, markers: tuple[str, str, str]) -> pa.Array:
    """The texts from which ``output`` was made."""
    p, s, m = markers
    rows = []
    for kind, (front, back) in ((PSM, (p, s)), (SPM, (s, p))):
        at = pc.indices_nonzero(pc.equal(form, kind))
        head, middle = _around(pc.take(output, at), m)
        one, two = _around(head, back)
        one = pc.utf8_slice_codeunits(one, start=len(front))
        prefix, suffix = (one, two) if kind == PSM else (two, one)
        rows.append((at, pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar("", _TEXT))))
    at = pc.indices_nonzero(pc.equal(form, PLAIN))
    rows.append((at, pc.take(output, at)))
    order = pa.concat_arrays([x for x, _ in rows])
    return pc.take(pa.concat_arrays([x for _, x in rows]), pc.sort_indices(order))


def fill_in_middle(docs: DataFrame, *, seed: int = 7, percent: int = 100, spm_percent: int = 50, markers: tuple[str, str, str] = MARKERS,
                   separator: str = "\n", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every text in fill-in-the-middle form: id, n, form, prefix_chars, middle_chars, output.

    n is the number of units. ``percent`` of the texts are cut, ``spm_percent`` of those have the suffix first.
    A null text counts as empty; empty texts and texts that hold a marker stay plain, with null lengths. A null id
    hashes like an empty one. Rows that repeat an id are cut by the same numbers, each by its own count of units.
    A text of any length is cut whole, alone in its slice if it is long. Other columns of ``docs`` take no
    part, whatever their names; an empty table gives an empty one.
    """
    _check(markers, separator)
    source = docs.select(F.col(id_column).alias(id_column), text_of(docs, text_column).alias("_text"),
                         *[h.alias(f"_h{i}") for i, h in enumerate(hash_numbers(F.col(id_column), seed))])
    schema = T.StructType([docs.schema[id_column], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                h = [part.column(f"_h{i}") for i in range(4)]
                n, form, before, within, out = cut_texts(_texts(part.column("_text")), h, percent, spm_percent, markers, separator)
                yield pa.RecordBatch.from_arrays([part.column(id_column), n, form.cast(pa.string()), before, within, out], names=schema.names)

    return source.mapInArrow(run, schema)


def restore(cut: DataFrame, *, markers: tuple[str, str, str] = MARKERS, output_column: str = "output", form_column: str = "form") -> DataFrame:
    """The rows of :func:`fill_in_middle` with ``restored``, the exact text, from output and form alone.

    A column ``restored`` that is already there is replaced. A null output counts as an empty plain text.
    """
    _check(markers, "\n")
    names = [c for c in cut.columns if c != "restored"]
    source = cut.select(*names)
    schema = T.StructType([*source.schema.fields, T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, output_column):
                text = rebuilt(_texts(part.column(output_column)), pc.fill_null(part.column(form_column), PLAIN), markers)
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=schema.names)

    return source.mapInArrow(run, schema)
