"""Fill-in-the-middle against a plain version, text by text, and the exact round trip."""

import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sousflow.llm.op12_fill_in_middle import MARKERS, cut_texts, fill_in_middle, rebuilt, restore


def numbers(doc_id, seed=7):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]


def plainly(doc_id, text, percent=100, spm=50):
    text = text or ""
    h = numbers(doc_id)
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in MARKERS) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", None, "\n", "a", "a\n", "a\nb", "\n\n\n", "one\ntwo\n\nthree", "with <P> in it\nx", "<S>", "x<M", "half <\nP>", "ü\n漢字\n🙂 end",
         "\r\n\r\n", "a\x00b\nc", "<\n<\n", "line\n" * 50, "y" * 300_000 + "\n" + "z\n" * 200_000]


def test_equals_plain_version_and_restores(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "a\nb\nc"), (None, None), (5, "another\ntext"), (5, "another\ntext")]
    cut = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in restore(cut).collect()), key=repr)
    assert got == sorted(((i, *plainly(i, t), t or "") for i, t in rows), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab\n<>PSM é", max_size=12), min_size=1, max_size=6), st.integers(0, 1000))
def test_batches_of_any_texts(texts, first):
    h = [pa.array([numbers(first + i)[j] for i in range(len(texts))], pa.int64()) for j in range(4)]
    column = pa.array(texts, pa.large_string())
    n, form, p, m, out = cut_texts(column, h, 80, 50, MARKERS, "\n")
    assert list(zip(*[x.to_pylist() for x in (n, form, p, m, out)], strict=True)) == [plainly(first + i, t, percent=80) for i, t in enumerate(texts)]
    assert rebuilt(out, form, MARKERS).to_pylist() == texts


def test_other_markers_units_and_shares(spark):
    rows = [(i, "a. b. c. d. e") for i in range(400)]
    markers = ("[pre]", "{suf}", "(mid)")
    cut = fill_in_middle(spark.createDataFrame(rows, "k long, body string"), id_column="k", text_column="body", seed=1, percent=50, spm_percent=0, markers=markers, separator=". ")
    got = restore(cut, markers=markers).collect()
    assert {r.restored for r in got} == {"a. b. c. d. e"} and {r.n for r in got} == {5}
    assert 140 < sum(r.form == "psm" for r in got) < 260 and not any(r.form == "spm" for r in got)
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "b", "c")):
        with pytest.raises(ValueError):
            fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), markers=bad)


def test_empty_table_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert restore(fill_in_middle(empty)).count() == 0
    clash = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string").withColumns({c: F.lit(0) for c in ("n", "form", "output", "_text", "_h0", "restored")})
    assert [r.restored for r in restore(fill_in_middle(clash)).collect()] == ["a\nb"]
    again = restore(restore(fill_in_middle(clash)))
    assert again.columns.count("restored") == 1
