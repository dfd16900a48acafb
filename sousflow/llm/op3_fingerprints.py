"""Document fingerprints: MinHash with many universal hash permutations, in vectorised numpy.

A text's set holds its runs of five lower-cased words as 64-bit hashes (a shorter text is one
run). Permutation i maps a hash x to a_i * x + b_i modulo 2**64 with odd a_i; its upper 32 bits are
the permuted value, and the least of them over the set is entry i. The printed fingerprint
has the last 16 bits of each entry in hex. The share of equal entries of two fingerprints
estimates the Jaccard similarity of their sets.

``fingerprint_groups`` joins bands of the entries in Spark and verifies Jaccard on the full sets;
``fingerprints`` compares each document with an edited text and with the next document and, where
asked, gives each its group.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Staging, frugal, slices, staged, text_of
from .graph import linked, odd_sketch
from .op7_minhash_near_dedup import items
from .words import mixed, shingle_sets, words

PERMUTATIONS, SHINGLE_WORDS = 128, 5
#: Bands of the join: two sets of similarity 0.8 share no band with probability (1 - 0.8**4)**32, about 5 in 10**8.
BAND_ENTRIES, PERCENT = 4, 80

_RNG = np.random.default_rng(31)
_FACTORS = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)
_EMPTY = np.uint32(0xFFFFFFFF)
_CHUNK = 1 << 15


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``PERMUTATIONS`` 32-bit entries per set; an empty set has the largest value everywhere."""
    out = np.full((len(sets), PERMUTATIONS), _EMPTY, dtype=np.uint32)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    filled = np.flatnonzero(sizes)
    ends, i = np.cumsum(sizes[filled]), 0
    while i < len(filled):  # sets together, so that their values stay in the cache
        done = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + _CHUNK, side="right")))
        x = np.concatenate([sets[k] for k in filled[i:j]])
        at = np.concatenate([[0], ends[i : j - 1] - done])
        value = np.empty_like(x)
        for k in range(PERMUTATIONS):
            np.multiply(x, _FACTORS[k], out=value)
            np.add(value, _SHIFTS[k], out=value)
            out[filled[i:j], k] = np.minimum.reduceat(value, at) >> np.uint64(32)
        i = j
    return out


def printed(entries: np.ndarray) -> list[str]:
    """The fingerprints as hex strings."""
    return [row.tobytes().hex() for row in (entries & np.uint32(0xFFFF)).astype(">u2")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal entries, row by row."""
    return (a == b).mean(axis=1) if len(a) else np.zeros(0)


def _entries(texts: list[str]) -> np.ndarray:
    return minhash(shingle_sets(*words(pa.array(texts, pa.large_string())), SHINGLE_WORDS))


def edited(text: str, following: str) -> str:
    """The text with its last quarter (in code points, rounded down) replaced by as many first ones of the other, or all."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _compare(rows: list[tuple], following: list[str]) -> pa.RecordBatch:
    texts = [row[1] for row in rows]
    changed = [edited(text, other) for text, other in zip(texts, following, strict=True)]
    all_entries = _entries([*texts, following[-1]])
    own, other = all_entries[:-1], all_entries[1:]
    after = _entries(changed)
    return pa.RecordBatch.from_arrays([
        pa.array([row[0] for row in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()), pa.array(printed(own), pa.string()), pa.array(printed(after), pa.string()),
        pa.array(likeness(own, after), pa.float64()), pa.array(likeness(own, other), pa.float64()),
        pa.array([row[2] for row in rows], pa.int64()), pa.array([row[3] for row in rows], pa.int64())],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id", "group_id"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of ranges, each with the first row of the next range as its tail; every row meets its successor.

    A row without text carries the class and group of the id that follows it.
    """
    rows: list[tuple] = []  # successive rows of one range; the last waits for its successor
    size, here, closed = 0, None, True
    named: tuple = (None, None, None)
    for whole in batches:
        for batch in slices(whole, "packed"):
            for part, tail, doc, packed, cls, group in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "packed", "class_id", "group_id")), strict=True):
                if part != here:
                    here, rows, size, closed = part, [], 0, False
                if packed is None:
                    named = (doc, cls, group)
                    continue
                if closed:
                    continue  # a further row with the id of the tail
                text = zlib.decompress(packed).decode()
                rows.append((doc, text, *(named[1:] if doc is not None and doc == named[0] else (None, None))))
                size += len(text)
                if tail or size > SLICE_BYTES and len(rows) > 1:
                    if len(rows) > 1:
                        yield _compare(rows[:-1], [row[1] for row in rows[1:]])
                    rows, size, closed = rows[-1:], len(rows[-1][1]), bool(tail)


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts as they are shuffled: squeezed one by one, as they are sorted by themselves."""
    for whole in batches:
        for batch in slices(whole, "text"):
            packed = [zlib.compress(text.as_buffer(), 1) for text in batch.column("text")]
            yield batch.set_column(batch.schema.get_field_index("text"), "packed", pa.array(packed, pa.binary()))


def _ranged(bounds: np.ndarray):
    """The number of the range that an id falls into, and whether it is the first id of a range but the first."""
    @F.pandas_udf("part int, bound boolean")
    def run(ids: pd.Series) -> pd.DataFrame:
        values = ids.to_numpy()
        return pd.DataFrame({"part": np.searchsorted(bounds, values, side="right").astype("int32"), "bound": np.isin(values, bounds)})

    return run


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", groups: DataFrame | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row; class_id, group_id with ``groups``.

    ``groups`` is the result of :func:`fingerprint_groups`; where an id stands with different texts,
    its rows carry the smallest class and group of them. A null id has neither.

    The next document is the one after in the order of id, then of the text's hash; after the last
    comes the first. A null id comes before all others, a null text counts as empty; an empty
    text has a fingerprint of its own, likeness 1 to itself and 0 to others. A single row
    is its own next. An empty table gives an empty result.

    Rows are dealt by ranges of the id of about equal size, cut at ids of the table; the
    first row of each range goes to the range before it as well, so no row is looked up elsewhere.
    Classes and groups are dealt to the same ranges as rows of three numbers, so neither texts nor
    fingerprints are shuffled for them. Texts are squeezed before they are dealt. A very long text is handled alone. Other columns are not read.
    """
    spark = docs.sparkSession
    text = text_of(docs, text_column)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5], max(10_000, 20 * parts)).alias("cuts"),
                    F.min(F.struct("doc_id", "th")).alias("first")).first()
    first = cuts["first"]
    # a null id goes with the smallest numbers: a nullable column would reach pandas as rounded floats
    ident = F.coalesce("doc_id", F.lit(-(2**63)))
    # quantiles of large numbers are rounded; the cuts are the least ids of the ranges between them
    rough = np.unique(np.array([c for c in cuts["cuts"] or [] if c is not None], dtype=np.int64))
    starts = rows.groupBy(_ranged(rough)(ident)["part"].alias("part")).agg(F.min("doc_id").alias("start")).collect()
    bounds = np.array(sorted(r.start for r in starts if r.start is not None)[1:], dtype=np.int64)
    dealt = rows.withColumn("at", _ranged(bounds)(ident))
    own = F.struct(F.col("at.part").alias("part"), F.lit(False).alias("tail"))
    before = F.when(F.col("at.bound") & F.col("doc_id").isNotNull(), F.struct((F.col("at.part") - 1).alias("part"), F.lit(True).alias("tail")))
    to_last = F.when(F.col("doc_id").eqNullSafe(F.lit(first["doc_id"] if first else None).cast("long")) & (F.col("th") == F.lit(first["th"] if first else 0)),
                     F.struct(F.lit(len(bounds)).alias("part"), F.lit(True).alias("tail")))
    copies = dealt.select("doc_id", "text", "th", F.explode(F.filter(F.array(own, before, to_last), lambda x: x.isNotNull())).alias("to"))
    copies = copies.select("doc_id", "text", "th", "to.part", "to.tail")
    dealt = copies.mapInArrow(frugal(_squeezed), "doc_id bigint, packed binary, th bigint, part int, tail boolean")
    dealt = dealt.select("doc_id", "packed", "th", "part", "tail", F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("group_id"))
    if groups is not None:
        named = groups.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.min("group_id").alias("group_id"))
        dealt = dealt.unionByName(named.select("doc_id", F.lit(None).cast("binary").alias("packed"), F.lit(None).cast("long").alias("th"),
                                               _ranged(bounds)(F.col("doc_id"))["part"].alias("part"), F.lit(False).alias("tail"), "class_id", "group_id"))
    sorted_rows = (dealt.repartition(parts, "part").sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_first(), F.col("th").asc_nulls_first())
                   .select("part", "tail", "doc_id", "packed", "class_id", "group_id"))
    out = sorted_rows.mapInArrow(frugal(_walk), "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, class_id bigint, group_id bigint")
    return out if groups is not None else out.drop("class_id", "group_id")


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = shingle_sets(*words(batch.column("text")), SHINGLE_WORDS)
            parts = minhash(sets).reshape(len(sets), -1, BAND_ENTRIES).astype(np.uint64)
            total = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2]).copy()
            for k in range(BAND_ENTRIES):
                total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                pa.array([b if len(s) else None for s, b in zip(sets, total.view(np.int64), strict=True)], pa.list_(pa.int64())),
                pa.array([len(s) for s in sets], pa.int64()), pa.array([odd_sketch(s) for s in sets], pa.list_(pa.int64()))], ["doc_id", "set_key", "bands", "n", "sketch"])


def fingerprint_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, class_id, group_id of every row with an id: the smallest id with an equal set, and the smallest reachable over links.

    Links join classes of equal sets that share a band and whose full sets have a Jaccard
    similarity of ``percent`` / 100 and more. A null or wordless text is its own class and group.
    """
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), text_of(docs, text_column).alias("text")).where("doc_id IS NOT NULL")
    with Staging(docs.sparkSession) as own:
        rows = staged(source.mapInArrow(frugal(_bands), "doc_id bigint, set_key string, bands array<bigint>, n bigint, sketch array<bigint>"), "print-rows")
        classes = staged(rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("cls"), F.min(F.struct("bands", "n", "sketch")).alias("x")).select("set_key", "cls", "x.*"), "print-classes")
        members = staged(classes.select("cls", F.explode("bands").alias("bucket")), "print-members")

        _, groups = linked(members, classes.select("cls", "n", "sketch"), lambda wanted: items(source, wanted, SHINGLE_WORDS), percent)
        named = staged(classes.select("set_key", "cls").join(groups, "cls", "left").select("set_key", F.col("cls").alias("class_id"), F.coalesce("component", "cls").alias("group_id")), "print-named")
        # bands and sketches go once every row has its group
        return own.keep(staged(rows.select("doc_id", "set_key").join(named, "set_key", "left").select(
            "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("group_id", "doc_id").alias("group_id")), "print-groups"))
