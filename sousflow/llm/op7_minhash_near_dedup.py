"""Near-duplicate removal: one-permutation MinHash, optimal densification, banded buckets, star-shaped edges.

A document's set holds its distinct word shingles as 64-bit hashes. One permutation deals
the set into equal bins and keeps each bin's smallest hash; an empty bin takes the value of
the first filled bin in its own fixed random sequence (optimal densification), so bins stay
independent. ``BANDS`` runs of ``BAND_BINS`` bins make the buckets. At a Jaccard similarity of
0.8 two sets share no bucket with probability (1 - 0.8**5)**35, below 1 in a million.

Documents with equal sets form one class before anything is compared, so copies never
multiply pairs. Classes that share a bucket are compared hub against members and confirmed on
their full sets (:func:`sousflow.llm.graph.linked`), with no cap on buckets or members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, slices, staged, text_of
from .graph import linked, odd_sketch, wanted_texts
from .words import mixed, shingle_sets, words

BANDS, BAND_BINS = 35, 5
BINS = BANDS * BAND_BINS
SHINGLE_WORDS, PERCENT = 5, 80

_draws: list[np.ndarray] = []


def _draw(attempt: int) -> np.ndarray:
    """The bin that each empty bin looks at in its given attempt; the same for every document."""
    while len(_draws) <= attempt:
        _draws.append(np.random.default_rng([7, len(_draws)]).integers(0, BINS, BINS))
    return _draws[attempt]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BINS`` values per non-empty sorted set."""
    sig = np.zeros((len(sets), BINS), dtype=np.uint64)
    filled = np.zeros((len(sets), BINS), dtype=bool)
    for i, items in enumerate(sets):
        bins = ((items >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)  # ascending, as the hashes are
        first = np.flatnonzero(np.diff(bins, prepend=np.uint64(BINS)))
        sig[i, bins[first]] = items[first]
        filled[i, bins[first]] = True
    row, hole = np.nonzero(~filled)
    attempt = 0
    while len(row):
        source = _draw(attempt)[hole]
        hit = filled[row, source]
        sig[row[hit], hole[hit]] = sig[row[hit], source[hit]]
        row, hole, attempt = row[~hit], hole[~hit], attempt + 1
    return sig


def buckets(sig: np.ndarray) -> np.ndarray:
    """A 64-bit bucket per band, different bands never meeting."""
    parts = sig.reshape(len(sig), BANDS, BAND_BINS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(BAND_BINS):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return total


def _smallest_linked(percent: int) -> int:
    """The least set size that can reach the threshold with a set other than its equal."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def _profile(size: int, percent: int):
    least = _smallest_linked(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(*words(batch.column("text")), size)
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
                large = [i for i, s in enumerate(sets) if len(s) >= least]
                bands: list = [None] * len(sets)
                sketches = [odd_sketch(s) if len(s) >= least else None for s in sets]
                for i, b in zip(large, buckets(signatures([sets[i] for i in large])).view(np.int64), strict=True):
                    bands[i] = b
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.string()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_key", "bands", "sketch"])
    return run


def items(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, items): the sets of the wanted documents (cls) and by chance of a few others, from (doc_id, text)."""
    passing = wanted_texts(docs, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole.filter(pa.array(passing(whole.column("h").to_numpy().view(np.uint64)))), "text"):
                sets = shingle_sets(*words(batch.column("text")), size)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "items"])

    # rows that repeat an id repeat its set
    return docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(frugal(run), "cls bigint, items binary")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased, words are runs of bytes other than space and 0x09-0x0D. Two documents
    are linked when 100 * intersection >= percent * union of their shingle sets; component_id
    is the smallest id reachable over links, kept marks the row that has this id. A null or
    wordless text has an empty set, is linked with nothing and is kept. A row without an id
    can't be named: it is left out of all comparisons, its component_id is null and it is
    kept. Rows that repeat an id should be equal; each is returned. An empty table gives an empty result.
    """
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), text_of(docs, text_column).alias("text"))
    rows = staged(source.mapInArrow(frugal(_profile(shingle_words, percent)), "doc_id bigint, n_shingles bigint, set_key string, bands array<bigint>, sketch array<bigint>"), "near-rows")
    named = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = staged(named.groupBy("set_key").agg(F.min("doc_id").alias("cls"), F.min(F.struct("n_shingles", "bands", "sketch")).alias("x")).select("set_key", "cls", "x.*"), "near-classes")
    members = staged(classes.select("cls", F.explode("bands").alias("bucket")), "near-members")

    _, groups = linked(members, classes.select("cls", F.col("n_shingles").alias("n"), "sketch"), lambda wanted: items(source, wanted, shingle_words), percent)
    named_class = staged(classes.select("set_key", "cls").join(groups, "cls", "left").select(
        "set_key", F.coalesce("component", "cls").alias("component")), "near-named")
    return rows.select("doc_id", "n_shingles", "set_key").join(named_class, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"))
