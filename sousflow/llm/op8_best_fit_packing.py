"""Best-fit packing of documents into training sequences under conflicts.

A bin holds ``capacity`` words. No bin holds two pieces of one source or of one duplicate
cluster: each bin carries a bitmap of its sources and one of its clusters. Longer documents
give full pieces, each a bin of its own, and a remainder. Remainders are placed longest
first; the open bins are kept in order of their residual, and the search starts at the
tightest bin that is large enough and goes on to the successor until one is compatible.

Documents are dealt by hash of their id into shards of about ``SHARD_DOCS`` and packed there;
no bin spans shards, so a hot source is spread over all of them and no task grows with the input.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, slices, staged, text_of
from .words import mixed, words

CAPACITY = 2048
#: Documents that one task packs together, on average.
SHARD_DOCS = 2048
_BLOCK = 128


class Bins:
    """Open bins in order of residual, with exact bitmaps of sources and clusters."""

    def __init__(self, sources: int, clusters: int):
        self.residuals: list[int] = []
        self.order = np.zeros(0, dtype=np.int64)
        self.source_bits = np.zeros((0, max(1, -(-sources // 64))), dtype=np.uint64)
        self.cluster_bits = np.zeros((0, max(1, -(-clusters // 64))), dtype=np.uint64)
        self.count = 0

    def _has(self, bits: np.ndarray, bins: np.ndarray, number: int) -> np.ndarray:
        return (bits[bins, number >> 6] >> np.uint64(number & 63)) & np.uint64(1) == 1

    def find(self, size: int, source: int, cluster: int) -> int:
        """Place in the order of the tightest compatible bin, -1 if there is none; -1 as source or cluster conflicts with nothing."""
        at, step = bisect_left(self.residuals, size), _BLOCK
        while at < self.count:
            bins = self.order[at : min(at + step, self.count)]
            bad = np.zeros(len(bins), dtype=bool)
            if source >= 0:
                bad |= self._has(self.source_bits, bins, source)
            if cluster >= 0:
                bad |= self._has(self.cluster_bits, bins, cluster)
            good = np.flatnonzero(~bad)
            if len(good):
                return at + int(good[0])
            at, step = at + len(bins), step * 2
        return -1

    def place(self, size: int, source: int, cluster: int, capacity: int) -> tuple[int, int]:
        """Put a piece into its bin: the bin's number and the piece's offset in it."""
        at = self.find(size, source, cluster)
        if at < 0:
            bin_, residual = self.count, capacity
            if self.count == len(self.source_bits):
                more = max(64, self.count)
                self.source_bits = np.vstack([self.source_bits, np.zeros((more, self.source_bits.shape[1]), np.uint64)])
                self.cluster_bits = np.vstack([self.cluster_bits, np.zeros((more, self.cluster_bits.shape[1]), np.uint64)])
            self.count += 1
        else:
            bin_, residual = int(self.order[at]), self.residuals.pop(at)
            self.order = np.delete(self.order, at)
        if source >= 0:
            self.source_bits[bin_, source >> 6] |= np.uint64(1) << np.uint64(source & 63)
        if cluster >= 0:
            self.cluster_bits[bin_, cluster >> 6] |= np.uint64(1) << np.uint64(cluster & 63)
        at = bisect_left(self.residuals, residual - size)
        self.residuals.insert(at, residual - size)
        self.order = np.insert(self.order, at, bin_)
        return bin_, capacity - residual


def pack_shard(docs: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one shard's documents (doc_id, n_words, source, cluster) with bin and offset."""
    docs = docs.sort_values(["n_words", "doc_id", "cluster"], kind="stable", na_position="last").reset_index(drop=True)
    source, names = pd.factorize(docs["source"])
    cluster, _ = pd.factorize(docs["cluster"])
    shared = np.bincount(cluster[cluster >= 0], minlength=1)[cluster] > 1 if len(cluster) else np.zeros(0, bool)
    cluster = np.where(shared & (cluster >= 0), cluster, -1)  # a cluster alone in its shard needs no bit
    n = docs["n_words"].to_numpy()
    full, rest = n // capacity, n % capacity
    bins = Bins(len(names), int(cluster.max(initial=-1)) + 1)
    rows: list[tuple[int, int, int, int, int, int]] = []
    for i in np.lexsort((np.arange(len(n)), -rest)).tolist():
        if rest[i]:
            bin_, offset = bins.place(int(rest[i]), int(source[i]), int(cluster[i]), capacity)
            rows.append((i, int(full[i]), int(full[i]) * capacity, int(rest[i]), bin_, offset))
    next_bin = bins.count
    for i in np.flatnonzero(full).tolist():
        for piece in range(int(full[i])):
            rows.append((i, piece, piece * capacity, capacity, next_bin, 0))
            next_bin += 1
    rows += [(i, 0, 0, 0, -1, 0) for i in np.flatnonzero(n == 0).tolist()]
    out = pd.DataFrame(rows, columns=["i", "piece", "start", "n_words", "bin", "offset"])
    return pd.DataFrame({
        "doc_id": docs["doc_id"].to_numpy()[out["i"]], "piece": out["piece"], "start": out["start"], "n_words": out["n_words"],
        "bin": out["bin"], "bin_offset": out["offset"]})


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            hashes, at = words(batch.column("text"))
            n = np.diff(at)
            place = (np.arange(len(hashes)) - np.repeat(at[:-1], n)).astype(np.uint64)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes + place * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)])
            cluster = (sums[at[1:]] - sums[at[:-1]]).view(np.int64)  # of the word sequence: copies that differ in case or spaces share it
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n.astype(np.int64)), pa.array(cluster), ], ["doc_id", "source", "n_words", "cluster"])


def pack(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", cluster_column: str | None = None,
         capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_words, bin_id, bin_offset.

    Words are runs of bytes other than space and 0x09-0x0D. A document's pieces cover it
    whole, in order. Without ``cluster_column`` documents with the same lower-cased words are a
    cluster. A null source or cluster conflicts with nothing. A null or wordless text gives one
    row with n_words 0 and a null bin. Ids are passed through, null or repeated; rows that
    repeat id and text are copies of one cluster. An empty table gives an empty result.
    """
    source = docs[source_column].cast("string") if source_column in docs.columns else F.lit(None).cast("string")
    texts = docs.select(docs[id_column].cast("long").alias("doc_id"), source.alias("source"), text_of(docs, text_column).alias("text"),
                        *([docs[cluster_column].cast("long").alias("given")] if cluster_column else []))
    if cluster_column:
        # the given cluster, a long, takes the place of the word sequence
        sizes = texts.withColumn("n_words", F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")).select("doc_id", "source", "n_words", F.col("given").alias("cluster"))
    else:
        sizes = texts.mapInArrow(frugal(_measure), "doc_id bigint, source string, n_words bigint, cluster bigint")
    sizes = staged(sizes, "pack-sizes")
    shards = max(1, -(-sizes.count() // shard_docs))
    dealt = sizes.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = pack_shard(part, capacity)
        return out.assign(shard=key[0])

    packed = dealt.groupBy("shard").applyInPandas(run, "doc_id bigint, piece int, start bigint, n_words bigint, bin bigint, bin_offset bigint, shard bigint")
    return packed.select("doc_id", "piece", "start", "n_words",
                         F.when(F.col("bin") >= 0, F.shiftleft("shard", 24) + F.col("bin")).alias("bin_id"), "bin_offset")
