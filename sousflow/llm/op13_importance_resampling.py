"""Resampling towards a target distribution, with the words found by an Aho-Corasick automaton.

Features are runs of consecutive words. A word is a run of bytes other than the ASCII characters
that are no digits and no letters; A-Z counts as a-z. A feature's bucket is the CRC-32 of its words,
joined by one space, modulo the number of buckets.

The bytes of a slice of texts become one string in which every delimiter is a space. The automaton
holds distinct words, each between two spaces, with CRC and length as payload, so one scan emits the
payload of every known word in order; a word that no pattern covers is a gap between the matches, is
hashed on its own and learned for the following slices. Every task learns its own dictionary, of
bounded size: which words it holds changes the time only. CRCs of longer runs come from those of
adjacent words: the CRC of two strings one after the other is a linear map of the first one's CRC,
which the length of the second names, plus the CRC of the second.

Counts of buckets are pre-aggregated in each task. The sample is drawn by one range exchange of
(score, id) rows: the rank is a row's place in its range plus the rows of the ranges before.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, staged, text_of
from .words import raw

#: Words a task's automaton holds at most; further ones are hashed one by one.
DICTIONARY_WORDS = 1 << 17
#: A longer word is never learned.
WORD_BYTES = 48
#: The automaton is built anew when so many words, or a quarter of those it holds, were not in it.
RELEARN = 4096

_SPACE = 0x20
#: The byte in the scanned string of each byte of a text: lower case, delimiters as spaces.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = _SPACE
_PLAIN[0x30:0x3A] = np.arange(0x30, 0x3A)
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_CRC_POLYNOMIAL = 0xEDB88320  # CRC-32, reflected


class CrcShift:
    """CRCs of ``a`` followed by ``b`` from the CRC of ``a``, the CRC of ``b`` and the length of ``b``."""

    def __init__(self) -> None:
        bit = np.arange(32, dtype=np.uint32)
        unit = np.uint32(1) << bit
        # one zero bit: a shift, and the polynomial where the lowest bit falls out
        self._doubles = [np.where(unit & 1, np.uint32(_CRC_POLYNOMIAL), unit >> np.uint32(1)).astype(np.uint32)]
        self._by_length: dict[int, np.ndarray] = {}

    @staticmethod
    def _apply(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), dtype=np.uint32)
        for i in range(32):
            out ^= np.where((values >> np.uint32(i)) & np.uint32(1), columns[i], np.uint32(0))
        return out

    def _columns(self, length: int) -> np.ndarray:
        """The 32 columns of the linear map that ``length`` bytes of zero stand for."""
        if length not in self._by_length:
            bits, total, power = length * 8, np.uint32(1) << np.arange(32, dtype=np.uint32), 0
            while bits >> power:
                if power == len(self._doubles):
                    self._doubles.append(self._apply(self._doubles[-1], self._doubles[-1]))
                if bits >> power & 1:
                    total = self._apply(self._doubles[power], total)
                power += 1
            self._by_length[length] = total
        return self._by_length[length]

    def join(self, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), dtype=np.uint32)
        for length in np.unique(lengths).tolist():
            at = lengths == length
            out[at] = self._apply(self._columns(length), a[at])
        return out ^ b


class Scanner:
    """An automaton of the words seen so far, and the CRCs and lengths of all words of a slice."""

    def __init__(self, capacity: int = DICTIONARY_WORDS) -> None:
        self.capacity, self.words, self.fresh, self.automaton = capacity, {}, {}, None

    def _learn(self) -> None:
        for word in list(self.fresh)[: max(0, self.capacity - len(self.words))]:
            self.words[word] = self.fresh[word]
        self.fresh = {}
        if self.words:
            self.automaton = ahocorasick.Automaton()
            for word, payload in self.words.items():
                self.automaton.add_word(f" {word} ", payload)
            self.automaton.make_automaton()

    def scan(self, text: str, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """CRC and length of the words at the given places of ``text``, in order."""
        if self.automaton is None and self.capacity:
            seen = dict.fromkeys(text.split(" "))
            self.fresh = {w: (zlib.crc32(w.encode("latin-1")), len(w)) for w in seen if 0 < len(w) <= WORD_BYTES}
            self._learn()
        payloads = np.zeros((len(starts), 2), dtype=np.int64)
        known = np.zeros(len(starts), dtype=bool)
        hits = list(self.automaton.iter(text)) if self.automaton is not None else []
        if hits:
            # a match ends on the space behind its word
            at = np.searchsorted(ends, np.fromiter((x[0] for x in hits), dtype=np.int64, count=len(hits)))
            payloads[at] = np.array([x[1] for x in hits], dtype=np.int64)
            known[at] = True
        for i in np.flatnonzero(~known).tolist():
            word = text[starts[i] : ends[i]]
            found = self.fresh.get(word)
            if found is None:
                found = zlib.crc32(word.encode("latin-1")), len(word)
                if len(word) <= WORD_BYTES and len(self.words) + len(self.fresh) < self.capacity:
                    self.fresh[word] = found
            payloads[i] = found
        if len(self.fresh) >= max(RELEARN, len(self.words) // 4):
            self._learn()
        return payloads[:, 0].astype(np.uint32), payloads[:, 1]


def plain_text(column: pa.Array) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one string of bytes between spaces, starts and ends of the words in it, and the words of each text."""
    data, at = raw(column)
    rows = len(at) - 1
    line = np.full(len(data) + rows + 1, _SPACE, dtype=np.uint8)
    line[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(at))] = _PLAIN[data]
    inside = line != _SPACE
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    words = np.diff(np.searchsorted(starts, at + np.arange(rows + 1)))
    return line.tobytes().decode("latin-1"), starts, ends, words


def features_of(column: pa.Array, scanner: Scanner, shift: CrcShift, max_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRCs of the features of all texts in the order of texts, the features of each text, and its words."""
    text, starts, ends, words = plain_text(column)
    crc, length = scanner.scan(text, starts, ends)
    doc = np.repeat(np.arange(len(words)), words)
    found, owner, run, last = [crc], [doc], crc, np.arange(len(crc))
    space = np.uint32(zlib.crc32(b" "))
    for _ in range(1, max_words):
        # extend every run by the next word of its text
        more = last + 1 < len(crc)
        more[more] = doc[last[more] + 1] == doc[last[more]]
        run, last = run[more], last[more] + 1
        run = shift.join(run, np.full(len(run), space), np.ones(len(run), dtype=np.int64))
        run = shift.join(run, crc[last], length[last])
        found.append(run)
        owner.append(doc[last])
    crcs, owners = np.concatenate(found), np.concatenate(owner)
    if max_words > 1:
        crcs = crcs[np.argsort(owners, kind="stable")]
    return crcs, np.bincount(owners, minlength=len(words)), words


def _bucketed(texts: DataFrame, buckets: int, max_words: int, capacity: int) -> DataFrame:
    """Each row of ``texts`` (_key.., _text) with n_words, n_features and its buckets as packed 32-bit numbers, or 16-bit ones if they do."""
    keys = [f for f in texts.schema.fields if f.name != "_text"]
    schema = T.StructType([*keys, T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("buckets", T.BinaryType())])
    kind = _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, shift = Scanner(capacity), CrcShift()
        for batch in batches:
            for part in slices(batch, "_text"):
                crcs, n, words = features_of(part.column("_text"), scanner, shift, max_words)
                packed = (crcs % np.uint32(buckets)).astype(kind)
                offsets = np.concatenate([[0], np.cumsum(n)]) * kind.itemsize
                cells = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in keys], pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), cells.cast(pa.binary())], names=schema.names)

    return texts.mapInArrow(run, schema)


def _width(buckets: int) -> np.dtype:
    return np.dtype(np.uint16 if buckets <= 1 << 16 else np.uint32)


def _cells(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    data, at = raw_binary(column)
    return data.view(kind), at // kind.itemsize


def raw_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column one after the other, and where each value begins (one more entry than values)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data if data is not None else b"", dtype=np.uint8)[at[0] : at[-1]].copy(), at - at[0]


def bucket_counts(bucketed: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds. One row a task and bucket is shuffled, one number a bucket comes to the driver."""
    kind = _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_cells(batch.column("buckets"), kind)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    sums = bucketed.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the smoothed ratio) of each bucket's share in the target to its share in the source."""
    all_source, all_target, buckets = float(source.sum()), float(target.sum()), float(len(source))
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_source + buckets) / ((s + 1.0) * (all_target + buckets)))) for s, t in pairs], dtype=np.int64)


def _scored(bucketed: DataFrame, gains: np.ndarray, id_field: T.StructField, buckets: int) -> DataFrame:
    """Weight and score of every row."""
    kind = _width(buckets)
    schema = T.StructType([id_field, *[T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight", "score")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, at = _cells(batch.column("buckets"), kind)
            sums = np.concatenate([[0], np.cumsum(gains[cells])])
            weight = sums[at[1:]] - sums[at[:-1]]
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in batch.column("_h").to_pylist()]
            score = weight + np.array(noise, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("n_words"), batch.column("n_features"), pa.array(weight), pa.array(score)], names=schema.names)

    return bucketed.mapInArrow(run, schema)


def _ranked(scored: DataFrame, id_column: str, percent: int, min_words: int) -> DataFrame:
    """``rank`` for the drawn rows: a range exchange by score, and in each range the rows' places after the ranges before."""
    spark = scored.sparkSession
    order = [F.col("score").desc(), F.col(id_column).asc_nulls_last(), F.col("_row").asc()]
    able = F.col("n_words") >= min_words
    # _row only tells apart rows that repeat an id and score, so that one range need not hold them all
    rows = scored.withColumn("_row", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.where(able).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the partition is in the upper bits, the place in it below
    at = dealt.select("*", F.monotonically_increasing_id().alias("_at"))
    placed = staged(at.select("*", F.shiftright("_at", 33).alias("_range"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "op13-ranges")
    sizes = dict(placed.groupBy("_range").count().collect())  # one row a range
    before, total = [], 0
    for r in sorted(sizes):
        before.append((r, total))
        total += sizes[r]
    drawn = percent * total // 100
    starts = spark.createDataFrame(before, "_range long, _before long")
    rank = F.col("_before") + F.col("_place") + 1
    columns = [id_column, "n_words", "n_features", "weight", "score"]
    named = placed.join(starts, "_range").select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    return named.unionByName(rows.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 10, buckets: int = 10_000, max_words: int = 1, min_words: int = 20,
             seed: int = 2024, id_column: str = "doc_id", text_column: str = "text", target_text_column: str = "text",
             dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """Every document's n_words, n_features, weight, score and rank: the draw of ``percent`` of those with ``min_words`` words and more.

    Features are all runs of 1 to ``max_words`` words of the whole text. A document's weight is the sum of its features'
    gains, the log ratios of their buckets' shares in ``target`` and ``docs``; the score adds Gumbel noise from a hash of
    seed and id, so the highest scores are a sample without replacement by weight. rank is 1, 2, 3... for the drawn
    documents, null for others. A null text counts as empty, and a document without words has weight 0; ties of the score
    go to the smaller id, a null id last (it hashes like an empty one). Rows that repeat an id and text are rows of their
    own with one score and neighbouring ranks. An empty ``docs`` gives an empty table, an empty ``target`` equal counts of 0.
    Long texts are counted whole. Other columns take no part, whatever their names.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    source = docs.select(F.col(id_column), F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("_h"), text_of(docs, text_column).alias("_text"))
    bucketed = staged(_bucketed(source, buckets, max_words, dictionary_words), "op13-buckets")
    wanted = _bucketed(target.select(text_of(target, target_text_column).alias("_text")), buckets, max_words, dictionary_words)
    gains = bucket_gains(bucket_counts(bucketed, buckets), bucket_counts(wanted, buckets))
    scored = staged(_scored(bucketed, gains, docs.schema[id_column], buckets), "op13-scores")
    return _ranked(scored, id_column, percent, min_words)
