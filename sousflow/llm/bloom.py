"""Bloom filters as numpy bitmaps, built by Spark tasks, bounded in size and sent to all of them.

Each slot counts 0, 1 or "2 and more" keys. The bitmap of slots counted at least once
tells whether a key is (possibly) in a set; that of slots counted at least twice whether a
key is (possibly) repeated. Neither ever misses a key. Slots are merged in chunks by a
grouped job, and the driver holds only the merged bitmap, at most ``MAX_SLOTS`` bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal

#: Slots for each key and slots that a key counts in: about 1 foreign key in 2000 passes by chance.
SLOTS_PER_KEY, PROBES = 16, 4
#: 64 MB of bits. A larger set fills them more and lets more foreign keys pass, never fewer of its own.
MAX_SLOTS = 1 << 29
_CHUNK = 1 << 17


def _positions(keys: np.ndarray, slots: int) -> np.ndarray:
    """The slots of each key, one column for each probe; a key's own slots may coincide only across probes."""
    part = slots // PROBES
    low, high = keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32)
    return np.stack([((low + np.uint64(i) * (high | np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(part) + np.uint64(i * part) for i in range(PROBES)], axis=1)


def _count_slots(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, times = np.unique(batch.column(0).to_numpy().view(np.uint64), return_counts=True)
            at = _positions(keys, slots).ravel()
            where, back = np.unique(at, return_inverse=True)
            twice = np.bincount(back, weights=np.repeat(times, PROBES), minlength=len(where)) > 1
            chunk = (where // _CHUNK).astype(np.int32)
            cuts = np.flatnonzero(np.diff(chunk, prepend=-1))
            # 17 bits of place and, above them, whether the slot is already full
            value = (where % _CHUNK).astype(np.uint32) | (twice.astype(np.uint32) << np.uint32(17))
            yield pa.RecordBatch.from_arrays([
                pa.array(chunk[cuts]),
                pa.array([x.tobytes() for x in np.split(value, cuts[1:])] if len(cuts) else [], pa.binary()),
            ], ["chunk", "value"])
    return run


def _merge_chunk(least: int, key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Bits of the slots of one chunk counted at least ``least`` (1 or 2) times; a group holds the slots of one chunk only."""
    seen = np.zeros(_CHUNK, dtype=bool)
    full = np.zeros(_CHUNK, dtype=bool)
    for value in part["value"]:
        x = np.frombuffer(value, dtype=np.uint32)
        at = x & np.uint32(_CHUNK - 1)
        full[at] |= seen[at] | (x >> np.uint32(17)).astype(bool)
        seen[at] = True
    return pd.DataFrame({"chunk": [key[0]], "bits": [zlib.compress(np.packbits(full if least > 1 else seen).tobytes(), 1)]})


def bitmap_of(keys: DataFrame, rows: int, least: int = 1) -> tuple[np.ndarray, int]:
    """The bitmap of slots counted at least ``least`` times by a frame of one bigint column of about ``rows`` keys, and its slots."""
    slots = min(MAX_SLOTS, -(-max(rows, 1) * SLOTS_PER_KEY // (_CHUNK * PROBES)) * _CHUNK * PROBES)
    counted = keys.mapInArrow(frugal(_count_slots(slots)), "chunk int, value binary")
    merged = counted.groupBy("chunk").applyInPandas(lambda key, part: _merge_chunk(least, key, part), "chunk int, bits binary")
    bits = np.zeros(slots // 8, dtype=np.uint8)
    for row in merged.collect():  # bounded by the filter's size, whatever the rows
        bits[row.chunk * _CHUNK // 8 : (row.chunk + 1) * _CHUNK // 8] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return bits, slots


def probe(keys: np.ndarray, bits: np.ndarray, slots: int) -> np.ndarray:
    """Whether all slots of each 64-bit key are set."""
    at = _positions(keys, slots)
    hit = np.ones(len(at), dtype=bool)
    for i in range(PROBES):
        hit &= (bits[at[:, i] >> np.uint64(3)] >> (np.uint64(7) - (at[:, i] & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return hit


def passes(spark: SparkSession, key: Column, bits: np.ndarray, slots: int) -> Column:
    """A boolean column: whether a bigint key (no nulls) passes the filter."""
    shared = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series(probe(column.to_numpy().view(np.uint64), shared.value, slots))

    return run(key)
