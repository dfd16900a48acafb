"""Language-model scoring by prediction by partial matching (PPM) over bytes.

A text is its token sequence: words with A-Z lower-cased, joined by one space, then an end.
The model is a trie of byte contexts up to ``ORDER`` bytes with the symbols seen after each.
A symbol is coded in the longest context that knows it; every longer context that the
trie holds escapes first, and the symbols of the longer context are excluded from the
shorter one's counts. Escapes are estimated by method C: the number of distinct symbols of the
context, over that and the occurrences. Below order 0 the bytes not yet seen are equally likely.

All training texts are counted: each task sends its byte and word counts, packed by parts of
the key space, and one task for each part adds them up. A part holds all symbols of its longest
contexts, so that the same task says what these give.
The trie is whole at every size and stays in tables. A symbol's probability depends on its gram
alone, the ``ORDER`` bytes before it and itself, so it is worked out once for each distinct gram of
all texts: from the symbols of its context, and for grams that no training text has by
joins with the contexts of one shorter order after the other. Grams and words that occur more
often than once in ``MAX_ENTRIES`` symbols or tokens, so at most that many, go to the tasks with
their values; all others are joined. For that a task sends the other grams of a block of texts,
packed by parts of the gram space, and gets back their sums for each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, frugal, frugal_groups, give_back, shared, slices, staged, text_of
from .words import SEPARATOR, hashed, mixed, raw, word_bounds

ORDER = 6
#: Bound on the grams and on the words that are broadcast.
MAX_ENTRIES = 1 << 21
END = np.uint64(0x5E9D_0E9D_0E9D_0E9D)
#: Symbols and distinct words of slices that a counting task holds before it adds them up and sends them.
_FLUSH = 2_500_000
#: Grams that a task sends together, and about how many grams to look up one task gets.
_BLOCK_GRAMS, _PART_GRAMS = 1_000_000, 4_000_000
#: About how many bytes of text give the counts of one part; a byte sends at most one gram.
_PART_BYTES = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mask(size: int) -> np.uint64:
    return np.uint64((1 << (8 * size)) - 1)


@dataclass(frozen=True)
class Coded:
    """Texts as symbols: packed contexts and symbol of each coded place, its text, and the word hashes."""

    grams: np.ndarray
    cut: np.ndarray
    hashes: np.ndarray
    word_cut: np.ndarray


def coded(column: pa.Array) -> Coded:
    """The symbols of all texts; ``grams`` packs ``ORDER`` bytes of context and the symbol, zeros before the start, zero for the end."""
    data, at = raw(column)
    starts, ends = word_bounds(data, at)
    hashes = hashed(data, starts, ends)
    word_cut = np.searchsorted(starts, at)
    keep = ~SEPARATOR[data] if len(data) else np.zeros(0, bool)
    first = np.zeros(len(starts), dtype=bool)
    first[word_cut[:-1][np.diff(word_cut) > 0]] = True
    keep[starts[~first] - 1] = True  # the separator before every word but a text's first
    where = np.flatnonzero(keep)
    size = np.diff(np.searchsorted(where, at))
    texts = len(size)
    begin = np.cumsum(size + ORDER + 1) - (size + 1)  # where each text's symbols begin in the stream
    stream = np.zeros(int((size + ORDER + 1).sum()), dtype=np.uint8)
    symbols = _LOWER[data[where]]
    symbols[SEPARATOR[symbols]] = 32
    text = np.repeat(np.arange(texts), size)
    stream[np.arange(len(where)) + (begin - (np.cumsum(size) - size))[text]] = symbols
    packed = np.zeros(len(stream), dtype=np.uint64)
    for k in range(ORDER + 1):
        packed[k:] |= stream[: len(stream) - k].astype(np.uint64) << np.uint64(8 * k)
    place = np.ones(len(stream), dtype=bool)
    for k in range(ORDER):
        place[begin - 1 - k] = False
    return Coded(packed[place], np.concatenate([[0], np.cumsum(size + 1)]), hashes, word_cut)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys ^ np.uint64(0x6A09E667F3BCC909)) % np.uint64(parts)).astype(np.int32)


def _by_part(part: np.ndarray, parts: int) -> np.ndarray:
    """The stable order by part; numbers of 16 bits are sorted in linear time."""
    return np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")


def _planes(values: np.ndarray) -> bytes:
    """The bytes of the values, all first ones, then all second ones: the upper ones are mostly zero and squeeze well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _values(packed: pa.Scalar, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(packed.as_buffer(), np.uint8).reshape(size, -1).T).view(kind).ravel()


def _counted(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and their counts, of grams with a bit below that says they are of held-out texts, which count 0. Empties the list."""
    marked = np.concatenate(grams)
    grams.clear()  # the copy is all that is needed, and a task holds few of these at once
    marked.sort()
    held = marked.astype(np.uint8) & 1
    marked >>= np.uint64(1)
    first = np.ones(len(marked), dtype=bool)
    np.not_equal(marked[1:], marked[:-1], out=first[1:])
    at = np.flatnonzero(first)
    keys, total = marked[at], len(marked)
    del marked, first
    counts = np.diff(at, append=total).astype(np.uint32)
    counts -= np.add.reduceat(held, at, dtype=np.uint32)
    return keys, counts


def _gather(parts: int):
    """Counts of the words (kind 0) and of the longest contexts with their symbol (kind 1) of one task, for each part its sorted keys
    (as steps) and their counts; held-out texts add their grams with count 0. All symbols of a context are in one part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = [], []

        def flush() -> Iterator[pa.RecordBatch]:
            give_back()  # what the reading of texts took, before as much again is needed
            for kind, waiting, add, shift in ((0, words, _added, 0), (1, grams, _counted, 8)):
                if waiting:
                    keys, counts = add(waiting)
                    waiting.clear()
                    part = _part(keys >> np.uint64(shift), parts)
                    by = _by_part(part, parts)
                    part, keys, counts = part[by], keys[by], counts[by].astype(np.uint32, copy=False)  # of one block of texts
                    del by
                    cuts = np.flatnonzero(np.diff(part, prepend=-1))
                    for lo, hi in zip(cuts.tolist(), np.append(cuts[1:], len(keys))[: len(cuts)].tolist(), strict=True):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(part[lo : lo + 1]), pa.array([kind], pa.int8()), pa.array([_planes(np.diff(keys[lo:hi], prepend=np.uint64(0)))], pa.binary()),
                            pa.array([_planes(counts[lo:hi])], pa.binary())], ["part", "kind", "keys", "counts"])
            give_back()

        total = 0
        for whole in batches:
            for batch in slices(whole, "text"):
                out = batch.column("held_out")
                learned = batch.column("text").filter(pa.compute.invert(out))
                x = coded(learned)
                values, counts = np.unique(np.append(x.hashes, np.full(len(learned), END)), return_counts=True)
                words.append((values, counts.astype(np.int64)))
                held = coded(batch.column("text").filter(out)).grams
                grams.extend(g for g in (x.grams << np.uint64(1), held << np.uint64(1) | np.uint64(1)) if len(g))
                total += len(values) + len(x.grams) + len(held)
                if total > _FLUSH:
                    yield from flush()
                    total = 0
        yield from flush()
    return run


_COUNTS = "kind tinyint, key bigint, n bigint, log double, so_far double, seen binary"


def _summed(part: pa.Table) -> pa.Table:
    """Kind, key and count of the distinct keys of one part; of grams also what the longest context gives."""
    kinds = part.column("kind").to_numpy()
    out = []
    for kind in (0, 1):
        rows = part.filter(pa.array(kinds == kind))
        keys, counts = _added([(np.cumsum(_values(k, np.uint64), dtype=np.uint64), _values(n, np.uint32).astype(np.int64)) for k, n in zip(rows.column("keys"), rows.column("counts"), strict=True)]
                              or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))])
        if kind == 0:
            nothing = [pa.nulls(len(keys), t) for t in (pa.float64(), pa.float64(), pa.binary())]
            out.append(pa.RecordBatch.from_arrays([pa.array(np.zeros(len(keys), np.int8)), pa.array(keys.view(np.int64)), pa.array(counts), *nothing], _names(_COUNTS)))
        else:
            out += [pa.RecordBatch.from_arrays([pa.array(np.ones(b.num_rows, np.int8)), *b.columns], _names(_COUNTS)) for b in _longest(keys.view(np.int64), counts)]
    return pa.Table.from_batches(out)


class Lookup:
    """A hash table from 64-bit keys to their place in the sorted key array, -1 for others."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * max(len(keys), 1) - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.place = np.full(1 << self.bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.place[slot] < 0
            _, pick = np.unique(np.where(free, slot, -1), return_index=True)
            pick = pick[free[pick]]
            self.keys[slot[pick]], self.place[slot[pick]] = keys[left[pick]], left[pick]
            rest = np.ones(len(left), dtype=bool)
            rest[pick] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.place[slot]
        left = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            out[left] = self.place[slot[left]]
            left = left[(out[left] >= 0) & (self.keys[slot[left]] != keys[left])]
        return out


@dataclass(frozen=True)
class Order:
    """One order of the trie: its entries (context and symbol) and its contexts."""

    entries: Lookup
    count: np.ndarray
    nodes: Lookup
    #: Per context: occurrences, distinct symbols; of these, those of held entries; and what a shorter context loses to them.
    total: np.ndarray
    distinct: np.ndarray
    held: np.ndarray
    held_distinct: np.ndarray
    excluded: np.ndarray
    direct: np.ndarray


class Trie:
    """The trie in memory, for small tables and trials; ``score`` works on tables.

    Made from the entries (keys, counts) and contexts (keys, occurrences, distinct symbols) of every order,
    0 first, sorted by key. Occurrences of symbols that it does not hold add to the escape.
    """

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.orders: list[Order] = []
        for k, ((keys, counts), (nodes, total, distinct)) in enumerate(zip(tables, contexts, strict=True)):
            node = np.searchsorted(nodes, keys >> np.uint64(8))  # every entry's context is held, as it occurs at least as often
            sums = lambda x, node=node, n=len(nodes): np.bincount(node, x, n)
            total, distinct = total.astype(float), distinct.astype(float)
            shorter = self.orders[-1] if k else None
            excluded = sums(shorter.count[shorter.entries.find(keys & _mask(k))].astype(float)) if shorter and len(keys) else np.zeros(len(nodes))
            self.orders.append(Order(Lookup(keys), counts, Lookup(nodes), total, distinct, sums(counts.astype(float)), sums(np.ones(len(keys))), excluded,
                                     np.log10(counts / (total + distinct)[node])))

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of every symbol after its context."""
        top = self.orders[-1]
        place = top.entries.find(grams)
        out = np.where(place >= 0, top.direct[np.maximum(place, 0)], 0.0) if len(top.direct) else np.zeros(len(grams))
        left = np.flatnonzero(place < 0)
        less, fewer = np.zeros(len(left)), np.zeros(len(left))  # occurrences and number of the symbols that the longer context has excluded
        for k in range(len(self.orders) - 1, -1, -1):
            order, g = self.orders[k], grams[left] & _mask(k + 1)
            if not len(order.total):
                continue
            node = order.nodes.find(g >> np.uint64(8))
            seen = node >= 0
            node = np.maximum(node, 0)
            weight = order.total[node] - less + order.distinct[node] - fewer
            escape = weight - (order.held[node] - less)
            known = seen & (weight > 0) & (order.held_distinct[node] > fewer)  # one whose symbols are all excluded says nothing
            entry = order.entries.find(g) if k < len(self.orders) - 1 else np.full(len(g), -1)
            hit = known & (entry >= 0)
            out[left[hit]] += np.log10(order.count[entry[hit]] / weight[hit])
            miss = known & ~hit
            out[left[miss]] += np.log10(escape[miss] / weight[miss])
            less, fewer = np.where(seen, order.excluded[node], 0.0)[~hit], np.where(seen, order.held_distinct[node], 0.0)[~hit]
            left = left[~hit]
        unseen = 256 - (self.orders[0].held_distinct[0] if len(self.orders[0].total) else 0)
        out[left] -= np.log10(max(unseen, 1))
        return out


def _collected(table: DataFrame, key: str, *values: str) -> tuple[np.ndarray, ...]:
    rows = table.select(key, *values).toArrow()
    keys = rows.column(key).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], *(rows.column(v).to_numpy()[order] for v in values)


def _entries(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of (s, n): row, symbol and count of every entry; a null list has none."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), sizes), flat.field("s").to_numpy(zero_copy_only=False).astype(np.int64), flat.field("n").to_numpy(zero_copy_only=False).astype(np.float64)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


_LOGS = "key bigint, n bigint, log double, so_far double, seen binary"


def _log_batch(keys: np.ndarray, n: np.ndarray, logs: np.ndarray, so_far: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    """Grams with their log10, or with what the escapes so far give and the symbols (as bits) that they exclude."""
    open_ = np.isnan(logs)
    bits = np.packbits(seen, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64)), pa.array(logs, mask=open_), pa.array(so_far),
                                       pa.array([b.tobytes() if o else None for b, o in zip(bits, open_, strict=True)] if len(bits) else pa.nulls(len(keys), pa.binary()), pa.binary())],
                                      ["key", "n", "log", "so_far", "seen"])


def _longest(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """From sorted grams with all symbols of their contexts of the longest order: their logs; those of count 0 escape from a context that training texts have."""
    contexts = keys >> 8
    first = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(keys) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    total, distinct = np.bincount(row, n, len(first)), np.bincount(row, n > 0, len(first))
    old, new = np.flatnonzero(n > 0), np.flatnonzero(n == 0)
    yield _log_batch(keys[old], n[old], np.log10(n[old] / (total + distinct)[row[old]]), np.zeros(len(old)), np.zeros((0, 256), bool))
    known = total[row[new]] > 0
    so_far = np.zeros(len(new))
    so_far[known] = np.log10((distinct / np.maximum(total + distinct, 1))[row[new][known]])
    end = np.append(first[1:], len(keys))
    for lo in range(0, len(new), 10_000):
        part = slice(lo, lo + 10_000)
        rows, place = np.unique(row[new[part]], return_inverse=True)
        size = (end - first)[rows]
        mine = np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())  # all grams of these contexts
        at = np.repeat(np.arange(len(rows)), size)[n[mine] > 0]
        seen = np.zeros((len(rows), 256), dtype=bool)
        seen[at, keys[mine[n[mine] > 0]] & 255] = True
        yield _log_batch(keys[new[part]], n[new[part]], np.full(len(new[part]), np.nan), so_far[part], seen[place])


def _shorter(last: bool):
    """One order on: open grams, each with all symbols of its context of this order, or with none if no training text has that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            row, symbol, n = _entries(batch.column("e"))
            keys, so_far = batch.column("key").to_numpy(), batch.column("so_far").to_numpy().copy()
            before = np.unpackbits(np.frombuffer(b"".join(batch.column("seen").to_pylist()), np.uint8).reshape(rows, 32), axis=1).astype(bool)
            left = ~before[row, symbol]  # symbols that the longer context has are excluded
            total, distinct = np.bincount(row, n * left, rows), np.bincount(row, left, rows).astype(float)
            own = np.bincount(row, n * (symbol == (keys & 255)[row]), rows)
            known = distinct > 0  # one whose symbols are all excluded says nothing
            hit, miss = known & (own > 0), known & (own == 0)
            logs = np.full(rows, np.nan)
            logs[hit] = so_far[hit] + np.log10(own[hit] / (total + distinct)[hit])
            so_far[miss] += np.log10(distinct[miss] / (total + distinct)[miss])
            seen = before
            seen[row, symbol] = True
            if last:
                end = np.isnan(logs)
                logs[end] = so_far[end] - np.log10(np.maximum(256 - seen[end].sum(axis=1), 1))
            yield _log_batch(keys, np.zeros(rows), logs, so_far, seen)
    return run


def _context(order: int):
    """The context of a gram at an order."""
    return F.shiftrightunsigned(F.col("key").bitwiseAND(F.lit(int(_mask(order + 1)))), 8)


def _with_symbols(grams: DataFrame, order: int) -> DataFrame:
    """(context, e: its symbols and their counts, at most 256) of the grams of an order."""
    return grams.groupBy(_context(order).alias("context")).agg(F.collect_list(F.struct(F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("s"), "n")).alias("e"))


def _gram_logs(first: DataFrame) -> DataFrame:
    """(key, n, log) of all distinct grams, those of held-out texts alone with n = 0, from what the longest contexts give."""
    done, open_ = [first.where("log IS NOT NULL")], first.where("log IS NULL")
    grams = first.where("n > 0")
    for k in range(ORDER - 1, -1, -1):
        if open_.isEmpty():
            break
        grams = staged(grams.groupBy(F.col("key").bitwiseAND(F.lit(int(_mask(k + 1)))).alias("key")).agg(F.sum("n").alias("n")), "ppm-order")
        met = open_.withColumn("context", _context(k))
        wanted = grams.withColumn("context", _context(k)).join(met.select("context").distinct(), "context", "left_semi")
        step = staged(met.join(_with_symbols(wanted, k), "context", "left").select("key", "so_far", "seen", "e").mapInArrow(frugal(_shorter(k == 0)), _LOGS), "ppm-logs")
        done.append(step.where("log IS NOT NULL"))
        open_ = step.where("log IS NULL")
    out = done[0].select("key", "n", "log")
    for more in done[1:]:
        out = out.unionByName(more.select("key", "n", "log"))
    return out


@dataclass(frozen=True)
class Model:
    """Counts of the whole training part, the grams of all texts, and what the tasks get of them."""

    words: DataFrame
    tokens: int
    distinct: int
    frequent: tuple[np.ndarray, np.ndarray]
    frequent_grams: tuple[np.ndarray, np.ndarray]
    #: (key, log) of the other grams, and how often they occur in the training part.
    grams: DataFrame
    rest: int


def train(docs: DataFrame, max_entries: int = MAX_ENTRIES) -> Model:
    """Count (text) of all rows that are not ``held_out``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // _PART_BYTES))
    sent = docs.select("text", "held_out").mapInArrow(frugal(_gather(parts)), "part int, kind tinyint, keys binary, counts binary")
    counts = staged(sent.groupBy("part").applyInArrow(frugal_groups(lambda key, part: _summed(part)), _COUNTS), "ppm-counts")
    often = F.col("n") * max_entries
    sums = {r.kind: (r.n, r.distinct) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()}
    tokens, distinct = sums.get(0, (0, 0))
    symbols = sums.get(1, (0, 0))[0]
    grams, words = counts.where("kind = 1").select("key", "n"), counts.where("kind = 0").select("key", "n")
    logs = _gram_logs(counts.where("kind = 1").drop("kind"))
    rest = grams.where(often <= symbols).agg(F.sum("n")).first()[0] or 0
    # each filter passes fewer than max_entries rows, as they add up to all symbols or tokens
    return Model(words, tokens, distinct, _collected(words.where(often > tokens), "key", "n"), _collected(logs.where(often > symbols), "key", "log"),
                 logs.where(often <= symbols).select("key", "log"), rest)


def _packed(block: int, keys: np.ndarray, texts: np.ndarray, parts: int) -> Iterator[tuple]:
    """Of the grams of a block of texts, for each part: distinct grams (as steps), how often each occurs, and the texts where."""
    order = np.lexsort((texts, keys))
    keys, texts = keys[order], texts[order].astype(np.uint32, copy=False)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    part = _part(keys[at], parts)
    size = np.diff(np.append(at, len(keys)))
    by = _by_part(part, parts)
    texts = texts[np.argsort(np.repeat(part, size), kind="stable")]
    cut = np.flatnonzero(np.diff(part[by], prepend=-1))
    ends = np.concatenate([[0], np.cumsum(size[by])])
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(by)], strict=True):
        yield block, int(part[by[lo]]), _planes(np.diff(keys[at][by[lo:hi]], prepend=np.uint64(0))), _planes(size[by[lo:hi]].astype(np.uint32)), _planes(texts[ends[lo] : ends[hi]])


def _part_of(parts: int):
    @F.pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(_part(keys.to_numpy().view(np.uint64), parts))
    return run


_SENT = ("block", "part", "grams", "sizes", "texts")


def _looked_up(key: tuple, sent: pa.Table, logs: pa.Table) -> pa.Table:
    """Of one part: the sums of the logs for the texts of every block; rows of texts pass."""
    passed = sent.filter(pa.compute.is_valid(sent.column("row"))).drop_columns(["grams", "sizes", "texts"])
    sent = sent.filter(pa.compute.is_null(sent.column("row")))
    keys = logs.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, values = keys[order], logs.column("log").to_numpy()[order]
    blocks, texts, sums = [], [], []
    for block, grams, sizes, where in zip(*(sent.column(c) for c in ("block", "grams", "sizes", "texts")), strict=True):
        found = values[np.searchsorted(keys, np.cumsum(_values(grams, np.uint64), dtype=np.uint64))]  # every gram of a text is in the table
        where = _values(where, np.uint32)
        each = np.bincount(where, np.repeat(found, _values(sizes, np.uint32)))
        some = np.unique(where).astype(np.int32)
        blocks.append(block.as_py())
        texts.append(some.tobytes())
        sums.append(each[some].tobytes())
    out = pa.table([pa.array(blocks, pa.int64()), pa.array([key[0].as_py()] * len(blocks), pa.int32()), pa.array(texts, pa.binary()), pa.array(sums, pa.binary())], names=["block", "part", "texts", "sums"])
    names = [*passed.column_names, "texts", "sums"]
    kinds = {**{f.name: f.type for f in passed.schema}, **{f.name: f.type for f in out.schema}}
    fill = lambda t: pa.table([t.column(c).cast(kinds[c]) if c in t.column_names else pa.nulls(t.num_rows, kinds[c]) for c in names], names=names)
    return pa.concat_tables([fill(passed), fill(out)])


def _block_sums(key: tuple, part: pa.Table) -> pa.Table:
    """Of one block: row and sum of every text, added in the order of the parts, so that equal texts have equal sums."""
    part = part.sort_by("part")
    texts = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in part.column("texts")])
    sums = np.bincount(texts, np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in part.column("sums")]))
    some = np.unique(texts)
    return pa.table([pa.array((key[0].as_py() << 20) + some.astype(np.int64)), pa.array(sums[some])], names=["row", "rest"])


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 10, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows outside fold 0. ``base_score`` is the smoothed unigram score of the tokens,
    ``score`` the trie's log10 probability of the text; both include the end. A null text
    counts as empty: one token, the end. A null id counts as the empty string for its fold. An
    empty table gives an empty result; without training rows every symbol is equally likely.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text_of(docs, text_column).alias("text"))
    rows = rows.withColumn("held_out", F.pmod(doc_key(F.col("doc_id")), F.lit(folds)) == 0)
    model = train(rows, max_entries)
    log_all = float(np.log10(model.tokens + 0.1 * (model.distinct + 1)))
    sent = shared(spark, (Lookup(model.frequent[0]), model.frequent[1], Lookup(model.frequent_grams[0]), model.frequent_grams[1]))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-model.rest // _PART_GRAMS))
    texts_schema = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double, rare array<bigint>, times array<int>"
    names = _names(texts_schema)
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    sent_kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, counts, grams, logs10 = sent()
        block, texts, held, waiting = TaskContext.get().partitionId() << 20, 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting:
                keys, where = np.concatenate([k for k, _ in held]), np.concatenate([t for _, t in held])
                held.clear()
                give_back()
                for values in _packed(block, keys, where, parts):
                    yield pa.RecordBatch.from_arrays([*(pa.nulls(1, kind) for kind in kinds), *(pa.array([v], kind) for v, kind in zip(values, sent_kinds, strict=True))], [*names, *_SENT])

        for whole in batches:
            for batch in slices(whole, "text"):
                if waiting > _BLOCK_GRAMS or texts > 1 << 19:
                    yield from flush()
                    block, texts, held, waiting = block + 1, 0, [], 0
                x = coded(batch.column("text"))
                place = grams.find(x.grams)
                text = np.repeat(np.arange(batch.num_rows), np.diff(x.cut))
                settled, others = place >= 0, np.flatnonzero(place < 0)
                sums = np.bincount(text[settled], logs10[place[settled]], batch.num_rows).astype(float)  # of nothing it is whole numbers
                held.append((x.grams[others], (text[others] + texts).astype(np.uint32)))
                waiting += len(others)
                row = (block << 20) + texts + np.arange(batch.num_rows)
                texts += batch.num_rows
                ends = np.full(batch.num_rows, END)
                keys = np.concatenate([x.hashes, ends])
                owner = np.concatenate([np.repeat(np.arange(batch.num_rows), np.diff(x.word_cut)), np.arange(batch.num_rows)])
                place = lookup.find(keys)
                often = place >= 0
                known = np.bincount(owner[often], minlength=batch.num_rows)
                logs = np.log10(counts + 0.1) - log_all if len(counts) else np.zeros(1)
                base = np.bincount(owner[often], logs[place[often]], minlength=batch.num_rows).astype(float)
                rest = np.flatnonzero(~often)
                rest = rest[np.argsort(owner[rest], kind="stable")]
                cut = np.searchsorted(owner[rest], np.arange(batch.num_rows + 1))
                rare, times = [], []
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    values, n = np.unique(keys[rest[a:b]], return_counts=True)
                    rare.append(values.view(np.int64))
                    times.append(n.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row), batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(x.word_cut).astype(np.int64) + 1), pa.array(known.astype(np.int64)),
                    pa.array(base), pa.array(sums), pa.array(rare, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32())),
                    pa.nulls(batch.num_rows, pa.int64()), pa.array((row % parts).astype(np.int32)), *(pa.nulls(batch.num_rows, pa.binary()) for _ in range(3))], [*names, *_SENT])
        yield from flush()

    # texts, and the grams to look up, in one pass and one shuffle
    both = rows.mapInArrow(frugal(run), f"{texts_schema}, block bigint, part int, grams binary, sizes binary, texts binary")
    logs = model.grams.withColumn("part", _part_of(parts)(F.col("key")))
    found = both.groupBy("part").cogroup(logs.groupBy("part")).applyInArrow(frugal_groups(_looked_up), f"{texts_schema}, block bigint, part int, texts binary, sums binary")
    found = staged(found, "ppm-rows")
    scored = found.where("row IS NOT NULL").select(*names)
    rest = found.where("row IS NULL").select("block", "part", "texts", "sums").groupBy("block").applyInArrow(frugal_groups(_block_sums), "row bigint, rest double")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("key"), F.col("x.times").alias("times"))
    joined = rare.join(model.words, "key", "left")
    per_row = joined.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1)) - F.lit(log_all))).alias("rare_base"))
    return scored.drop("rare", "times").join(per_row, "row", "left").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"))
