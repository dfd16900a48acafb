"""Line deduplication: an exact set-similarity join of lines.

A line's tokens are its distinct lower-cased words. A line goes when an earlier line (by
document id, then place) of the table has a Jaccard similarity of 0.8 or more with it. Every
line with a word takes part; ``min_tokens`` may ask for more distinct words, others then stay.

1. Words are counted over all lines in a fixed table of hashed counters, which orders
   tokens by rarity: by counter, then by hash. Any total order that all lines share gives a
   correct prefix filter; counters that tokens share only cost time.
2. Equal token sets are settled by a group: all but the first line go.
3. Each remaining line whose size lets another set be similar (at 0.8 four tokens and more) sends the rare prefix of its tokens, n - ceil(0.8 n) + 1 of them, to the
   task of each token. There it meets the earlier lines of the token that pass the length
   filter, the positional filter and an odd sketch of 128 bits, a lower bound of the symmetric
   difference. It keeps one of them: the first whose sketch is well below the allowed
   difference, or else the one with the nearest sketch.
4. Those pairs are verified on the full sets. A line that is not settled by it and has
   further candidates takes all of them in a second round, from the tokens' lines that the
   first round has kept for it. So large groups of similar lines give pairs in proportion to
   their lines, and every candidate of an unsettled line is examined.

A token with more lines than ``HOT_LINES`` is dealt into as many shares; its lines are
indexed in one share each and probe them all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bitmap_of, passes, probe
from .common import frugal, slices, staged, text_of
from .words import hashed, mixed, raw, word_bounds

PERCENT, MIN_TOKENS = 80, 1
#: Counters of the rarity order; 4 MB, whatever the corpus.
COUNTERS = 1 << 20
#: Lines of a token, at most, that one task holds as its index.
HOT_LINES = 50_000
#: Prefix tokens that one task holds on average; the parts of the token space follow from the counted tokens.
PART_POSTINGS = 1_500_000


@dataclass(frozen=True)
class Lines:
    """The lines of a batch with enough distinct words: text, line number, and sorted tokens from ``cut`` on."""

    text: np.ndarray
    line: np.ndarray
    tokens: np.ndarray
    cut: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.cut)

    def take(self, keep: np.ndarray) -> Lines:
        """Only the lines marked in ``keep``."""
        sizes = self.sizes
        return Lines(self.text[keep], self.line[keep], self.tokens[np.repeat(keep, sizes)], np.concatenate([[0], np.cumsum(sizes[keep])]))


def _words_of_lines(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Word hashes of all texts, and for each line its text, its number and where its words begin."""
    data, at = raw(column)
    breaks = np.flatnonzero(data == 10) + 1
    begin = np.unique(np.concatenate([at[:-1], breaks]))  # an empty text or line shares its begin with the next
    begin = np.append(begin[begin < len(data)], len(data))
    starts, ends = word_bounds(data, begin)
    text = np.searchsorted(at, begin[:-1], side="right") - 1
    line = np.searchsorted(breaks, begin[:-1], side="right") - np.searchsorted(breaks, at[text], side="right")
    return hashed(data, starts, ends), text, line, np.searchsorted(starts, begin)


def line_tokens(column: pa.Array, least: int, lines_wanted=None) -> Lines:
    """The lines of all texts of a batch with ``least`` distinct words and more, sorted and made distinct together.

    ``lines_wanted`` (text, line) leaves lines out before that.
    """
    hashes, text, line, cut = _words_of_lines(column)
    sizes = np.diff(cut)
    keep = sizes >= least
    if lines_wanted is not None:
        keep[keep] = lines_wanted(text[keep], line[keep])
    hashes, sizes, text, line = hashes[np.repeat(keep, sizes)], sizes[keep], text[keep], line[keep]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rough = (owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24))
    order = np.argsort(rough)
    tokens, rough = hashes[order], rough[order]
    if ((rough[1:] == rough[:-1]) & (tokens[1:] != tokens[:-1])).any():  # the upper bits tie
        order = np.lexsort((hashes, owner))
        tokens = hashes[order]
    fresh = np.ones(len(tokens), dtype=bool)  # owners stand in order in either case
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    count = np.bincount(owner[fresh], minlength=len(sizes))
    found = Lines(text, line, tokens[fresh], np.concatenate([[0], np.cumsum(count)]))
    return found.take(count >= least)


def line_key(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A 64-bit key of lines for the Bloom filter (equal keys of different lines only let a line pass it)."""
    x = doc.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + line.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    for whole in batches:
        for batch in slices(whole, "text"):
            yield batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text")


_LINES = "doc_id bigint, line int, key1 bigint, key2 bigint, counts binary"
_CHUNKS = 64


def _read_lines(least: int):
    """Every line with a 128-bit key of its token set; at the end of the task its counters, in chunks numbered as lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting = np.zeros(COUNTERS, dtype=np.int64), []
        for ids, texts in _parts(batches):
            x = line_tokens(texts, least)
            waiting.append((x.tokens % np.uint64(COUNTERS)).astype(np.uint32))
            if sum(map(len, waiting)) > COUNTERS:
                total += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                waiting.clear()
            sums = [np.add.reduceat(mixed(x.tokens ^ np.uint64(salt)), x.cut[:-1]).view(np.int64) if len(x.line) else np.zeros(0, np.int64) for salt in (0x51ED, 0xA3B7_0000_0001)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[x.text], pa.int64()), pa.array(x.line.astype(np.int32)), *map(pa.array, sums), pa.nulls(len(x.line), pa.binary())],
                                             ["doc_id", "line", "key1", "key2", "counts"])
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        none = pa.nulls(_CHUNKS, pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(range(_CHUNKS), pa.int32()), none, none, pa.array([zlib.compress(c.tobytes(), 1) for c in np.split(total, _CHUNKS)], pa.binary())],
                                         ["doc_id", "line", "key1", "key2", "counts"])
    return run


def _sum_chunk(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(COUNTERS // _CHUNKS, dtype=np.int64)
    for x in part["counts"]:
        total += np.frombuffer(zlib.decompress(x), np.int64)
    return pd.DataFrame({"line": [key[0]], "counts": [total.tobytes()]})


def rarity(read: DataFrame) -> np.ndarray:
    """The counters over all lines, as many whatever the corpus: 4 MB, capped at 2**32 - 1 each."""
    merged = read.where("counts IS NOT NULL").groupBy("line").applyInPandas(_sum_chunk, "line int, counts binary")
    out = np.zeros(COUNTERS, dtype=np.int64)
    for row in merged.collect():
        out[row.line * COUNTERS // _CHUNKS : (row.line + 1) * COUNTERS // _CHUNKS] = np.frombuffer(row.counts, np.int64)
    return np.minimum(out, 2**32 - 1).astype(np.uint32)


# of a token its upper half: tokens that share it in a part only meet in vain
_COLUMNS = (("token", np.uint32), ("doc", np.int64), ("line", np.uint32), ("n", np.uint32), ("pos", np.uint32), ("sketch1", np.uint64), ("sketch2", np.uint64), ("share", np.uint32), ("flags", np.uint8))
_RANDOM = ("token", "sketch1", "sketch2")  # of these columns nothing can be squeezed
_POSTINGS = "part int, " + ", ".join(f"{name} binary" for name, _ in _COLUMNS)
_OWN, _OPEN, _MORE = 1, 2, 4


def _squeezed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _loose(packed: pa.Buffer, rows: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, rows * np.dtype(kind).itemsize, codec="zstd"), kind)


def _postings(percent: int, least: int, parts: int, counters, hot: int, firsts):
    """Prefix tokens of the lines that are the first with their set (and by chance a few others), packed column by column for each part of the token space.

    ``firsts`` is the filter of those lines.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _parts(batches):
            x = line_tokens(texts, least, lambda text, line, ids=ids: probe(line_key(ids[text], line), *firsts()))
            x = x.take(100 * x.sizes >= percent * (x.sizes + 1))  # a smaller set is similar to its equals alone
            if not len(x.line):
                continue
            sizes, tokens = x.sizes, x.tokens
            owner = np.repeat(np.arange(len(sizes)), sizes)
            count = counters.value[(tokens % np.uint64(COUNTERS)).astype(np.int64)]
            # tokens stand in order within their line, so ties keep one order everywhere
            order = np.argsort((owner.astype(np.uint64) << np.uint64(32)) | count.astype(np.uint64), kind="stable")
            place = np.arange(len(tokens)) - x.cut[:-1][owner]
            place_bits = (tokens * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(57)  # one of 128
            bits = np.uint64(1) << (place_bits & np.uint64(63))
            sketch1, sketch2 = (np.bitwise_xor.reduceat(np.where(half, bits, np.uint64(0)), x.cut[:-1]) for half in (place_bits < 64, place_bits >= 64))
            keep = place < (sizes - (percent * sizes + 99) // 100 + 1)[owner]
            order, row, pos = order[keep], owner[keep], place[keep]
            token, count = tokens[order], count[order]
            # a hot token's line goes to every share of the token; it is indexed in its own
            shares = np.maximum(1, -(-count.astype(np.int64) // hot))
            copies = np.repeat(np.arange(len(token)), shares)
            share = np.arange(len(copies)) - np.repeat(np.cumsum(shares) - shares, shares)
            token, row, pos, shares = token[copies], row[copies], pos[copies], shares[copies]
            doc, keys = ids[x.text], line_key(ids[x.text], x.line)
            flags = (keys[row] % shares.astype(np.uint64) == share.astype(np.uint64)) * _OWN
            part = ((token + share.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(33)) % np.uint64(parts)
            by = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")  # 16 bits are sorted in linear time
            cuts = np.flatnonzero(np.diff(part[by], prepend=np.uint64(parts)))
            values = dict(token=token >> np.uint64(32), doc=doc[row], line=x.line[row], n=sizes[row], pos=pos, sketch1=sketch1[row], sketch2=sketch2[row], share=share, flags=flags)
            packed = ([v.tobytes() if name in _RANDOM else _squeezed(v) for v in np.split(values[name][by].astype(kind), cuts[1:])] for name, kind in _COLUMNS)
            yield pa.RecordBatch.from_arrays([pa.array(part[by][cuts].astype(np.int32)), *(pa.array(v, pa.binary()) for v in packed)], ["part", *(name for name, _ in _COLUMNS)])
    return run


def _alpha(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of two sets of these sizes that reaches the threshold."""
    return -(-(percent * (n + m)) // (100 + percent))


def _compare(x: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs (a indexed and earlier, b) pass the length, positional and sketch filters: their places; their sketch distance and the difference allowed."""
    some = np.flatnonzero(x["flags"][a] & _OWN)
    n, m = x["n"][a[some]].astype(np.int64), x["n"][b[some]].astype(np.int64)
    ok = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    some, n, m = some[ok], n[ok], m[ok]
    need = _alpha(n, m, percent)
    ok = np.minimum(n - x["pos"][a[some]], m - x["pos"][b[some]]) >= need
    some, allowed = some[ok], (n + m - 2 * need)[ok]
    a, b = a[some], b[some]
    apart = np.bitwise_count(x["sketch1"][a] ^ x["sketch1"][b]).astype(np.int64) + np.bitwise_count(x["sketch2"][a] ^ x["sketch2"][b])
    ok = (apart <= allowed) & ((x["doc"][a] != x["doc"][b]) | (x["line"][a] != x["line"][b]))
    return some[ok], apart[ok], allowed[ok]


def bucket_pairs(x: dict[str, np.ndarray], percent: int, all_of_open: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates of every posting of each (token, share) as positions in the sorted ``x``: pairs (a, b), and the b that have others.

    One for each b: the first earlier a at no more than three quarters of the allowed
    difference by its sketch, or else the nearest. With ``all_of_open`` all of the open b.
    """
    order = np.lexsort((x["line"], x["doc"], x["share"], x["token"]))
    x.update({k: v[order] for k, v in x.items()})
    fresh = np.flatnonzero((np.diff(x["token"], prepend=~x["token"][:1]) != 0) | (np.diff(x["share"], prepend=x["share"][:1]) != 0))
    sizes = np.diff(np.append(fresh, len(x["token"])))
    firsts, seconds, more = [], [], []
    small = (sizes > 1) & (sizes <= 256)
    starts, lengths = fresh[small], sizes[small]
    total = np.cumsum(lengths * (lengths - 1) // 2)
    i = 0
    while i < len(starts):  # all pairs of small buckets, some hundred thousand at a time
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + 300_000)))
        member = np.arange(lengths[i:j].sum()) - np.repeat(np.cumsum(lengths[i:j]) - lengths[i:j], lengths[i:j])  # b takes the a before it
        base = np.repeat(starts[i:j], lengths[i:j])
        if all_of_open:
            member = np.where(x["flags"][base + member] & _OPEN, member, 0)
            base = np.where(member > 0, base, 0)
        b = np.repeat(base + member, member)
        a = np.repeat(base, member) + np.arange(len(b)) - np.repeat(np.cumsum(member) - member, member)
        ok, apart, allowed = _compare(x, a, b, percent)
        a, b = a[ok], b[ok]
        if not all_of_open and len(b):
            near = 4 * apart <= 3 * allowed
            by = np.lexsort((a, np.where(near, 0, apart), ~near, b))
            a, b = a[by], b[by]
            first = np.diff(b, prepend=-1) != 0
            more.append(b[~first])
            a, b = a[first], b[first]
        firsts.append(a)
        seconds.append(b)
        i = j
    for start, size in zip(fresh[sizes > 256].tolist(), sizes[sizes > 256].tolist(), strict=True):
        alive = np.arange(start + 1, start + size)
        if all_of_open:
            alive = alive[x["flags"][alive] & _OPEN > 0]
        best, nearest, passed = np.full(size, -1), np.full(size, 1 << 30), np.zeros(size, dtype=np.int64)
        for a in range(start, start + size - 1):
            alive = alive[np.searchsorted(alive, a + 1) :]
            if not len(alive):
                break
            if not x["flags"][a] & _OWN:
                continue
            ok, apart, allowed = _compare(x, np.full(len(alive), a), alive, percent)
            if not len(ok):
                continue
            b = alive[ok]
            if all_of_open:
                firsts.append(np.full(len(b), a))
                seconds.append(b)
                continue
            k = b - start
            passed[k] += 1
            near = 4 * apart <= 3 * allowed
            apart = np.where(near, -1, apart)
            closer = apart < nearest[k]
            best[k[closer]], nearest[k[closer]] = a, apart[closer]
            passed[k[near]] += 1  # the rest is not looked at
            if near.any():
                alive = alive[~np.isin(alive, b[near], assume_unique=True)]
        if not all_of_open:
            found = np.flatnonzero(best >= 0)
            firsts.append(best[found])
            seconds.append(found + start)
            more.append(np.flatnonzero(passed > 1) + start)
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(firsts or empty), np.concatenate(seconds or empty), np.unique(np.concatenate(more or empty))


_BUCKET_ROWS = 200_000
_PAIRS = "doc_a bigint, line_a int, doc_b bigint, line_b int"


def _kept_buckets(x: dict[str, np.ndarray], more: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Of the sorted postings those of every bucket where a line has further candidates, whole buckets together: how many, and their columns.

    Only indexed lines and those with further candidates stay: others give no pair that is not examined yet.
    """
    if not len(more):
        return
    key = x["token"].astype(np.uint64) << np.uint64(32) | x["share"]
    bucket = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
    flags = x["flags"].copy()
    flags[more] |= _MORE
    wanted = np.zeros(bucket[-1] + 1, dtype=bool)
    wanted[bucket[more]] = True
    rows = np.flatnonzero(wanted[bucket] & (flags & (_OWN | _MORE) > 0))
    starts = np.flatnonzero(np.diff(bucket[rows], prepend=-1))
    _, first = np.unique(starts // _BUCKET_ROWS, return_index=True)
    cuts = starts[first]
    for part in np.split(rows, cuts[1:]):
        values = {**x, "flags": flags, "token": bucket, "share": np.broadcast_to(0, len(key))}
        yield len(part), _squeezed(np.concatenate([values[name][part].astype(kind).view(np.uint8) for name, kind in _COLUMNS]))


def _pairs_of(x: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = np.unique(np.stack([x["doc"][a], x["line"][a].astype(np.int64), x["doc"][b], x["line"][b].astype(np.int64)], axis=1), axis=0)
    for lo in range(0, len(rows), 100_000):
        part = rows[lo : lo + 100_000]
        yield _pair_batch(part[:, 0], part[:, 1], part[:, 2], part[:, 3])


def _candidates(percent: int):
    """Of the postings of one part: a candidate of every line; lines with more candidates (no first line), and the buckets where they have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[str, list] = {name: [] for name, _ in _COLUMNS}
        for batch in batches:
            rows = [len(v.as_buffer()) // 4 for v in batch.column("token")]
            for name, kind in _COLUMNS:
                blobs[name] += [np.frombuffer(v.as_buffer(), kind) if name in _RANDOM else _loose(v.as_buffer(), n, kind) for n, v in zip(rows, batch.column(name), strict=True)]
        if not blobs["token"]:
            return
        x = {name: np.concatenate(blobs.pop(name)) for name, _ in _COLUMNS}
        a, b, more = bucket_pairs(x, percent)
        yield from _pairs_of(x, a, b)
        left = np.unique(np.stack([x["doc"][more], x["line"][more].astype(np.int64)], axis=1), axis=0)
        for lo in range(0, len(left), 100_000):
            part = left[lo : lo + 100_000]
            yield _pair_batch(None, None, part[:, 0], part[:, 1])
        for rows, packed in _kept_buckets(x, more):
            yield _pair_batch(None, None, np.zeros(1, np.int64), np.zeros(1, np.int64), rows, packed)
    return run


def _all_candidates(percent: int, open_lines):
    """All candidates of the open lines, from the kept buckets; ``open_lines`` is their filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, packed in zip(batch.column("rows").to_pylist(), batch.column("buckets"), strict=True):
                data = _loose(packed.as_buffer(), rows * sum(np.dtype(kind).itemsize for _, kind in _COLUMNS), np.uint8)
                x, at = {}, 0
                for name, kind in _COLUMNS:
                    x[name], at = data[at : at + rows * np.dtype(kind).itemsize].view(kind), at + rows * np.dtype(kind).itemsize
                wanted = (x["flags"] & _MORE > 0) & probe(line_key(x["doc"], x["line"]), *open_lines())
                x["flags"] = x["flags"] & _OWN | wanted.astype(np.uint8) * _OPEN
                if wanted.any():
                    for out in _pairs_of(x, *bucket_pairs(x, percent, all_of_open=True)[:2]):
                        yield out.select(_columns_of(_PAIRS))
    return run


def _columns_of(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _pair_batch(doc_a, line_a, doc_b, line_b, rows=None, buckets=None) -> pa.RecordBatch:
    none = pa.nulls(len(doc_b), pa.int64())
    return pa.RecordBatch.from_arrays([
        none if doc_a is None else pa.array(doc_a), none.cast(pa.int32()) if line_a is None else pa.array(line_a.astype(np.int32)),
        pa.array(doc_b), pa.array(line_b.astype(np.int32)),
        pa.array([rows] * len(doc_b), pa.int64()), pa.array([buckets] * len(doc_b), pa.binary())], [*_columns_of(_PAIRS), "rows", "buckets"])


_ANY_LINE = 2**32 - 1


def _wanted_sets(wanted, least: int):
    """Token sets of the wanted lines; documents without any are not even read into words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ids = whole.column("doc_id").to_numpy()
            for ids, texts in _parts([whole.filter(pa.array(probe(line_key(ids, np.full(len(ids), _ANY_LINE)), *wanted())))]):
                x = line_tokens(texts, least, lambda text, line, ids=ids: probe(line_key(ids[text], line), *wanted()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[x.text], pa.int64()), pa.array(x.line.astype(np.int32)), pa.array([t.tobytes() for t in np.split(x.tokens, x.cut[1:-1])] if len(x.line) else [], pa.binary())],
                    ["doc_id", "line", "items"])
    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("doc_b", "line_b")], ["doc_id", "line"])
    return run


def _line_filter(doc, line):
    @F.pandas_udf("bigint")
    def key(d: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series(line_key(d.to_numpy(), k.to_numpy()).view(np.int64))
    return key(doc, line)


def _filter_of(keys: DataFrame, rows: int | None = None):
    """A Bloom filter of one column of keys, for tasks: call it there for its bits and slots."""
    bits, slots = bitmap_of(keys, keys.count() if rows is None else rows)
    sent = keys.sparkSession.sparkContext.broadcast(bits)
    return lambda: (sent.value, slots)


def sets_of_lines(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """(doc_id, line, items) of the wanted distinct lines (doc_id, line) and by chance of a few others. No other line leaves its task."""
    wanted = staged(wanted, "line-ends")
    ends = wanted.select("doc_id", F.col("line").cast("long")).unionByName(wanted.select("doc_id", F.lit(_ANY_LINE).cast("long").alias("line")).distinct())
    sets = docs.mapInArrow(frugal(_wanted_sets(_filter_of(ends.select(_line_filter(F.col("doc_id"), F.col("line")).alias("h"))), least)), "doc_id bigint, line int, items binary")
    return staged(sets, "line-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Lines (doc_id, line) of the pairs whose sets are similar. Rows that repeat a document repeat its sets and pairs."""
    first = sets.select(F.col("doc_id").alias("doc_a"), F.col("line").alias("line_a"), F.col("items").alias("set_a"))
    second = sets.select(F.col("doc_id").alias("doc_b"), F.col("line").alias("line_b"), F.col("items").alias("set_b"))
    rows = pairs.join(second, ["doc_b", "line_b"]).join(first, ["doc_a", "line_a"])
    return rows.select("doc_b", "line_b", "set_a", "set_b").mapInArrow(frugal(_similar(percent)), "doc_id bigint, line int").distinct()


def repeated_lines(docs: DataFrame, percent: int = PERCENT, hot_lines: int = HOT_LINES, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, line) of every line with a similar earlier line, from (doc_id: bigint, not null; text)."""
    spark = docs.sparkSession
    read = staged(docs.mapInArrow(frugal(_read_lines(min_tokens)), _LINES), "lines")
    counts = rarity(read)
    counters = spark.sparkContext.broadcast(counts)
    lines = read.where("counts IS NULL").drop("counts")
    firsts = staged(lines.groupBy("key1", "key2").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n")), "line-firsts")
    groups = firsts.where("n > 1").select("key1", "key2", "first")
    gone = staged(lines.join(groups, ["key1", "key2"]).where(F.struct("doc_id", "line") > F.col("first")).select("doc_id", "line").distinct(), "lines-equal")
    first_lines = firsts.count()
    first_filter = _filter_of(firsts.select(_line_filter(F.col("first.doc_id"), F.col("first.line").cast("long")).alias("h")), first_lines)
    prefixes = int(counts.astype(np.int64).sum()) * (100 - percent) // 100 + first_lines
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-prefixes // PART_POSTINGS))

    postings = docs.mapInArrow(frugal(_postings(percent, min_tokens, parts, counters, hot_lines, first_filter)), _POSTINGS)
    met = staged(postings.repartition(parts, "part").mapInArrow(frugal(_candidates(percent)), f"{_PAIRS}, rows bigint, buckets binary"), "line-pairs")

    def settle(pairs: DataFrame) -> DataFrame:
        pairs = staged(pairs.distinct(), "line-candidates")
        sets = sets_of_lines(docs, pairs.select("doc_a", "line_a").toDF("doc_id", "line").unionByName(pairs.select("doc_b", "line_b").toDF("doc_id", "line")).distinct(), min_tokens)
        return staged(gone.unionByName(_verified(pairs, sets, percent)).distinct(), "lines-gone")

    # a line settled by an equal one may still be in the filter of firsts by chance
    gone = settle(met.where("doc_a IS NOT NULL").select(*_columns_of(_PAIRS)).join(gone.toDF("doc_b", "line_b"), ["doc_b", "line_b"], "left_anti"))
    open_ = staged(met.where("doc_a IS NULL AND rows IS NULL").select("doc_b", "line_b").distinct().toDF("doc_id", "line").join(gone, ["doc_id", "line"], "left_anti"), "lines-open")
    if open_.isEmpty():
        return gone
    open_filter = _filter_of(open_.select(_line_filter(F.col("doc_id"), F.col("line").cast("long")).alias("h")))
    further = staged(met.where("rows IS NOT NULL").select("rows", "buckets").mapInArrow(frugal(_all_candidates(percent, open_filter)), _PAIRS), "line-pairs")
    return settle(further.join(open_.toDF("doc_b", "line_b"), ["doc_b", "line_b"], "left_semi"))


def _one_text_an_id(rows: DataFrame) -> DataFrame:
    """``rows`` (id, hash, ...) with ``mine``: false for the rows whose id another text holds (the one of the smallest hash keeps it)."""
    spark = rows.sparkSession
    texts = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("hash").alias("chosen"), F.max("hash").alias("other"))
    shared = staged(texts.where("chosen <> other").select("id", "chosen"), "lines-shared-ids")
    n = shared.count()
    if not n:
        return rows.withColumn("mine", F.lit(True))
    bits, slots = bitmap_of(shared.select(F.xxhash64("id").alias("h")), n)
    marked = rows.withColumn("maybe", passes(spark, F.xxhash64("id"), bits, slots))
    alone = marked.where("NOT maybe").withColumn("mine", F.lit(True)).drop("maybe")
    met = marked.where("maybe").join(shared, "id", "left").withColumn("mine", F.expr("chosen IS NULL OR hash = chosen")).drop("maybe", "chosen")
    return alone.unionByName(met)


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """All columns of ``docs`` with the text without its repeated lines, and ``n_lines``, ``n_removed``.

    Lines end at a line feed. Rows that repeat an id and its text are one document, and none of its
    lines counts as earlier than itself. Where an id stands with different texts, the text of the smallest hash
    is that document; rows with another one keep their text. A row with a null id takes no part and keeps its
    text, as do null (0 lines) and empty texts (1 line). Long texts take part whole. A document may lose all its
    lines; its text is then empty. An empty table gives an empty result. Input columns named n_lines or n_removed
    are replaced; others, whatever their names, are passed through.
    """
    spark = docs.sparkSession
    at, kept = {c: f"c{i}" for i, c in enumerate(docs.columns)}, [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text = F.col(at[text_column]).cast("string")
    rows = docs.toDF(*at.values()).withColumn("id", F.col(at[id_column]).cast("long")).withColumn("hash", F.xxhash64(F.coalesce(text, F.lit(""))))
    rows = _one_text_an_id(rows)
    gone = repeated_lines(rows.where("mine AND id IS NOT NULL").select(F.col("id").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")), percent, min_tokens=min_tokens)
    per_doc = staged(gone.groupBy("doc_id").agg(F.collect_set("line").alias("gone")).withColumnRenamed("doc_id", "doc"), "lines-by-doc")
    bits, slots = bitmap_of(per_doc.select(F.xxhash64("doc").alias("h")), per_doc.count())
    maybe = passes(spark, F.xxhash64("id"), bits, slots) & F.col("mine")

    @F.pandas_udf("string")
    def without(texts: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for text, numbers in zip(texts, removed, strict=True):
            drop = set() if numbers is None else set(numbers.tolist())
            out.append(text if text is None or not drop else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop))
        return pd.Series(out, dtype=object)

    lines = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("int")
    counted = rows.withColumn("n_lines", lines).withColumn("maybe", maybe)
    whole = counted.where("NOT maybe").withColumn("n_removed", F.lit(0))
    # the numbers grow with the corpus: merged at every size, never broadcast
    cut = counted.where("maybe").join(per_doc.hint("merge"), F.col("id") == F.col("doc"), "left")
    cut = cut.withColumn(at[text_column], without(text, F.col("gone"))).withColumn("n_removed", F.coalesce(F.size("gone"), F.lit(0)))
    result = [*(at[c] for c in kept), "n_lines", "n_removed"]
    return whole.withColumn(at[text_column], text).select(*result).unionByName(cut.select(*result)).toDF(*kept, "n_lines", "n_removed")
