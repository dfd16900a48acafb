"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its distinct words hashed into ``WORD_BUCKETS`` (each weighted by
one over the root of their number), and its structure statistics and metadata, each cut at
quantiles of the training sample into one-hot bins. The machine scores
w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j in linear time, as half the difference of
the square of the sum and the sum of the squares of the factors.

It is fitted on at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash of their
id; everything is scored. Language, source, id and labels are no features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_key, frugal, slices, text_of
from .words import hashed, raw, word_bounds

WORD_BUCKETS = 1 << 15
RANK, BINS = 8, 16
#: Bound of the training sample, which the driver holds.
TRAIN_ROWS = 10_000
THRESHOLD = 0.3

_UPPER, _LOWER, _DIGIT, _END, _SYMBOL, _LINE, _BAR, _OTHER = range(8)
_CLASS = np.full(256, _SYMBOL, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _OTHER
_CLASS[[33, 44, 46, 58, 59, 63]] = _END
_CLASS[10], _CLASS[124], _CLASS[[32, 9, 11, 12, 13]] = _LINE, _BAR, _OTHER
STATISTICS = ("log_words", "log_bytes", "word_bytes", "distinct", "repeats", "upper", "digit", "end", "symbol", "bar", "other",
              "words_per_line", "capital_words", "ended_words", "short_words", "top_word")


def document_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets of all texts in order, where each text's begin, and one row of statistics per text."""
    data, at = raw(column)
    starts, ends = word_bounds(data, at)
    hashes = hashed(data, starts, ends)
    cut = np.searchsorted(starts, at)
    kinds = _CLASS[data]
    counts = np.stack([np.diff(np.concatenate([[0], np.cumsum(kinds == k)])[at]) for k in range(8)], axis=1).astype(float)
    per_word = np.stack([kinds[starts] == _UPPER, kinds[ends - 1] == _END, ends - starts <= 2], axis=1) if len(starts) else np.zeros((0, 3), bool)
    sums = np.vstack([np.zeros((1, 3)), np.cumsum(per_word, axis=0)])
    per_word = np.diff(sums[cut], axis=0)
    same = np.concatenate([[0], np.cumsum(np.concatenate([[False], hashes[1:] == hashes[:-1]]))]) if len(hashes) else np.zeros(1)
    n, size = np.diff(cut).astype(float), np.diff(at).astype(float)
    buckets, begin, distinct, top = [], [0], np.zeros(len(n)), np.zeros(len(n))
    for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if b > a:
            values, times = np.unique(hashes[a:b], return_counts=True)
            distinct[i], top[i] = len(values), times.max()
            buckets.append(np.unique((values >> np.uint64(40)) % np.uint64(WORD_BUCKETS)).astype(np.int32))
            begin.append(begin[-1] + len(buckets[-1]))
        else:
            begin.append(begin[-1])
    w, c = np.maximum(n, 1), np.maximum(size, 1)[:, None]
    repeats = np.maximum(same[cut[1:]] - same[np.minimum(cut[:-1] + 1, len(same) - 1)], 0)
    share = counts / c
    stats = np.column_stack([
        np.log1p(n), np.log1p(size), (size - n) / w, distinct / w, repeats / w, share[:, [_UPPER, _DIGIT, _END, _SYMBOL, _BAR, _OTHER]],
        w / (counts[:, _LINE] + 1), per_word / w[:, None], top / w])
    return np.concatenate(buckets) if buckets else np.zeros(0, np.int32), np.array(begin), stats


@dataclass(frozen=True)
class Machine:
    """The fitted machine; ``edges`` cut the statistics and metadata into bins."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, buckets: np.ndarray, begin: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each document."""
        index, value, at = _inputs(self.edges, buckets, begin, numbers)
        return 1 / (1 + np.exp(-np.clip(_raw_score(self.bias, self.weights, self.factors, index, value, at)[0], -30, 30)))


def _inputs(edges: np.ndarray, buckets: np.ndarray, begin: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature indices, values and offsets: each document's bins, then its words. A missing number has a bin of its own."""
    k, n = numbers.shape[1], len(numbers)
    bins = np.stack([np.searchsorted(edges[j], numbers[:, j]) for j in range(k)], axis=1)
    bins = np.where(np.isnan(numbers), BINS, bins) + np.arange(k) * (BINS + 1) + WORD_BUCKETS
    words = np.diff(begin)
    at = np.concatenate([[0], np.cumsum(words + k)])
    index, value = np.empty(at[-1], np.int64), np.empty(at[-1], np.float32)
    place = at[:-1, None] + np.arange(k)
    index[place], value[place] = bins, 1.0
    rest = np.ones(at[-1], bool)
    rest[place] = False
    index[rest], value[rest] = buckets, np.repeat(1 / np.sqrt(np.maximum(words, 1)), words)
    return index, value, at[:-1] if n else np.zeros(0, np.int64)


def _raw_score(bias, weights, factors, index, value, at):
    """Scores, and the per-document factor sums that the gradient needs."""
    if not len(at):
        return np.zeros(0), np.zeros((0, factors.shape[1])), None
    vx = factors[index] * value[:, None]
    total = np.add.reduceat(vx, at, axis=0)
    pairs = 0.5 * (total**2 - np.add.reduceat(vx**2, at, axis=0)).sum(axis=1)  # the sum-of-squares identity
    return bias + np.add.reduceat(weights[index] * value, at) + pairs, total, vx


def fit(buckets: np.ndarray, begin: np.ndarray, numbers: np.ndarray, label: np.ndarray,
        steps: int = 320, rate: float = 0.05, decay: float = 1e-5, seed: int = 5) -> Machine:
    """Fit by AdaGrad on the logistic loss, in a fixed shuffled order: at least ``steps`` batches of a fortieth of the rows."""
    k = numbers.shape[1]
    edges = np.stack([np.quantile(col[~np.isnan(col)], np.linspace(0, 1, BINS + 1)[1:-1]) if (~np.isnan(col)).any() else np.zeros(BINS - 1) for col in numbers.T]) if len(numbers) else np.zeros((k, BINS - 1))
    size, rng = WORD_BUCKETS + k * (BINS + 1), np.random.default_rng(seed)
    weights, factors, bias = np.zeros(size, np.float32), rng.normal(0, 0.05, (size, RANK)).astype(np.float32), 0.0
    if not len(label):
        return Machine(edges, bias, weights, factors)
    gw, gv, gb = np.full(size, 1e-6, np.float32), np.full((size, RANK), 1e-6, np.float32), 1e-6
    starts, lengths = begin[:-1], np.diff(begin)
    batch = max(16, len(label) // 40)
    for _ in range(-(-steps * batch // len(label))):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), batch):
            rows = order[lo : lo + batch]
            own = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[rows], lengths[rows], strict=True)])
            index, value, at = _inputs(edges, buckets[own], np.concatenate([[0], np.cumsum(lengths[rows])]), numbers[rows])
            score, total, vx = _raw_score(bias, weights, factors, index, value, at)
            error = ((1 / (1 + np.exp(-np.clip(score, -30, 30))) - label[rows]) / len(rows)).astype(np.float32)
            each = np.repeat(np.arange(len(rows)), np.diff(np.append(at, len(index))))
            e = error[each] * value
            used, back = np.unique(index, return_inverse=True)
            dw = np.bincount(back, e, len(used)).astype(np.float32) + decay * weights[used]
            dv = np.stack([np.bincount(back, e * (total[each, f] - vx[:, f]), len(used)) for f in range(RANK)], axis=1).astype(np.float32) + decay * factors[used]
            gw[used] += dw**2
            gv[used] += dv**2
            gb += float(error.sum()) ** 2
            weights[used] -= rate * dw / np.sqrt(gw[used])
            factors[used] -= rate * dv / np.sqrt(gv[used])
            bias -= rate * float(error.sum()) / gb**0.5
    return Machine(edges, bias, weights, factors)


def _numbers(docs: DataFrame, metadata: tuple[str, ...]):
    """Metadata columns as one array of doubles, null where a column is missing, null or no number."""
    return F.array(*(F.expr(f"try_cast(`{c}` AS double)") if c in docs.columns else F.lit(None).cast("double") for c in metadata))


def _with_metadata(stats: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    extra = np.array([[np.nan if v is None else np.sign(v) * np.log1p(abs(v)) for v in row] for row in batch.column("numbers").to_pylist()], dtype=float)
    return np.hstack([stats, extra]) if extra.size else stats


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            buckets, begin, stats = document_features(batch.column("text"))
            numbers = _with_metadata(stats, batch)
            yield pa.RecordBatch.from_arrays([
                pa.array([buckets[a:b].astype(np.uint16).tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)], pa.binary()),
                pa.array([x.tobytes() for x in numbers], pa.binary()), batch.column("label")], ["words", "numbers", "label"])


def train(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",), train_rows: int = TRAIN_ROWS, folds: int = 5) -> Machine:
    """Fit on labelled documents outside fold 0 of ``folds``, at most ``train_rows`` of them."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    sample = known.where(F.pmod(doc_key(F.col("doc_id")), F.lit(folds)) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), _numbers(docs, metadata).alias("numbers"))
    # the sample's ids are bounded by train_rows
    rows = texts.join(F.broadcast(sample), "doc_id").select("text", "numbers", "label").mapInArrow(frugal(_features), "words binary, numbers binary, label int")
    rows = rows.toArrow().sort_by([("label", "ascending"), ("numbers", "ascending"), ("words", "ascending")])  # the order of tasks must not matter
    parts = [np.frombuffer(x, np.uint16).astype(np.int32) for x in rows.column("words").to_pylist()]
    k = len(STATISTICS) + len(metadata)
    numbers = np.array([np.frombuffer(x, float) for x in rows.column("numbers").to_pylist()]).reshape(-1, k)
    begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return fit(np.concatenate(parts) if parts else np.zeros(0, np.int32), begin, numbers, rows.column("label").to_numpy().astype(np.float32))


def score_quality(docs: DataFrame, machine: Machine, metadata: tuple[str, ...] = ("n_chars",), keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those of ``keep``) and ``quality_score``: the probability of label 1, for every row."""
    keep = [c for c in docs.columns if c != "quality_score"] if keep is None else keep
    names = [f"c{i}" for i in range(len(keep))]  # no column of the caller's can clash
    # a text that is kept goes to the task once
    text = names[keep.index("text")] if "text" in keep and docs.schema["text"].dataType == T.StringType() else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                buckets, begin, stats = document_features(batch.column(text))
                score = machine.score(buckets, begin, _with_metadata(stats, batch))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(score, pa.float64())], [*names, "quality_score"])

    rows = docs.select(*(docs[c].alias(n) for c, n in zip(keep, names, strict=True)), *([text_of(docs).alias("text")] if text == "text" else []), _numbers(docs, metadata).alias("numbers"))
    out = T.StructType([*(T.StructField(n, docs.schema[c].dataType) for c, n in zip(keep, names, strict=True)), T.StructField("quality_score", T.DoubleType())])
    return rows.mapInArrow(frugal(run), out).toDF(*keep, "quality_score")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    A null or empty text is scored by its (zero) statistics; a null id counts as empty text
    for its fold. Labels of unknown documents, null labels and values other than 0 and 1 are
    not learned; of repeated labels the larger counts. Without labels every score is near 0.5.
    """
    machine = train(docs, labels, folds=folds)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], *([docs["n_chars"]] if "n_chars" in docs.columns else []))
    scored = score_quality(rows, machine, keep=["doc_id"]).select("doc_id", F.col("quality_score").alias("score"))
    return scored.select("doc_id", (F.pmod(doc_key(F.col("doc_id")), F.lit(folds)) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
