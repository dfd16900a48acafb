"""Target-distribution resampling against a plain version; the automaton's payloads and CRC composition."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sousflow.llm.op13_importance_resampling import CrcShift, Scanner, features_of, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)], len(words)


def plainly(docs, target, percent=10, buckets=10_000, n=1, least=20, seed=2024):
    cell = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(cell(f) for _, x in rows for f in features(x, n)[0]) for rows in (docs, [(0, x) for x in target]))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for i, x in docs:
        f, words = features(x, n)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(cell(y)) for y in f)
        out.append([i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = place
    return sorted((tuple(r) for r in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


def corpus(n, seed=3):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdeéß漢0123", k=rnd.randint(1, 7))) for _ in range(400)]
    seps = [" ", "  ", ", ", "\n", "-", "\x7f", "'"]
    return [(i, "".join(w.upper() * (rnd.random() < 0.2) or w for w in (rnd.choice(vocabulary) + rnd.choice(seps) for _ in range(rnd.randint(0, 60))))) for i in range(n)]


@pytest.mark.parametrize("n,capacity", [(1, 1 << 17), (1, 0), (2, 50), (3, 1 << 17)])
def test_equals_plain_version(spark, n, capacity):
    docs = corpus(300) + [(900, None), (901, ""), (902, " .,;\n"), (903, "A" * 100_000 + " word"), (904, "tail words " * 30_000), (None, "some words here " * 9), (None, None)]
    target = [x for _, x in corpus(30, seed=4)] + [None, ""]
    df = resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame([(x,) for x in target], "text string"),
                  max_words=n, dictionary_words=capacity, percent=30)
    assert got(df) == plainly(docs, target, n=n, percent=30)


def test_repeated_rows_ties_and_hot_score(spark):
    docs = [(7, "alpha beta " * 15)] * 60 + [(i, "gamma delta " * 12) for i in range(100, 200)]
    target = ["alpha beta"]
    df = resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(x,) for x in target], "text string"), percent=50)
    assert got(df) == plainly(docs, target, percent=50)


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], "text string")
    docs = corpus(40)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("rank", "score", "_h", "_text", "buckets", "n_words", "_row")})
    assert got(resample(df, none)) == plainly(docs, [])
    assert resample(df.limit(0), none).count() == 0


def test_few_and_many_buckets(spark):
    docs, target = corpus(60), [x for _, x in corpus(10, seed=9)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(x,) for x in target], "text string")
    for buckets in (1, 7, 100_000):
        assert got(resample(*frames, buckets=buckets, percent=20)) == plainly(docs, target, buckets=buckets, percent=20)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB1 .é\n漢", max_size=30), max_size=5), st.integers(1, 4), st.sampled_from([0, 2, 1000]))
def test_features_of_any_texts(texts, n, capacity):
    scanner, shift = Scanner(capacity), CrcShift()
    for _ in range(2):  # the second time with a dictionary from the first
        crcs, counts, words = features_of(pa.array(texts, pa.string()), scanner, shift, n)
        ends = np.concatenate([[0], np.cumsum(counts)])
        assert words.tolist() == [features(t, 1)[1] for t in texts]
        for i, t in enumerate(texts):
            assert sorted(crcs[ends[i] : ends[i + 1]].tolist()) == sorted(zlib.crc32(f.encode()) for f in features(t, n)[0])


@given(st.binary(max_size=40), st.binary(max_size=200))
def test_crc_of_adjacent_strings(a, b):
    one = lambda x, kind: np.array([x], dtype=kind)
    joined = CrcShift().join(one(zlib.crc32(a), np.uint32), one(zlib.crc32(b), np.uint32), one(len(b), np.int64))
    assert joined.tolist() == [zlib.crc32(a + b)]


def test_dictionary_learns_unknown_words():
    scanner = Scanner()
    text = lambda words: pa.array([" ".join(words)])
    features_of(text(["first", "words"]), scanner, CrcShift(), 1)
    many = [f"w{i}" for i in range(5000)]
    crcs, _, _ = features_of(text([*many, "first"]), scanner, CrcShift(), 1)
    assert crcs.tolist() == [zlib.crc32(w.encode()) for w in [*many, "first"]]
    assert len(scanner.words) == 5002 and scanner.words["w4999"] == (zlib.crc32(b"w4999"), 5)
