"""Word arrays, Bloom filters, trees: the helpers that several operators share."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sousflow.llm.bloom import bitmap_of, probe
from sousflow.llm.common import slices
from sousflow.llm.trees import boost, classify
from sousflow.llm.words import shingle_sets, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b z", max_size=40)), max_size=12)


def brute_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    hashes, at = words(pa.array(texts, pa.string()))
    want = [brute_words(t) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in want]
    flat = [w for t in want for w in t]
    # equal words have equal hashes, different ones different hashes
    assert len({(w, h) for w, h in zip(flat, hashes.tolist())}) == len(set(flat)) == len(set(hashes.tolist()))


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_are_the_distinct_runs(texts, size):
    found = shingle_sets(*words(pa.array(texts, pa.string())), size)
    for text, got in zip(texts, found, strict=True):
        w = brute_words(text)
        want = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        assert len(got) == len(want) and np.all(np.diff(got.astype(object)) > 0)


def test_slices_cover_a_batch_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 100, "", "c"])], ["text"])
    parts = list(slices(batch, "text", 20))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(p.num_rows for p in parts) < 5
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_filter_never_misses_a_key(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS h")
    bits, slots = bitmap_of(keys, 3000)
    own = np.array([r.h for r in keys.collect()]).view(np.uint64)
    assert probe(own, bits, slots).all()
    other = np.array([r.h for r in spark.range(10**6, 10**6 + 20000).selectExpr("xxhash64(id) AS h").collect()]).view(np.uint64)
    assert probe(other, bits, slots).mean() < 0.01
    twice, slots = bitmap_of(keys.unionByName(keys.limit(50)), 3050, least=2)
    assert probe(np.array([r.h for r in keys.limit(50).collect()]).view(np.uint64), twice, slots).sum() >= 50 - 0
    assert probe(own, twice, slots).mean() < 0.1


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float)
    assert ((classify(x, y, 6).predict(x) >= 0.5) == y).mean() > 0.97
    model = boost(x, y, 30, 3, 0.3)
    p = model.probability(x)
    assert ((p >= 0.5) == y).mean() > 0.97 and 0 <= p.min() and p.max() <= 1
