"""Exact, line and near dedup and fingerprints against brute force."""

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sousflow.llm import op2_line_dedup
from sousflow.llm.bloom import _positions
from sousflow.llm.common import shared_folder
from sousflow.llm.op1_exact_dedup import exact_dedup
from sousflow.llm.op2_line_dedup import _COLUMNS, bucket_pairs, line_dedup, repeated_lines
from sousflow.llm.op3_fingerprints import edited, fingerprint_groups, fingerprints
from sousflow.llm.op7_minhash_near_dedup import near_duplicates

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets_of(rows, size):
    out = {}
    for d, t in rows:
        w = words_of(t)
        out[d] = frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    return out


def brute_components(rows, size, percent=80):
    sets = sets_of(rows, size)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def corpus(seed, n=120):
    """Texts of several lines with exact copies, near copies around the threshold, short and odd texts."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]

    def text():
        return "\n".join(" ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 4, 6, 12, 40]))) for _ in range(rnd.randint(1, 5)))

    rows = []
    for _ in range(n):
        kind = rnd.random()
        if rows and kind < 0.15:
            t = rnd.choice(rows)
        elif rows and kind < 0.6:
            words = re.split(r"(\s)", rnd.choice(rows[:10]))
            rate = rnd.choice([0.01, 0.03, 0.06, 0.1])
            t = "".join(rnd.choice(vocab) if w.strip() and rnd.random() < rate else w for w in words)
        else:
            t = text()
        rows.append(t)
    rows += ["", None, " \n\t", "One TWO three", "one two THREE", "x", "é ü", "a b c d e f\na b c d e f"]
    ids = rnd.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOCS)


@pytest.mark.parametrize("per_filter", [1 << 25, 20])
def test_exact_dedup(spark, per_filter):
    rows = corpus(1)
    got = {r.doc_id: r for r in exact_dedup(frame(spark, rows), keys_per_filter=per_filter).collect()}
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    assert len(got) == len(rows)
    for d, t in rows:
        same = groups[t or ""]
        assert (got[d].keep_id, got[d].group_size, got[d].kept) == (max(same), len(same), d == max(same))


def test_exact_dedup_edges(spark):
    assert exact_dedup(frame(spark, [(1, "a")]).limit(0)).count() == 0
    clash = frame(spark, [(None, "a"), (3, "a"), (3, "a"), (None, None)]).withColumns({"keep_id": F.lit(9), "h": F.lit("h"), "part": F.lit(1)})
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact_dedup(clash).collect())
    assert got == [(-1, -1, 1, True), (-1, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True)]


@pytest.mark.parametrize("seed,size", [(2, 2), (3, 5)])
def test_near_duplicates(spark, seed, size):
    rows = corpus(seed)
    want = brute_components(rows, size)
    got = {r.doc_id: r for r in near_duplicates(frame(spark, rows), shingle_words=size).collect()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (d == r.component_id) for d, r in got.items())


def test_near_duplicates_edges(spark):
    assert near_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0
    text = " ".join(f"t{i}" for i in range(30))
    rows = near_duplicates(frame(spark, [(None, text), (5, text), (5, text), (4, text + " more"), (6, None)]).withColumn("cls", F.lit(1))).collect()
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows)
    assert got == [(-1, -1, True), (4, 4, True), (5, 4, False), (5, 4, False), (6, 6, True)]


def brute_lines(rows, percent=80):
    lines = [(d, k, frozenset(words_of(x))) for d, t in sorted(rows, key=lambda r: r[0]) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    return {(d, k) for i, (d, k, s) in enumerate(lines) if any(100 * len(s & z) >= percent * len(s | z) for *_, z in lines[:i])}


@pytest.mark.parametrize("seed,hot", [(4, 50_000), (5, 7)])
def test_repeated_lines(spark, seed, hot):
    rows = corpus(seed)
    docs = frame(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert {(r.doc_id, r.line) for r in repeated_lines(docs, hot_lines=hot).collect()} == brute_lines(rows)


def test_texts_are_read_once_for_prefixes(spark, monkeypatch):
    calls = []
    for name in ("_postings", "_wanted_sets"):
        whole = getattr(op2_line_dedup, name)
        monkeypatch.setattr(op2_line_dedup, name, lambda *a, whole=whole, name=name: calls.append(name) or whole(*a))
    rows = []
    for k in range(150):  # the first two lines look as near to the last by their sketches in some of these, but only the second is similar
        line, often = [f"w{k}x{i}" for i in range(17)], [f"often{(7 * k + i) % 40}" for i in range(8)]
        rows += [(3 * k + j, " ".join([*line, *often[at : at + 3]])) for j, at in enumerate((5, 2, 0))]
    docs = frame(spark, rows).select("doc_id", "text")
    gone = {(r.doc_id, r.line) for r in repeated_lines(docs).collect()}
    assert gone == brute_lines(rows) and len(gone) == 150
    assert sorted(calls) == ["_postings", "_wanted_sets", "_wanted_sets"]  # a second round, but no second reading for prefixes


@pytest.mark.parametrize("rows", [3, 200_000])
def test_kept_buckets_give_all_further_candidates(monkeypatch, rows):
    monkeypatch.setattr(op2_line_dedup, "_BUCKET_ROWS", rows)
    rng = np.random.default_rng(8)
    x = {name: np.zeros(900, kind) for name, kind in _COLUMNS}
    x["token"] = np.repeat(np.arange(61, dtype=np.uint32), [300, *[10] * 60])
    x["doc"], x["n"] = rng.integers(0, 150, 900), rng.integers(18, 23, 900).astype(np.uint32)
    x["sketch1"] = np.uint64(1) << rng.integers(0, 12, 900).astype(np.uint64)
    x["flags"] = (rng.random(900) < 0.7).astype(np.uint8)
    y = {k: v.copy() for k, v in x.items()}
    y["flags"] |= 2  # all lines are open
    a, b, _ = bucket_pairs(y, 80, all_of_open=True)
    want = {*zip(y["doc"][a].tolist(), y["doc"][b].tolist(), strict=True)}
    a, b, more = bucket_pairs(x, 80)
    got = {*zip(x["doc"][a].tolist(), x["doc"][b].tolist(), strict=True)}
    kept = [*op2_line_dedup._kept_buckets(x, more)]
    assert len(kept) > 30 if rows == 3 else len(kept) == 1
    keys = op2_line_dedup.line_key(x["doc"], x["line"])
    bits = np.zeros(1 << 16, dtype=bool)
    bits[_positions(keys, 1 << 16)] = True
    batch = pa.RecordBatch.from_arrays([pa.array([n for n, _ in kept]), pa.array([p for _, p in kept], pa.binary())], ["rows", "buckets"])
    for out in op2_line_dedup._all_candidates(80, lambda: (np.packbits(bits), 1 << 16))(iter([batch])):
        got |= {*zip(out.column("doc_a").to_pylist(), out.column("doc_b").to_pylist(), strict=True)}
    assert got == want and len(want) > 1000


def test_short_lines_take_part(spark, tmp_path):
    from sousflow.llm.queries import op2_line_dedup

    rows = [*corpus(9, 60), (20_000, "Read more\na b c d\nx"), (20_001, "read MORE\na b c d e\ny"), (20_002, "more\nna na na na na na\nx x"), (20_003, "na")]
    lines = [(d, k, frozenset(words_of(x))) for d, t in sorted(rows) for k, x in enumerate((t or "").split("\n")) if words_of(x)]
    gone = {(d, k) for i, (d, k, s) in enumerate(lines) if any(100 * len(s & z) >= 80 * len(s | z) for *_, z in lines[:i])}
    assert {(20_001, 0), (20_001, 1), (20_002, 2), (20_003, 0)} <= gone
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {d: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}


def test_line_dedup_texts_and_edges(spark):
    rows = corpus(6, 40)
    gone = brute_lines(rows)
    docs = frame(spark, rows).withColumns({"n_lines": F.lit("clash"), "line": F.lit(1)})
    got = {r.doc_id: r for r in line_dedup(docs).collect()}
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for k, x in enumerate(lines) if (d, k) not in gone]
        assert got[d].text == (None if t is None else "\n".join(kept)) and got[d].n_removed == len(lines) - len(kept)
    assert line_dedup(docs.limit(0)).count() == 0
    long = " ".join(f"u{i}" for i in range(3000))
    odd = line_dedup(frame(spark, [(None, long), (2, long), (2, long), (3, long + " x")])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in odd) == [(-1, 0), (2, 0), (2, 0), (3, 1)]


def test_large_buckets_agree_with_small_ones():
    rng = np.random.default_rng(3)
    n = 400
    x = {name: np.zeros(n, kind) for name, kind in _COLUMNS}
    x["doc"], x["n"], x["flags"] = np.arange(n), np.full(n, 20, np.uint32), np.full(n, 3, np.uint8)
    x["sketch1"] = np.uint64(1) << rng.integers(0, 12, n).astype(np.uint64)
    one = bucket_pairs({k: v.copy() for k, v in x.items()}, 80, all_of_open=True)
    parts = bucket_pairs({k: v[:200].copy() for k, v in x.items()}, 80, all_of_open=True)
    first = {(a, b) for a, b in zip(*(v.tolist() for v in one[:2])) if b < 200}
    assert first == set(zip(*(v.tolist() for v in parts[:2]))) and len(first) == 200 * 199 // 2


def test_fingerprints(spark):
    rows = corpus(7, 60)
    order = sorted(rows, key=lambda r: r[0])
    got = {r.doc_id: r for r in fingerprints(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    import hashlib

    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        changed = edited(t, after)
        assert changed == t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        a, b, c = (sets_of([(0, z)], 5)[0] for z in (t, changed, after))
        for estimate, other in ((r.near_edited, b), (r.near_next, c)):
            true = len(a & other) / len(a | other) if a | other else 1.0
            assert abs(estimate - true) < 0.15
    texts = {r.fingerprint for r in got.values()}
    assert len(texts) == len(set(sets_of(rows, 5).values()))


def test_fingerprint_edges(spark):
    assert fingerprints(frame(spark, [(1, "a")]).limit(0)).count() == 0
    one = fingerprints(frame(spark, [(1, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    big = 2**62 + 1
    odd = sorted((r.doc_id or -1, r.near_next) for r in fingerprints(frame(spark, [(big, None), (None, "a"), (big, ""), (3, "q")])).collect())
    assert [d for d, _ in odd] == [-1, 3, big, big] and odd[2][1] + odd[3][1] == 1.0


def test_fingerprints_shuffle_squeezed_texts_and_keep_no_bands(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    docs = frame(spark, [(i, f"word{i} and some more words of text {i % 4} " * 5) for i in range(30)] + [(None, "x"), (30, None), (31, "")])
    groups = fingerprint_groups(docs)
    assert [x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before if "-" in x and not x.startswith("rdd-")] == ["print-groups"]
    out = fingerprints(docs, groups=groups)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Sort [") < plan.index("_squeezed")  # texts are squeezed before they are dealt
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0]))
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in out.collect()}
    assert got == {d: (len(t), hashlib.sha256(edited(t, rows[(k + 1) % len(rows)][1]).encode()).hexdigest()) for k, (d, t) in enumerate(rows)}


def test_fingerprint_groups(spark):
    rows = corpus(8, 80)
    want = brute_components(rows, 5)
    got = {r.doc_id: r for r in fingerprint_groups(frame(spark, rows)).collect()}
    assert {d: r.group_id for d, r in got.items()} == {d: c for d, (_, c) in want.items()}


def test_fingerprints_query_with_groups(spark, tmp_path):
    """The query's class and group equal brute force over all pairs, next to the same fingerprints as without them."""
    from sousflow.llm.queries import op3_fingerprints

    rows = corpus(9, 120)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute_components(rows, 5)
    got = {r.doc_id: r for r in op3_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) and {d: r.group_id for d, r in got.items()} == {d: c for d, (_, c) in want.items()}
    sets = sets_of(rows, 5)
    least = {}
    for d in sorted(sets):
        least.setdefault(sets[d] or d, d)
    assert {d: r.class_id for d, r in got.items()} == {d: least[sets[d] or d] for d in sets}
    alone = {r.doc_id: (r.n_chars, r.fingerprint, r.near_edited, r.near_next) for r in fingerprints(frame(spark, rows)).collect()}
    assert alone == {d: (r.n_chars, r.fingerprint, r.near_edited, r.near_next) for d, r in got.items()}


def test_fingerprints_with_groups_edges(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = frame(spark, [(None, "a b c d e f"), (2, "a b c d e f"), (2, long), (3, None), (4, long + " end"), (5, "a b c d e f")])
    docs = docs.withColumns({c: F.lit("old") for c in ("part", "tail", "class_id", "group_id", "th", "set_key", "cls")})
    got = sorted((r.doc_id or 0, r.n_chars, r.class_id, r.group_id) for r in fingerprints(docs, groups=fingerprint_groups(docs)).collect())
    assert [g[0] for g in got] == [0, 2, 2, 3, 4, 5] and got[0][2:] == (None, None) and got[3][1:] == (0, 3, 3)
    assert all(g[2:] == (2, 2) for g in got if g[0] == 2) and got[4][3] == 2 and got[5][2:] == (2, 2)
    none = docs.limit(0)
    assert fingerprint_groups(none).count() == 0 and fingerprints(none, groups=fingerprint_groups(none)).count() == 0
    assert fingerprint_groups(docs.where("doc_id IS NULL")).count() == 0


def test_repeated_ids_lose_no_unique_text(spark):
    from sousflow.llm.op2_line_dedup import line_dedup

    first = "one two three four five six"
    texts = [(1, first), (2, first), (2, "another text that differs fully here\nand more of it"), (3, "closing words of a third one"), (3, "closing words of a third one"), (None, first)]
    docs = frame(spark, texts).withColumns({"id": F.lit("x"), "hash": F.lit("y"), "__maybe": F.lit(1), "__id": F.lit(2), "gone": F.lit(3), "n_removed": F.lit("old")})
    out = line_dedup(docs).collect()
    kept = sorted((r.doc_id or 0, r.text) for r in out)
    # of the two texts of id 2 at most the equal line goes; the other one, unlike any other line, stays whole
    assert (2, "another text that differs fully here\nand more of it") in kept and (1, first) in kept and (0, first) in kept
    assert [x for x in kept if x[0] == 3] == [(3, "closing words of a third one")] * 2
    assert all((r.id, r.hash, r["__maybe"], r["__id"], r.gone) == ("x", "y", 1, 2, 3) for r in out) and {r.n_removed for r in out} <= {0, 1}
