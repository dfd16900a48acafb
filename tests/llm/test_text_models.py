"""HTML text, quality, language-model scores, personal data and tokens against brute force or held-out accuracy."""

import hashlib
import math
import random
import tracemalloc
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sousflow.llm import common, op4_html_text, op5_quality_fm, op6_ppm, op9_pii
from sousflow.llm.op10_sentencepiece import BPE, MARK, RUN_WORDS, Codec, build_tokenizer, decode, encode, model_bytes, normalised, parse_model, round_trip

SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# -- HTML -----------------------------------------------------------------
def test_tree_on_pages_it_has_not_seen():
    tree = op4_html_text.train()
    hit = extra = missed = 0
    for page, main in op4_html_text.labelled_pages(seed=77, count=150):
        got, want = set(op4_html_text.main_texts([page], tree)[0].split("\n")) - {""}, set(main)
        hit, extra, missed = hit + len(got & want), extra + len(got - want), missed + len(want - got)
    assert hit / (hit + extra) > 0.97 and hit / (hit + missed) > 0.97


@pytest.mark.parametrize("page,want", [
    ("<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>One &amp; two &lt;b&gt;.</p><p>x<br>y\n z</p></article><footer>&copy; me</footer>", "Title\nOne & two <b>.\nx y z"),
    ("<article><p>Only <b>bold<p>unclosed <i>text here", "Only bold\nunclosed text here"),
    ("<article><p>a&nbsp;b<script>if (1 < 2) '</p>'</script> c</p><style>p{}</style><!-- <p>no</p> --></article>", "a b c"),
    ("", ""), ("<p>", ""), ("<article><p>&amp;lt; once</p></article>", "&lt; once"),
    ("<body><article><p>The text of the page.</p></article><section id=comments><div class=comment><p>A reader says so.</p></div></section></body>", "The text of the page."),
])
def test_main_text(page, want):
    assert op4_html_text.main_texts([page], op4_html_text.train())[0] == want


@pytest.mark.parametrize("tag", ["button", "select", "option", "map", "object", "svg", "canvas", "video", "audio", "noscript", "template"])
def test_unclosed_elements_leave_the_article(tag):
    tree = op4_html_text.train()
    rest = "<article><h1>Title</h1><p>The text of the page.</p></article>"
    for page in (f"<div><{tag}>x</div>{rest}", f"<nav><{tag}></nav>{rest}<form><{tag}>y</{tag}></form>"):
        assert op4_html_text.main_texts([page], tree)[0] == "Title\nThe text of the page."
    assert op4_html_text.main_texts([f"<article><p>Some words <{tag}>y<i>z</i></{tag}>of text.</p></article>"], tree)[0] in ("Some words of text.",)


def test_formulas_are_text_and_raw_elements_run_on():
    tree = op4_html_text.train()
    assert op4_html_text.main_texts(["<article><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"], tree)[0] == "Here x=2 holds."
    assert op4_html_text.main_texts(["<article><p>Here it ends.</p><script>var a = '</p>';"], tree)[0] == "Here it ends."
    assert len(op4_html_text.blocks("<div>" + "<svg>a" * 20_000 + "</svg>")) == 1  # linear


def test_extract_text_edges(spark):
    pages = spark.createDataFrame([(1, "u", None, 5), (None, None, "<article><p>é text.</p></article>", 6), (1, "u", "", 7)], "page_id long, url string, html string, text int")
    got = sorted((r.page_id or -1, r.url or "", r.text, r.n_chars) for r in op4_html_text.extract_text(pages).collect())
    assert got == [(-1, "", "é text.", 7), (1, "u", "", 0), (1, "u", "", 0)]
    assert op4_html_text.extract_text(pages.limit(0)).count() == 0


# -- quality --------------------------------------------------------------
def test_factors_by_the_identity_equal_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    index, value, at = rng.integers(0, 20, 12), rng.random(12).astype(np.float32), np.array([0, 5])
    weights, factors = rng.random(20), rng.random((20, 4))
    score, *_ = op5_quality_fm._raw_score(0.3, weights, factors, index, value, at)
    for k, (a, b) in enumerate(((0, 5), (5, 12))):
        pairs = sum(factors[index[i]] @ factors[index[j]] * value[i] * value[j] for i in range(a, b) for j in range(a, i))
        assert abs(score[k] - (0.3 + (weights[index[a:b]] * value[a:b]).sum() + pairs)) < 1e-5


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels, "doc_id", "left_semi")
    rows = op5_quality_fm.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500 and np.mean([r.predicted == r.quality for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b c"), (9, "x " * 5000)], "doc_id long, text string").withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (9, 0), (2, None), (77, 1), (None, 0)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        rows = op5_quality_fm.quality(docs, some).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 2}) == 1
    assert op5_quality_fm.quality(docs.limit(0), labels).count() == 0


# -- language model ---------------------------------------------------------
def brute_ppm(train, texts, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    symbols = lambda t: [0] * order + list(" ".join(words_of(t)).encode()) + [0]
    for t in train:
        s = symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[k][tuple(s[i - k:i])][s[i]] += 1
    out = []
    for t in texts:
        s, total = symbols(t), 0.0
        for i in range(order, len(s)):
            excluded = set()
            for k in range(order, -1, -1):
                seen = counts[k].get(tuple(s[i - k:i]))
                if seen is None:
                    continue
                n, distinct = sum(v for x, v in seen.items() if x not in excluded), len(seen) - len(excluded)
                if n == 0:
                    continue
                if s[i] in seen:
                    total += math.log10(seen[s[i]] / (n + distinct))
                    break
                total += math.log10(distinct / (n + distinct))
                excluded = set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        out.append(total)
    return out


def test_scores_equal_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["abra", "Cadabra", "é", "abrac", "x\ty", "zeta"]) for _ in range(rnd.randint(0, 12)))) for i in range(60)] + [(60, None), (61, "  "), (62, "NEW wörds")]
    got = {r.doc_id: r for r in op6_ppm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    learned = [t for d, t in rows if zlib.crc32(str(d).encode()) % 10]
    counts = Counter(w for t in learned for w in [*words_of(t), None])
    n, distinct = sum(counts.values()), len(counts)
    ppm = brute_ppm(learned, [t for _, t in rows], op6_ppm.ORDER)
    for (d, t), log10 in zip(rows, ppm):
        tokens, r = [*words_of(t), None], got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(d).encode()) % 10 == 0, len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert abs(r.base_score - sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (distinct + 1))) for w in tokens)) < 1e-9
        assert abs(r.score - log10) < 1e-9


@pytest.mark.parametrize("max_entries", [1, 30, op6_ppm.MAX_ENTRIES])
def test_scores_do_not_depend_on_what_is_broadcast(spark, max_entries):
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice(["abra", "abrac", "zeta", "zet", "rare%d" % rnd.randint(0, 99), "é"]) for _ in range(rnd.randint(0, 15)))) for i in range(90)] + [(90, "Q~ xzq")]
    got = {r.doc_id: r.score for r in op6_ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), max_entries=max_entries).collect()}
    learned = [t for d, t in rows if zlib.crc32(str(d).encode()) % 10]
    for (d, _), log10 in zip(rows, brute_ppm(learned, [t for _, t in rows], op6_ppm.ORDER)):
        assert abs(got[d] - log10) < 1e-9


def test_counts_are_sent_packed_by_parts():
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["abra", "Abrac", "zeta", "é", "w%d" % rnd.randint(0, 50)]) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
    held = [k % 5 == 0 for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(held)], ["text", "held_out"])
    sent = [pa.Table.from_batches([x]) for x in op6_ppm._gather(3)(iter([batch, batch]))]
    assert len(sent) <= 2 * 3  # rows for kinds and parts, not for keys
    got, parts = {}, pa.concat_tables(sent)
    for part in {*parts.column("part").to_pylist()}:
        rows = op6_ppm._summed(parts.filter(pa.compute.equal(parts.column("part"), part))).to_pylist()
        assert len({(r["kind"], r["key"]) for r in rows}) == len(rows) and not got.keys() & {(r["kind"], r["key"]) for r in rows}
        got |= {(r["kind"], r["key"]): r["n"] for r in rows}
    x, out = op6_ppm.coded(pa.array([t for t, h in zip(texts, held) if not h])), op6_ppm.coded(pa.array([t for t, h in zip(texts, held) if h]))
    want = Counter({(1, k): 0 for k in out.grams.view("i8").tolist()})
    want.update({(1, k): 2 * n for k, n in Counter(x.grams.view("i8").tolist()).items()})
    want.update({(0, k): 2 * n for k, n in Counter(x.hashes.view("i8").tolist()).items()})
    want[(0, int(op6_ppm.END.astype("i8")))] += 2 * (40 - sum(held))
    assert got == dict(want)


def test_a_part_holds_whole_contexts_and_says_what_they_give(monkeypatch):
    monkeypatch.setattr(op6_ppm, "_FLUSH", 400)  # several flushes
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["abra", "Abrac", "zeta", "é", "w%d" % rnd.randint(0, 50)]) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
    held = [k % 3 == 0 for k in range(40)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k::4]), pa.array(held[k::4])], ["text", "held_out"]) for k in range(4)]
    parts = pa.concat_tables([pa.Table.from_batches([x]) for x in op6_ppm._gather(5)(iter(batches))])
    rows = [(p, r) for p in range(5) for r in op6_ppm._summed(parts.filter(pa.compute.equal(parts.column("part"), p))).to_pylist() if r["kind"]]
    part, counts = {}, defaultdict(dict)
    for p, r in rows:
        assert part.setdefault(r["key"] >> 8, p) == p
        counts[r["key"] >> 8][r["key"] & 255] = r["n"]
    assert any(r["n"] == 0 for _, r in rows)
    for _, r in rows:
        seen = {s: n for s, n in counts[r["key"] >> 8].items() if n}
        if r["n"]:
            assert abs(r["log"] - math.log10(r["n"] / (sum(seen.values()) + len(seen)))) < 1e-12 and r["seen"] is None
        else:
            assert r["log"] is None and {*np.flatnonzero(np.unpackbits(np.frombuffer(r["seen"], np.uint8))).tolist()} == {*seen}
            assert abs(r["so_far"] - (math.log10(len(seen) / (sum(seen.values()) + len(seen))) if seen else 0)) < 1e-12


def test_counting_holds_few_copies_of_its_grams():
    rnd = np.random.default_rng(3)
    grams = [rnd.integers(0, 1 << 40, 100_000).astype(np.uint64) << np.uint64(1) | np.uint64(k % 2) for k in range(10)]
    want = Counter(np.concatenate(grams[::2]).tolist())
    tracemalloc.start()
    try:
        waiting = [g.copy() for g in grams]
        keys, counts = op6_ppm._counted(waiting)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert not waiting and peak < 40 * 1_000_000  # bytes for each gram
    assert dict(zip((keys << np.uint64(1)).tolist(), counts.tolist(), strict=True)) == {**{int(k) & ~1: 0 for g in grams[1::2] for k in g}, **want}


def test_group_functions_give_memory_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    part = pa.table({"x": [1, 2]})
    one, two = common.frugal_groups(lambda key, t: t), common.frugal_groups(lambda key, t, u: pa.concat_tables([t, u]))
    assert one((), part) is part and two((), part, part).num_rows == 4 and len(given) == 2
    monkeypatch.undo()
    rows = spark.createDataFrame([(1, 2), (1, 3), (2, 5)], "k int, v int")
    assert sorted(r.v for r in rows.groupBy("k").applyInArrow(common.frugal_groups(lambda key, t: t), "k int, v int").collect()) == [2, 3, 5]


def test_score_edges_and_a_bounded_trie(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (1, "aa bb"), (None, "aa"), (2, "cc")], "doc_id long, text string").withColumns({"n": F.lit(1), "key": F.lit(2)})
    rows = op6_ppm.score(docs).collect()
    assert len(rows) == 4 and len({(r.base_score, r.score) for r in rows if r.doc_id == 1}) == 1
    assert op6_ppm.score(docs.limit(0)).count() == 0
    # with few entries the probabilities of all symbols after a context still add up to one at most
    x = op6_ppm.coded(pa.array(["abab abac abad", "abab", "xyz xyz xyw"]))
    tables, contexts = [], []
    for k in range(op6_ppm.ORDER + 1):
        keys, counts = np.unique(x.grams & op6_ppm._mask(k + 1), return_counts=True)
        nodes, back = np.unique(keys >> np.uint64(8), return_inverse=True)
        total, distinct = np.bincount(back, counts), np.bincount(back)
        keep, held = counts > 1, total > 1
        tables.append((keys[keep], counts[keep]))
        contexts.append((nodes[held], total[held], distinct[held]))
    trie = op6_ppm.Trie(tables, contexts)
    for gram in np.unique(x.grams >> np.uint64(8)):
        every = (np.uint64(gram) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert (10 ** trie.log10(every)).sum() < 1 + 1e-9


# -- personal data ----------------------------------------------------------
def brute_spans(text):
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    out = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 2 and not (12 <= len(digits) <= 19 and op9_pii.luhn(digits)) or k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return [(s, e, op9_pii.KINDS[k]) for s, k, e in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@-1 +23(4)9%é0", max_size=60))
def test_certain_kinds_are_those_of_the_patterns(text):
    assert op9_pii.base_spans(text) == brute_spans(text)


def test_certain_kinds_in_documents(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        assert op9_pii.base_spans(r.text) == brute_spans(r.text)


def test_boosted_candidates_on_sentences_not_seen():
    model = op9_pii.train()
    table = op9_pii.labelled_table(seed=101)
    p = model.probability(np.array([op9_pii.features(t, s) for t, s, _ in table]))
    taken = np.array([x >= op9_pii.THRESHOLDS[s[2]] for x, (_, s, _) in zip(p, table)])
    truth = np.array([y for *_, y in table], bool)
    assert truth[taken].mean() > 0.95 and taken[truth].mean() > 0.9


@pytest.mark.parametrize("text", ["jane.doe at example [dot] com", "jane at example (dot) org", "jane at example.com", "jane (AT) example (DOT) com", "JANE AT EXAMPLE DOT COM"])
def test_written_emails_are_proposed_and_taken(text):
    assert op9_pii.candidates(text) == [(0, len(text), "email_written")]
    assert op9_pii.accepted([f"contact {text} today"], op9_pii.train()) == [[(8, 8 + len(text), "email_written")]]


def test_long_secrets_are_whole(spark):
    rnd = random.Random(3)
    for size in (129, 400, 5000):
        secret = "eyJ" + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_-.") for _ in range(size - 3))
        text = f"token: {secret} end"
        assert op9_pii.candidates(text) == [(7, 7 + size, "secret")]
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        assert op9_pii.find_pii(docs).first().spans == f"secret:7:{7 + size}"
        assert op9_pii.redact(docs).first().text == "token: [SECRET] end"
    assert op9_pii.candidates("token=" * 50_000)  # linear


def test_negatives_of_written_emails_are_learned():
    labelled = [(t[s:e], label) for t, (s, e, kind), label in op9_pii.labelled_table() if kind == "email_written"]
    assert sum(not label and re.match(r"\w+ at \w+\. \w", value) is not None for value, label in labelled) >= 60


def test_find_and_redact(spark):
    rows = [(1, "mail a.b@c.org or +1 (724) 555-3457, token = \"0123456789abcdef0123456789abcdef01234567\" é"), (2, None), (2, ""), (None, "10.0.0.1"), (4, "clean 1234 text"), (5, "9" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(0))
    got = {r.doc_id: r for r in op9_pii.find_pii(docs).collect()}
    r = got[1]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 0, 0, 1) and r.spans.startswith("email:5:14,phone:18:35,secret:")
    base = ",".join(x for x in r.spans.split(",") if not x.startswith("secret"))
    assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert got[2].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest() and got[None].n_ip == 1 and got[4].spans == ""
    text = {r.doc_id: r.t for r in op9_pii.redact(docs).withColumnRenamed("text", "t").where("doc_id IS NULL OR doc_id <> 2").collect()}
    assert text[1] == "mail [EMAIL] or [PHONE], token = \"[SECRET]\" é" and text[None] == "[IP]" and text[4] == "clean 1234 text"
    assert op9_pii.find_pii(docs.limit(0)).count() == 0


# -- tokens -----------------------------------------------------------------
ODD = ["", " ", "  a  b ", "a\tb\n\nc", "<s>hi</s>", "▁x▁", "日本語", "😀 ok", "ﬁ", "\x00n", "<0x41>", "tail   ", "<unk>", "ⅷ ½"]


def test_parity_with_the_library(spark):
    data = model_bytes()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*ODD, None])], "doc_id long, text string")
    rows = round_trip(docs.select("doc_id", "text").unionByName(odd).withColumn("ids", F.lit(1)), data).collect()
    assert len(rows) == docs.count() + len(ODD) + 1 and all(r.parity and r.round_trip for r in rows)
    assert round_trip(docs.limit(0), data).count() == 0
    back = {r.doc_id: r.text for r in decode(encode(odd, data), data).collect()}
    assert [back[10_000 + i] for i in range(len(ODD))] == [t.replace("▁", " ") for t in ODD] and back[10_000 + len(ODD)] == ""


def _varint(n):
    out = b""
    while True:
        out, n = out + bytes([n & 127 | (128 if n > 127 else 0)]), n >> 7
        if not n:
            return out


def _field(number, value):
    import struct

    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def test_a_unigram_model_written_by_hand():
    from sentencepiece import SentencePieceProcessor

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), *(("▁" if k == 0 else "abcdeé"[k - 1], -4.0 - k * 0.37, 1) for k in range(7)),
              ("▁a", -3.1, 1), ("ab", -3.3, 1), ("▁ab", -2.9, 1), ("cde", -3.7, 1), ("de", -3.55, 1), ("abc", -4.6, 1)]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, kind)) for p, s, kind in pieces)
    data += _field(2, _field(3, 1) + _field(35, 1)) + _field(3, _field(1, b"identity") + _field(3, 1) + _field(4, 1) + _field(5, 1))
    model, library = parse_model(data), SentencePieceProcessor(model_proto=data)
    tokenizer = build_tokenizer(model)
    assert model.kind != BPE and model.byte_fallback and model.remove_extra_whitespaces
    for text in ["ab", "abcde abc", "  ab   cde ", "z", "é日", "a z b", "abcabcde deab", "", " "]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == library.encode(text), text
        assert tokenizer.decode(ids, skip_special_tokens=False) == normalised(model, text, tokenizer)


def test_runs_of_words_give_the_ids_and_texts_of_words_one_by_one():
    model = parse_model(model_bytes())
    tokenizer, codec = build_tokenizer(model), Codec(model).start()
    rnd = random.Random(4)
    odd = ["", " ", "a", "   ", " a  b ", MARK, f"a{MARK}b", f"{MARK}{MARK} a", "x\ty\n z", "→ 漢字 \u2582\U0001f600", "<s> </s> <0xE2>", "e\u0301 \x00 z", "w" * 5000, "  " * 300 + "a"]
    texts = odd + ["".join(rnd.choice(["a", "The", "ing", " ", " ", "  ", MARK, "é", "\n", "7", "€"]) for _ in range(rnd.randint(0, 300))) for _ in range(200)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert codec.encode(texts) == want
    # few strings go to the model: runs of words, not each word
    assert len(codec.tokenizer.pre_tokenizer.pre_tokenize_str(f"{MARK}word" * 64)) == 64 // RUN_WORDS
    number = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    in_bytes = [number[f"<0x{b:02X}>"] for b in MARK.encode()]  # a marker written in bytes stays one
    rows = [*want, in_bytes, [number[MARK], *in_bytes, number[MARK]], in_bytes[:2], [in_bytes[1]], [number["<0xE2>"]], []]
    assert codec.decode(rows) == tokenizer.decode_batch(rows, skip_special_tokens=False)
