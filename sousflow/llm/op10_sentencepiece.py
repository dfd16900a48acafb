"""SentencePiece encoding and decoding on the tokenizers library.

The model file, a protocol buffer, is parsed field by field; from it are rebuilt the normaliser
(precompiled character map, white space rules, the metaspace marker U+2581), the unigram
scores or the merges of a BPE model in order of their scores, and the byte fallback. The driver
builds the tokenizer once and sends it to the tasks as JSON; batches are encoded by a bounded
number of threads. White space is marked, and marks are taken out, on whole texts, so that the library
has no rule to apply word by word or token by token. Parity with the sentencepiece library is a function
of its own and is checked by the query for every document.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import shared, slices, text_of

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Text encoded in one call; a token takes some hundred bytes until its ids are taken out.
BATCH_BYTES = 1 << 20
THREADS = 2
#: Words that a BPE model merges in one go; each run of words costs the library a string and its offsets.
RUN_WORDS = 16


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol buffer message; nested messages and strings as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            at += size
            yield tag >> 3, data[at - size : at]
        elif kind == 2:
            size = varint()
            at += size
            yield tag >> 3, data[at - size : at]
        else:
            raise ValueError(f"wire type {kind} in a model file")


@dataclass(frozen=True)
class Model:
    """What the model file says."""

    pieces: tuple[tuple[str, float, int], ...]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    add_dummy_prefix: bool
    remove_extra_whitespaces: bool
    escape_whitespaces: bool
    whitespace_as_suffix: bool

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)


def parse_model(data: bytes) -> Model:
    pieces, spec, rules = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(_fields(value))
        elif number == 3:
            rules = dict(_fields(value))
    return Model(tuple(pieces), spec.get(3, UNIGRAM), bool(spec.get(35, 0)), rules.get(2, b""), bool(rules.get(3, 1)), bool(rules.get(4, 1)), bool(rules.get(5, 1)), bool(spec.get(24, 0)))


def _merges(model: Model) -> list[tuple[str, str]]:
    """Every split of a piece into two pieces, the best-scored piece first."""
    usable = {p: (score, i) for i, (p, score, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, (score, number) in usable.items():
        for k in range(1, len(piece)):
            left, right = piece[:k], piece[k:]
            if left in usable and right in usable:
                found.append((-score, number, usable[left][1], usable[right][1], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: Model):
    """The same tokenizer for the tokenizers library."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.whitespace_as_suffix or not model.escape_whitespaces:
        raise ValueError("models with white space as suffix or unescaped are not supported")
    vocab = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    if model.kind == UNIGRAM:
        tokenizer = Tokenizer(models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unknown, byte_fallback=model.byte_fallback))
    elif model.kind == BPE:
        tokenizer = Tokenizer(models.BPE(vocab, _merges(model), unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback))
    else:
        raise ValueError(f"model type {model.kind} is not supported")
    rules = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_whitespaces:
        rules += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip(left=True, right=True)]
    rules += [normalizers.Prepend(MARK)] if model.add_dummy_prefix else []
    tokenizer.normalizer = normalizers.Sequence([*rules, normalizers.Replace(" ", MARK)])
    if not any(MARK in piece[1:].lstrip(MARK) or (MARK in piece and piece.strip(MARK) and not piece.startswith(MARK)) for piece, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)):
        # no piece runs on from a letter over a marker, so words can be encoded one by one
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    if user := [AddedToken(p, normalized=True, special=False) for p, _, kind in model.pieces if kind == USER_DEFINED]:
        tokenizer.add_tokens(user)
    strip = [decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return tokenizer


class Codec:
    """A model's tokenizer for the tasks: ``build_tokenizer``'s, with the same ids and texts, and less work for each word and token."""

    def __init__(self, model: Model):
        from tokenizers import Regex, normalizers, pre_tokenizers

        tokenizer, pieces = build_tokenizer(model), {piece for piece, _, _ in model.pieces}
        # such a model only marks white space, which can be done before the library gets the text
        self.marked = model.kind == BPE and not model.charsmap and not model.remove_extra_whitespaces and not any(kind == USER_DEFINED for *_, kind in model.pieces)
        self.prefix = model.add_dummy_prefix
        if self.marked:
            tokenizer.normalizer = normalizers.Sequence([])
            if tokenizer.pre_tokenizer is not None and MARK in pieces:  # words do not merge with their neighbours, nor do unknown characters over a marker
                tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"(?:{MARK}*[^{MARK}]+){{1,{RUN_WORDS}}}|{MARK}+"), "isolated")
        #: Byte pieces with which a marker written in bytes begins; that one is no white space.
        self.lead = [i for i, (piece, _, _) in enumerate(model.pieces) if piece.lower() == "<0xe2>"]
        self.built = tokenizer.to_str()

    def start(self) -> Codec:
        """Build the tokenizer, once in a task."""
        from tokenizers import Tokenizer, decoders

        self.tokenizer = Tokenizer.from_str(self.built)
        if self.marked and hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # runs of words hardly repeat
        self.full, self.fused = self.tokenizer.decoder, decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
        return self

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.marked:
            mark = MARK if self.prefix else ""
            texts = [mark + t.replace(" ", MARK) if t else t for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        bytes_ = [any(b in x for b in self.lead) for x in ids]
        self.tokenizer.decoder = self.fused
        fused = iter(self.tokenizer.decode_batch([x for x, b in zip(ids, bytes_, strict=True) if not b], skip_special_tokens=False))
        self.tokenizer.decoder = self.full
        full = iter(self.tokenizer.decode_batch([x for x, b in zip(ids, bytes_, strict=True) if b], skip_special_tokens=False))
        return [next(full) if b else self._unmarked(next(fused)) for b in bytes_]

    def _unmarked(self, text: str) -> str:
        text = text.replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _threads(count: int) -> None:
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ["RAYON_NUM_THREADS"] = str(count)


def normalised(model: Model, text: str, tokenizer) -> str:
    """The text that decoding gives back: normalised, without the marker put in front."""
    if not model.charsmap and not model.remove_extra_whitespaces:
        return text.replace(MARK, " ")  # such a model only marks white space
    out = tokenizer.normalizer.normalize_str(text).replace(MARK, " ")
    return out[1:] if model.add_dummy_prefix and out.startswith(" ") else out


def model_bytes(path: str | None = None) -> bytes:
    """The model file, read on the driver; by default that of the installed public tokenizers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def _digests(ids: list[list[int]]) -> list[str]:
    """SHA-256 of every row's ids as little-endian 32-bit integers."""
    packed = pa.array(ids, pa.list_(pa.int32()))
    flat, at = packed.values.to_numpy().astype("<i4", copy=False), packed.offsets.to_pylist()
    return [hashlib.sha256(flat[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]


def encode(docs: DataFrame, data: bytes, id_column: str = "doc_id", text_column: str = "text", threads: int = THREADS) -> DataFrame:
    """doc_id and ids (array of int) of every row; a null or empty text has no ids, ids of rows are passed through."""
    codec = shared(docs.sparkSession, Codec(parse_model(data)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        ready = codec().start()
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ready.encode(batch.column("text").to_pylist()), pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text_of(docs, text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(ids: DataFrame, data: bytes, threads: int = THREADS) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null ids give an empty text."""
    codec = shared(ids.sparkSession, Codec(parse_model(data)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        ready = codec().start()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = ready.decode([x or [] for x in part.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select(ids["doc_id"].cast("long").alias("doc_id"), ids["ids"].cast("array<int>").alias("ids")).mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, data: bytes, id_column: str = "doc_id", text_column: str = "text", parity: bool = True, threads: int = THREADS) -> DataFrame:
    """Encode and decode every row: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip, parity.

    ``ids_sha256`` is of the ids as little-endian 32-bit integers. ``round_trip`` says whether
    decoding gives the normalised text, ``parity`` whether the sentencepiece library gives the
    same ids (null unless asked for). A null text counts as empty: no ids, decoded to the empty
    text. Ids are passed through, null or repeated; an empty table gives an empty result.
    """
    model = parse_model(data)
    sent = shared(docs.sparkSession, (Codec(model), data if parity else b""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        codec, proto = sent()
        ready, reference = codec.start(), None
        if parity:
            from sentencepiece import SentencePieceProcessor

            reference = SentencePieceProcessor(model_proto=proto)
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                texts = batch.column("text").to_pylist()
                ids = ready.encode(texts)
                decoded = ready.decode(ids)
                same = [a == b for a, b in zip(ids, reference.encode(texts, num_threads=threads), strict=True)] if reference else [None] * len(ids)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(_digests(ids), pa.string()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                    pa.array([normalised(model, t, ready.tokenizer) == x for t, x in zip(texts, decoded, strict=True)], pa.bool_()),
                    pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "parity"])

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text_of(docs, text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean")
