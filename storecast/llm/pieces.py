"""SentencePiece models run by the tokenizers library: read the model's protobuf, rebuild its parts, encode in batches."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.llm.frames import mapped

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Text bytes encoded at once.
BATCH_BYTES = 1 << 19
#: Tokens looked up at once; the indices of their bytes take some 60 bytes a token.
DECODED_AT_ONCE = 1 << 17
THREADS = 2

# Fixed values of the public model format: field numbers, kinds of pieces and of models.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: numbers for varints, bytes for the rest."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class Model:
    """What a SentencePiece model says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True
    space_as_suffix: bool = False

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in fields(data):
            if number == _PIECES:
                got = dict(fields(value))
                score = struct.unpack("<f", got[2])[0] if 2 in got else 0.0
                out.pieces.append((got.get(1, b"").decode(), score, got.get(3, NORMAL)))
            elif number == _TRAINER:
                got = dict(fields(value))
                out.kind = got.get(3, UNIGRAM)
                out.byte_fallback = bool(got.get(35, 0))
                out.space_as_suffix = bool(got.get(24, 0))
            elif number == _NORMALIZER:
                got = dict(fields(value))
                out.charsmap = got.get(2, b"")
                out.add_prefix = bool(got.get(3, 1))
                out.squeeze_spaces = bool(got.get(4, 1))
                out.escape_spaces = bool(got.get(5, 1))
        return out

    @cached_property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs that make a piece, best score first. The order of splits of one piece cannot matter to its score."""
    scores = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    out = []
    for piece, score in scores.items():
        for k in range(1, len(piece)):
            if piece[:k] in scores and piece[k:] in scores:
                out.append((-score, len(out), (piece[:k], piece[k:])))
    return [pair for _, _, pair in sorted(out)]


def build(model: Model):
    """A tokenizers.Tokenizer that encodes and decodes like the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.kind not in (UNIGRAM, BPE) or model.space_as_suffix or not model.escape_spaces:
        raise ValueError("unigram and BPE models with a leading space mark are supported")
    unknown = model.pieces[model.unknown][0]
    if model.kind == UNIGRAM:
        backend = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    else:
        backend = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)},
            merges=_merges(model),
            unk_token=unknown,
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    out = Tokenizer(backend)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    out.normalizer = normalizers.Sequence(steps)
    # No piece goes on behind a letter with a space mark, so words may be told apart before the merges.
    if all(SPACE not in p.lstrip(SPACE) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"), "isolated")
    own = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        out.add_tokens([AddedToken(p, normalized=False) for p in own])
    steps = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    out.decoder = decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] * model.add_prefix)
    return out


def load(spark: SparkSession, path: str = MODEL):
    """The tokenizer's JSON, broadcast: built once on the driver, of the size of the vocabulary."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(build(Model.parse(f.read())).to_str())


class Decoder:
    """`tokenizer.decode_batch` for tokenizers made by `build`, by a table of token bytes.

    Pieces are valid text, so only runs of byte tokens can fail to be. Whether one does shows in the whole text: no
    character begins in a piece and ends in a byte token, or the other way round. Such texts are left to the library.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        listed = range(max(tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1)
        texts = [self._bytes_of(tokenizer.id_to_token(i) or "") for i in listed]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.starts = np.cumsum([0, *map(len, texts)])
        self.strips = tokenizer.decoder.decode([f"{SPACE}a"]) == "a"

    @staticmethod
    def _bytes_of(token: str) -> bytes:
        token = token.replace(SPACE, " ")
        byte = re.fullmatch("<0x([0-9A-Fa-f]{2})>", token)
        return bytes([int(byte[1], 16)]) if byte else token.encode()

    def _joined(self, ids: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[at : at + DECODED_AT_ONCE]
            first, sizes = self.starts[part], self.starts[part + 1] - self.starts[part]
            before = np.cumsum(sizes) - sizes
            out.append(self.data[np.repeat(first - before, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(out)

    def __call__(self, ids: list[np.ndarray]) -> list[str]:
        """The texts behind the ids of each text; ids are the tokenizer's own."""
        if not ids:
            return []
        whole = np.concatenate(ids)
        # Bytes up to the end of each text.
        ends = np.concatenate(([0], np.cumsum(np.diff(self.starts)[whole])))[np.cumsum([len(x) for x in ids])]
        data, out, at = self._joined(whole), [], 0
        for own, end in zip(ids, ends.tolist()):
            try:
                text = data[at:end].decode()
                out.append(text[1:] if self.strips and text.startswith(" ") else text)
            except UnicodeDecodeError:
                out.append(self.tokenizer.decode(own.tolist(), skip_special_tokens=False))
            at = end
        return out


_TOKENIZERS: dict[int, tuple] = {}


def _tokenizer(shared):
    """One tokenizer, and the decoder of its tokens, in each Python worker."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    from tokenizers import Tokenizer

    key = hash(shared.value)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        tokenizer = Tokenizer.from_str(shared.value)
        _TOKENIZERS[key] = tokenizer, Decoder(tokenizer)
    return _TOKENIZERS[key]


def _encode(tokenizer, texts: list[str]) -> list[np.ndarray]:
    return [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _encoded_parts(tokenizer, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and ids of runs of texts with about BATCH_BYTES characters each; no other text is unpacked meanwhile."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(column):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at : at + len(column)]), BATCH_BYTES, "right")))
        texts = column.slice(at, n).to_pylist()
        yield at, _encode(tokenizer, texts)
        at += n


def _token_lists(ids: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    sizes = np.array([len(x) for x in ids], np.int64)
    ends = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))), pa.array(sizes)


def _pieces_of(texts: list[str], size: int) -> Iterator[list[str]]:
    """Lists of texts with about `size` characters each, or one longer text."""
    held, n = [], 0
    for t in texts:
        if held and n + len(t) > size:
            yield held
            held, n = [], 0
        held.append(t)
        n += len(t)
    if held:
        yield held


def encoded(docs: DataFrame, model, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all but text if not given) with tokens (array of int) and n_tokens.

    Null texts count as empty and have no tokens; texts without content keep their row. Whole texts are encoded. Own
    columns named tokens or n_tokens are replaced. An empty table gives an empty result.
    """
    keep = [c for c in (keep or docs.columns) if c not in ("text", "tokens", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = _tokenizer(model)
        for batch in batches:
            at = 0
            for texts in _pieces_of(batch.column(len(keep)).to_pylist(), BATCH_BYTES):
                part = batch.slice(at, len(texts))
                at += len(texts)
                own = [*part.columns[: len(keep)], *_token_lists(_encode(tokenizer, texts))]
                yield pa.record_batch(own, names=[*keep, "tokens", "n_tokens"])

    own = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {own[c]}" for c in keep), "tokens array<int>, n_tokens bigint"])
    return mapped(docs.select(*keep, F.coalesce("text", F.lit("")).alias("text")), run, schema)


def decoded(rows: DataFrame, model) -> DataFrame:
    """`rows` with text, decoded from tokens (null tokens: empty). An own column named text is replaced."""
    keep = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = _tokenizer(model)
        for batch in batches:
            tokens = [t or [] for t in batch.column(keep.index("tokens")).to_pylist()]
            texts = tokenizer.decode_batch(tokens, skip_special_tokens=False)
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*keep, "text"])

    own = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return mapped(rows.select(*keep), run, ", ".join([*(f"`{c}` {own[c]}" for c in keep), "text string"]))


def retold(docs: DataFrame, model) -> DataFrame:
    """The columns of `docs` but text, then tokens, n_tokens and text, decoded from the tokens, in one pass.

    The same as `decoded(encoded(docs))`, without a second worker for each task and without tokens in between. Cases as in
    `encoded`.
    """
    keep = [c for c in docs.columns if c not in ("text", "tokens", "n_tokens")]
    names = [*keep, "tokens", "n_tokens", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, decode = _tokenizer(model)
        for batch in batches:
            for at, ids in _encoded_parts(tokenizer, batch.column(len(keep))):
                own = [c.slice(at, len(ids)) for c in batch.columns[: len(keep)]]
                yield pa.record_batch([*own, *_token_lists(ids), pa.array(decode(ids), pa.string())], names=names)

    own = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {own[c]}" for c in keep), "tokens array<int>, n_tokens bigint, text string"])
    return mapped(docs.select(*keep, F.coalesce("text", F.lit("")).alias("text")), run, schema)


def round_trip(docs: DataFrame, model) -> DataFrame:
    """doc_id, n_tokens, tokens, text (decoded from the tokens), lossless (equal to what was encoded) for each row of `docs`.

    Encodes and decodes in one pass, so that tokens don't travel twice. Cases as in `encoded`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, decode = _tokenizer(model)
        for batch in batches:
            at = 0
            for texts in _pieces_of(batch.column(1).to_pylist(), BATCH_BYTES):
                ids = _encode(tokenizer, texts)
                back = decode(ids)
                same = pa.array([a == b for a, b in zip(texts, back)])
                tokens, sizes = _token_lists(ids)
                own = [batch.column(0).slice(at, len(texts)), sizes, tokens, pa.array(back, pa.string()), same]
                yield pa.record_batch(own, names=["doc_id", "n_tokens", "tokens", "text", "lossless"])
                at += len(texts)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return mapped(rows, run, "doc_id bigint, n_tokens bigint, tokens array<int>, text string, lossless boolean")
