"""Byte-level BPE with a backtracking encoder: exact merges in linear time, without merging.

An Aho-Corasick pass lists the longest token that starts at each byte. The encoder walks forward over longest matches and
accepts a token only if it is compatible with the one before: if the merges, applied to both tokens' bytes together, leave
exactly these two. A sequence of pairwise compatible tokens is what the merges make, and there is only one. Where no
match fits, the token is shortened to its longest prefix that is a token, and a place without any is blocked for good
and the walk steps back, so each place is left once. Decoding gathers bytes through a table of token offsets.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.llm.frames import mapped

MODEL = public_tokenizers.path("byte_bpe_50k.json")
#: Words whose tokens are remembered in a worker, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 1 << 18, 48
#: Pairs of tokens whose compatibility is remembered.
PAIRS = 1 << 20
#: Characters of text that leave at once, and of one text that are split into words at once.
SLICE_CHARS = 1 << 20
#: Tokens turned into bytes at once.
DECODED_AT_ONCE = 1 << 17

# The public pattern that splits text before the merges, and its form for ASCII.
WORDS = public_tokenizers.PATTERN
ASCII_WORDS = WORDS.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace("?A-Za-z+", "?[A-Za-z]+").replace("?0-9+", "?[0-9]+")


def byte_letters() -> dict[str, int]:
    """The public mapping of letters in a vocabulary file to bytes: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Tokens in the order of their merges: 256 single bytes, then what each merge makes out of two earlier tokens."""

    tokens: list[bytes]
    left: list[int]
    right: list[int]
    ids: np.ndarray  # of each token, as the file numbers them
    added: dict[str, int]  # strings that are cut out of a text before all else
    prefix_space: bool = False
    split_words: bool = True
    mark: str = ""  # tells vocabularies apart

    @classmethod
    def parse(cls, data: str) -> Vocabulary:
        """Reads a tokenizer file. What is not byte-level BPE, or would change texts, is refused."""
        whole = json.loads(data)
        model, pre = whole["model"], whole.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if whole.get("normalizer") or pre.get("type") != "ByteLevel" or model.get("type", "BPE") != "BPE" or odd:
            raise ValueError("only plain byte-level BPE is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in whole.get("added_tokens", [])):
            raise ValueError("added tokens that strip or match whole words are not supported")
        letters = byte_letters()
        raw = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
        tokens = [bytes([b]) for b in range(256)]
        place = {t: i for i, t in enumerate(tokens)}
        left, right = list(range(256)), list(range(256))
        for pair in model["merges"]:
            a, b = (bytes(letters[c] for c in t) for t in (pair if isinstance(pair, list) else pair.split(" ")))
            if a + b in place:
                raise ValueError(f"two merges make {a + b!r}")
            place[a + b] = len(tokens)
            left.append(place[a])
            right.append(place[b])
            tokens.append(a + b)
        ids = np.array([raw[t] for t in tokens], np.uint32)
        added = {t["content"]: t["id"] for t in whole.get("added_tokens", [])}
        return cls(tokens, left, right, ids, added, bool(pre.get("add_prefix_space")), pre.get("use_regex", True), hashlib.sha256(data.encode()).hexdigest())

    @cached_property
    def made_by(self) -> dict[tuple[int, int], int]:
        """The pair table: which token a merge makes out of two."""
        return {(self.left[i], self.right[i]): i for i in range(256, len(self.tokens))}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave token a before token b apart.

        Both are taken apart again, the later merge first. If the parts that touch could have been merged before the
        merge just undone, the pair would not have survived; of one rule's places the left one is merged first.
        """
        bound = len(self.tokens)
        while True:
            if self.made_by.get((a, b), bound) < bound:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:
                bound, a = a, self.right[a]
            else:
                bound, b = b + 1, self.left[b]

    @cached_property
    def whole(self) -> list[bool]:
        """Whether the merges turn a token's own bytes into that token; others never occur."""
        out = [True] * 256
        for i in range(256, len(self.tokens)):
            a, b = self.left[i], self.right[i]
            out.append(out[a] and out[b] and self._touch(a, b, i))
        return out

    def _touch(self, a: int, b: int, made: int) -> bool:
        """Whether a and b stay apart until their own merge, the one that makes `made`."""
        bound = made
        while a >= 256 or b >= 256:
            if a > b:
                bound, a = min(bound, a), self.right[a]
            else:
                bound, b = min(bound, b + 1), self.left[b]
            if self.made_by.get((a, b), bound) < bound:
                return False
        return True


class Encoder:
    """Texts to ids and back, with bounded memory for words and pairs seen before."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = v = vocabulary
        self.matches = ahocorasick.Automaton()
        for i, t in enumerate(v.tokens):
            if v.whole[i]:
                self.matches.add_word(t.decode("latin-1"), i)
        self.matches.make_automaton()
        self.sizes = [len(t) for t in v.tokens]
        self.own_ids = [int(i).to_bytes(4, "little") for i in v.ids]
        self.place = {t: i for i, t in enumerate(v.tokens) if v.whole[i]}
        self.shorter: dict[int, int | None] = {}
        self.pairs: dict[int, bool] = {}
        self.words = _Words(self)
        self.added = re.compile("|".join(map(re.escape, sorted(v.added, key=len, reverse=True)))) if v.added else None
        self.ascii_words, self.any_words = re.compile(ASCII_WORDS, re.ASCII), regex.compile(WORDS)

    # -- encoding ------------------------------------------------------------

    def _compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self.vocabulary.compatible(a, b)
        return got

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of `token`."""
        if token not in self.shorter:
            data = self.vocabulary.tokens[token]
            found = (self.place.get(data[:n]) for n in range(len(data) - 1, 0, -1))
            self.shorter[token] = next((t for t in found if t is not None), None)
        return self.shorter[token]

    def merged(self, data: bytes) -> list[int]:
        """The tokens (by place in the vocabulary) that the merges make of the bytes of one word."""
        if data in self.place:
            return [self.place[data]]
        n, sizes = len(data), self.sizes
        longest = [0] * n
        for end, token in self.matches.iter(data.decode("latin-1")):
            longest[end - sizes[token] + 1] = token  # ends ascend, so the longest comes last
        blocked = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + sizes[token]
            if not blocked[end] and (not out or self._compatible(out[-1], token)):
                out.append(token)
                if end == n:
                    return out
                at, token = end, longest[end]
                continue
            less = self._shorter(token)
            if less is None:
                blocked[at] = 1
                token = out.pop()
                at -= sizes[token]
            else:
                token = less

    def packed(self, data: bytes) -> bytes:
        return b"".join([self.own_ids[t] for t in self.merged(data)])

    def _split(self, text: str) -> list[str]:
        if not self.vocabulary.split_words:
            return [text]
        if text.isascii():
            return self.ascii_words.findall(text)
        if _has_unassigned(text):
            # Tables of Unicode differ in what is assigned lately; the library's own table decides.
            return [text[a:b] for _, (a, b) in _library().pre_tokenize_str(text)]
        return self.any_words.findall(text)

    def _plain(self, text: str) -> Iterator[bytes]:
        """Packed ids of a text without added tokens, in parts of bounded size.

        A space between two other characters always starts a word, so text may be cut there.
        """
        if self.vocabulary.prefix_space and text and not text.startswith(" "):
            text = " " + text
        at = 0
        while at < len(text):
            end = len(text)
            if self.vocabulary.split_words and end - at > 2 * SLICE_CHARS:
                cut = _CUT.search(text, at + SLICE_CHARS)
                end = cut.start() if cut else end
            yield b"".join(map(self.words.__getitem__, self._split(text[at:end])))
            at = end

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.added is None or not self.added.search(text):
            return b"".join(self._plain(text))
        out, at = [], 0
        for m in self.added.finditer(text):
            out += [*self._plain(text[at : m.start()]), self.vocabulary.added[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, *self._plain(text[at:])])

    # -- decoding ------------------------------------------------------------

    @cached_property
    def offsets(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens by id, end to end, and where each starts (one more than ids). Missing ids have no bytes."""
        v = self.vocabulary
        of = dict(zip(v.ids.tolist(), v.tokens)) | {i: c.encode() for c, i in v.added.items()}
        texts = [of.get(i, b"") for i in range(max(of) + 1)]
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def bytes_of(self, ids: np.ndarray) -> bytes:
        """The bytes behind ids; ids outside the vocabulary have none."""
        data, starts = self.offsets
        out = []
        for at in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[at : at + DECODED_AT_ONCE].astype(np.int64)
            part = part[(part >= 0) & (part < len(starts) - 1)]
            first, sizes = starts[part], starts[part + 1] - starts[part]
            before = np.cumsum(sizes) - sizes
            out.append(data[np.repeat(first - before, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text behind ids; bytes that are no UTF-8 become replacement characters."""
        return self.bytes_of(ids).decode("utf-8", "replace")


class _Words(dict):
    """Packed ids by word; forgets all when full."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        got = self.encoder.packed(word.encode())
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = got
        return got


_CUT = re.compile(r"(?<=\S) (?=\S)")
_KEPT: dict[str, object] = {}


def _has_unassigned(text: str) -> bool:
    """Whether Python's tables do not know a code point of the text. Rare ones are looked for first, by a small class."""
    if "rare" not in _KEPT:
        unknown = [c for c in range(0x10000) if unicodedata.category(chr(c)) == "Cn"]
        _KEPT["rare"] = re.compile(f"[{''.join(f'\\u{c:04x}' for c in unknown)}\U00010000-\U0010ffff]")
    return bool(_KEPT["rare"].search(text)) and any(unicodedata.category(c) == "Cn" for c in set(text))


def _library():
    if "library" not in _KEPT:
        from tokenizers.pre_tokenizers import ByteLevel

        _KEPT["library"] = ByteLevel(add_prefix_space=False, use_regex=True)
    return _KEPT["library"]


def load(spark: SparkSession, path: str = MODEL):
    """The vocabulary, broadcast: read once on the driver, of the size of the file."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(Vocabulary.parse(f.read()))


def encoder(shared) -> Encoder:
    """One encoder in each Python worker."""
    if _KEPT.get("of") != shared.value.mark:
        _KEPT["encoder"], _KEPT["of"] = Encoder(shared.value), shared.value.mark
    return _KEPT["encoder"]


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about `most` in sum, or one larger row."""
    at, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and held + n > most:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes)


def _text_sizes(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).to_numpy(zero_copy_only=False)


def _lists(packed: list[bytes]) -> tuple[pa.Array, pa.Array]:
    sizes = np.array([len(p) // 4 for p in packed], np.int64)
    ends = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), "<i4"))), pa.array(sizes)


def encoded(docs: DataFrame, model, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all but text if not given) with tokens (array of int) and n_tokens.

    Whole texts are encoded; null and empty texts have no tokens and keep their row. Own columns named tokens or n_tokens
    are replaced. Repeated rows are each encoded. An empty table gives an empty result.
    """
    keep = [c for c in (keep or docs.columns) if c not in ("text", "tokens", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            for a, b in _slices(_text_sizes(batch.column(len(keep))), SLICE_CHARS):
                part = batch.slice(a, b - a)
                tokens = _lists([own.encode(t) for t in part.column(len(keep)).to_pylist()])
                yield pa.record_batch([*part.columns[: len(keep)], *tokens], names=[*keep, "tokens", "n_tokens"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "tokens array<int>, n_tokens bigint"])
    return mapped(docs.select(*keep, F.coalesce("text", F.lit("")).alias("text")), run, schema)


def decoded(rows: DataFrame, model) -> DataFrame:
    """`rows` with text, decoded from tokens. An own column named text is replaced.

    Null tokens give an empty text; nulls among tokens and ids outside the vocabulary are passed over.
    """
    keep = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            lists = batch.column(keep.index("tokens"))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            for a, b in _slices(sizes, SLICE_CHARS // 4):
                part = batch.slice(a, b - a)
                texts = [
                    own.decode(np.zeros(0)) if not x.is_valid else own.decode(x.values.drop_null().to_numpy(zero_copy_only=False))
                    for x in part.column(keep.index("tokens"))
                ]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=[*keep, "text"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return mapped(rows.select(*keep), run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "text string"]))


def round_trip(docs: DataFrame, model) -> DataFrame:
    """doc_id, n_tokens, packed (ids as little-endian unsigned 32-bit integers), text (decoded from them) per row of `docs`.

    Encodes and decodes in one pass, so that tokens don't travel twice. Cases as in `encoded`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            for a, b in _slices(_text_sizes(batch.column(1)), SLICE_CHARS):
                packed = [own.encode(t) for t in batch.column(1).slice(a, b - a).to_pylist()]
                back = [own.decode(np.frombuffer(p, "<u4")) for p in packed]
                sizes = pa.array([len(p) // 4 for p in packed], pa.int64())
                columns = [batch.column(0).slice(a, b - a), sizes, pa.array(packed, pa.binary()), pa.array(back, pa.string())]
                yield pa.record_batch(columns, names=["doc_id", "n_tokens", "packed", "text"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return mapped(rows, run, "doc_id bigint, n_tokens bigint, packed binary, text string")
