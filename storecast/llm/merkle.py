"""Document fingerprints: Merkle trees over sections, paragraphs and the pieces of paragraphs.

A paragraph is a line; it is cut into pieces after words that their own bytes choose, so that an edit changes the pieces
it touches and no others. Sections end with an empty line, or with a paragraph that its digest chooses. Digests of
pieces make the digest of the paragraph, those the section's, those the root. A fingerprint is the root and, for each
piece, 32 bits of its digest, its size and whether it ends a paragraph or a section: equal roots mean equal texts, and
two fingerprints tell which branches differ, and how much they share.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.frames import id_or_none, mapped, told_apart

#: One word in 2**PIECE_BITS ends a piece, one paragraph in 2**SECTION_BITS a section.
PIECE_BITS = 2
SECTION_BITS = 3
#: Longest piece in bytes; its size fits 12 bits.
LONGEST = 128

_MIX = np.uint64(0x9E3779B97F4A7C15)
_END_PARAGRAPH, _END_SECTION = 1 << 12, 1 << 13


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _cuts(raw: bytes) -> list[int]:
    """Ends of the pieces of a text."""
    n = len(raw)
    data = np.frombuffer(raw, np.uint8)
    chosen = data == 10
    if n >= 8:
        before = np.ndarray(n - 7, "<u8", data, strides=(1,)) * _MIX
        chosen[7:] |= (data[7:] == 32) & (before >> np.uint64(64 - PIECE_BITS) == 0)
    ends = np.flatnonzero(chosen) + 1
    out, last = [], 0
    for end in [*ends.tolist(), n]:
        out.extend(range(last + LONGEST, end, LONGEST))
        if end > last:
            out.append(end)
        last = end
    return out


class Tree(NamedTuple):
    """Digests of all levels; `leaves` packs digest, size and ends of each piece."""

    root: bytes
    sections: list[bytes]
    leaves: np.ndarray

    @property
    def fingerprint(self) -> str:
        packed = self.leaves.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]  # 32 bits of digest, 16 of mark
        return f"{self.root.hex()}:{base64.b64encode(packed.tobytes()).decode()}"


def tree(text: str) -> Tree:
    raw = text.encode()
    leaves, sections, paragraphs, pieces = [], [], [], []
    last = 0
    ends = _cuts(raw)
    for end in ends:
        piece = raw[last:end]
        digest = _digest(piece)
        mark = end - last
        pieces.append(digest)
        if piece[-1] == 10 or end == len(raw):
            mark |= _END_PARAGRAPH
            paragraph = _digest(b"p" + b"".join(pieces))
            paragraphs.append(paragraph)
            # The choice looks at the paragraph only, so a section ends in the same place after an edit elsewhere.
            if piece == b"\n" or paragraph[0] >> (8 - SECTION_BITS) == 0 or end == len(raw):
                mark |= _END_SECTION
                sections.append(_digest(b"s" + b"".join(paragraphs)))
                paragraphs = []
            pieces = []
        leaves.append(int.from_bytes(digest[:4], "big") << 16 | mark)
        last = end
    return Tree(_digest(b"r" + b"".join(sections)), sections, np.array(leaves, np.uint64))


def _parsed(fingerprint: str) -> tuple[str, np.ndarray]:
    root, packed = fingerprint.split(":")
    data = np.frombuffer(base64.b64decode(packed), np.uint8).reshape(-1, 6)
    leaves = np.zeros((len(data), 8), np.uint8)
    leaves[:, :6] = data
    return root, leaves.view("<u8").ravel()


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Bytes of the pieces that two lists have in common, repeats counted."""
    common = Counter((a & ~np.uint64(0xF000)).tolist()) & Counter((b & ~np.uint64(0xF000)).tolist())
    return sum((x & 0xFFF) * n for x, n in common.items())


def _size(leaves: np.ndarray) -> int:
    return int((leaves & np.uint64(0xFFF)).sum())


def _alike(root_a, a: np.ndarray, root_b, b: np.ndarray) -> float:
    if root_a == root_b:
        return 1.0
    total = _size(a) + _size(b)
    return min(2 * _shared(a, b) / total, 1.0) if total else 1.0


def likeness(a: str, b: str) -> float:
    """Share of bytes in pieces that two fingerprints share, 0 to 1; 1 for equal roots."""
    (root_a, x), (root_b, y) = _parsed(a), _parsed(b)
    return _alike(root_a, x, root_b, y)


def _branches(leaves: np.ndarray) -> list[list[list[int]]]:
    """Sections of paragraphs of packed pieces."""
    out: list[list[list[int]]] = [[[]]]
    for x in leaves.tolist():
        out[-1][-1].append(x)
        if x & _END_SECTION:
            out.append([[]])
        elif x & _END_PARAGRAPH:
            out[-1].append([])
    return [s for s in out if s != [[]]]


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """Byte ranges of the first text whose branches the second lacks: only differing sections, then paragraphs, are entered."""
    (root_a, x), (root_b, y) = _parsed(a), _parsed(b)
    if root_a == root_b:
        return []
    theirs = _branches(y)
    sections = {str(s) for s in theirs}
    paragraphs = {str(p) for s in theirs for p in s}
    pieces = {v & ~0xF000 for s in theirs for p in s for v in p}
    out, at = [], 0
    for section in _branches(x):
        same_section = str(section) in sections
        for paragraph in section:
            same = same_section or str(paragraph) in paragraphs
            for piece in paragraph:
                size = piece & 0xFFF
                if not same and piece & ~0xF000 not in pieces:
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], at + size)
                    else:
                        out.append((at, at + size))
                at += size
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of each row of `docs`. Null texts count as empty; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [tree(t).fingerprint for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")))
    return mapped(rows, run, "doc_id bigint, fingerprint string")


# -- a document, its edited text and the next document -------------------------


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by as many first ones of the text that follows."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _block_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted `bounds` are at most `value`, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def longs(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("bigint") for v in values])

    group = F.size(F.filter(longs([g[0] for g in groups]), lambda b: b <= value))
    inside = F.element_at(F.array(*map(longs, groups)), group)
    return F.when(group == 0, 0).otherwise((group - 1) * width + F.size(F.filter(inside, lambda b: b <= value)))


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that with the next doc_id; after the last comes the first. Null texts count as empty, null ids
    come first, rows that share an id follow each other in the order of their texts' first 64 characters, then of a hash;
    an id may hold any number of rows. A document alone is its own next.
    Empty texts are alike (1). Other columns are ignored. An empty table gives an empty result.

    Rows are dealt into as many ranges of ids as there are shuffle partitions. A range is one sorted stream; the first
    row of each range also goes, as a look ahead, to the range before it.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(id_or_none("doc_id").alias("id"), F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = told_apart(rows, F.col("id"), "text", "_row")
    if numbered is not None:
        rows = numbered.select(F.col("_row").alias("id"), "doc_id", "text")
    steps = [i / tasks for i in range(1, tasks)]
    found = rows.agg(F.percentile_approx("id", steps or [0.5], 10 * tasks).alias("b")).first().b or []
    blocked = rows.withColumn("block", _block_of(F.col("id"), sorted(set(found))))
    # One number per range on the driver, as many as tasks.
    firsts = [(r.block, r.id) for r in blocked.groupBy("block").agg(F.min("id").alias("id")).orderBy("block").collect()]
    if not firsts:
        return spark.createDataFrame([], _RESULT)
    before = [(firsts[i - 1][0], first) for i, (_, first) in enumerate(firsts)]
    ahead = spark.createDataFrame(before, "block int, id bigint")
    both = blocked.select("block", F.lit(0).alias("ahead"), "id", "doc_id", "text").union(
        rows.join(F.broadcast(ahead), "id").select("block", F.lit(1), "id", "doc_id", "text")
    )
    dealt = both.repartition(tasks, "block").sortWithinPartitions("block", "ahead", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _RESULT.split(", ")]
        out: list[tuple] = []
        held = None  # block, doc_id, text, tree

        def batch_of(out):
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for block, is_ahead, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if held and held[0] != block:
                    held = None
                if is_ahead and not held:
                    continue  # the range before it is empty
                own = tree(text)
                if held:
                    _, prev_id, prev_text, prev = held
                    changed = edited(prev_text, text)
                    new = tree(changed)
                    out.append(
                        (
                            prev_id,
                            len(prev_text),
                            hashlib.sha256(changed.encode()).hexdigest(),
                            prev.fingerprint,
                            new.fingerprint,
                            _alike(prev.root, prev.leaves, new.root, new.leaves),
                            _alike(prev.root, prev.leaves, own.root, own.leaves),
                        )
                    )
                    if len(out) >= 256:
                        yield batch_of(out)
                        out = []
                held = None if is_ahead else (block, doc_id, text, own)
        if out:
            yield batch_of(out)

    return mapped(dealt, run, _RESULT)
