"""Near-duplicates by SimHash fingerprints, found through deletion variants.

The 64 bits are cut into fewer segments than a pigeonhole on exact segments needs: with `s` segments and at most `d`
differing bits, d < 2s, one segment differs in one bit or none. Every fingerprint is indexed under each segment with
each single bit left out; two such fingerprints share an entry, and what shares one is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.components import components
from storecast.llm.frames import flat_bytes, mapped, stored, text_or_empty

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
#: Entries with more fingerprints are linked in runs of so many, and dealt out again where that leaves them apart.
SPLIT_ABOVE = 4096
#: Up to this size all neighbours in an entry are compared at once, beyond it by a search.
SMALL_ENTRY = 8

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PLACES = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def shingles(text: bytes, size: int) -> list[bytes]:
    """Word shingles, repeats included; a text of fewer words is one shingle, one without words has none."""
    words = text.translate(_LOWER).split()  # ASCII white space only
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - size])).tolist()
    return [whole[a:b] for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]


def fingerprints_of(texts: list[bytes], size: int) -> np.ndarray:
    """One unsigned fingerprint per text: the bits set in over half of the shingle hashes."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for row, text in enumerate(texts):
        hashes = np.fromiter((digest(s, HASH_SEED) for s in shingles(text, size)), np.uint64)
        if len(hashes):
            counts = np.zeros(BITS, np.int64)
            for at in range(0, len(hashes), 65536):  # a long text stays small in memory
                part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[row] = _PLACES[2 * counts > len(hashes)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed number), mark (a hash of the text) for each row of `docs`.

    Null and empty texts, and texts of white space, have fingerprint 0. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat_bytes(batch.column(1))
            whole, ends = data.tobytes(), starts.tolist()
            texts = [whole[a:b] for a, b in zip(ends, ends[1:])]
            fps = fingerprints_of(texts, shingle_words).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(fps), batch.column(2)], names=["doc_id", "fp", "mark"])

    text = text_or_empty("text")
    rows = docs.select(F.col("doc_id").cast("bigint"), text, F.xxhash64(text))
    return mapped(rows, run, "doc_id bigint, fp bigint, mark bigint")


def segments(bits: list[int], parts: int) -> list[list[int]]:
    """`bits` cut into `parts` runs of nearly equal size."""
    cuts = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _variants(fp: Column, bits: list[int], parts: int) -> Column:
    """Array of (bits left in, their value): every segment with every single bit left out."""
    kept = [_mask([x for x in part if x != b]) for part in segments(bits, parts) for b in part]
    masks = [F.lit(k).cast("bigint") for k in kept]
    return F.array(*[F.struct(k.alias("mask"), fp.bitwiseAND(k).alias("value")) for k in masks])


def variant_rows(nodes: DataFrame, parts: int) -> DataFrame:
    """(held, entry, fp): one row for each of the 64 entries of each fingerprint. held are the bits an entry agrees on."""
    return nodes.select("fp", F.explode(_variants(F.col("fp"), list(range(BITS)), parts)).alias("v")).select(
        F.col("v.mask").alias("held"), F.col("v.value").alias("entry"), "fp"
    )


def _mixed(*columns: np.ndarray) -> np.ndarray:
    """One 64-bit number out of several; equal inputs give equal numbers."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def split_rows(hot: DataFrame, parts: int) -> DataFrame:
    """Entries of the bits that the row's own entry does not hold, for entries that are too large.

    Two fingerprints of one entry agree on the bits it holds, so all their differing bits are among the rest, and the same
    argument finds them again there. Numbers that mix to the same entry by chance are told apart when compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, entry, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            out = []
            for own in np.unique(held):
                at = held == own
                rest = [b for b in range(BITS) if not int(own) >> b & 1]
                for part in segments(rest, parts):
                    for bit in part:
                        kept = np.full(at.sum(), _mask([b for b in part if b != bit]))
                        out.append((held[at] | kept, _mixed(entry[at], kept, fp[at] & kept), fp[at]))
            columns = [np.concatenate(c) for c in zip(*out)]
            if out:
                yield pa.record_batch([pa.array(c) for c in columns], names=["held", "entry", "fp"])

    return mapped(hot.select("held", "entry", "fp"), run, "held bigint, entry bigint, fp bigint")


def _search(fps: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join what is reachable in `fps`, one fewer than the members of each component."""
    out, left = [], fps
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= most
            found = left[near]
            if len(found):
                out.append((np.full(len(found), x), found))
                queue.extend(found)
                left = left[~near]
    return out


def links_in(keys: np.ndarray, fps: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links among rows sorted by key."""
    edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate(([0], edges))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    of_row = np.repeat(sizes, sizes)
    out = []
    for gap in range(1, SMALL_ENTRY):
        near = (keys[gap:] == keys[:-gap]) & (of_row[gap:] <= SMALL_ENTRY)
        at = np.flatnonzero(near)
        at = at[np.bitwise_count(fps[at] ^ fps[at + gap]) <= most]
        out.append((fps[at], fps[at + gap]))
    for a, n in zip(starts[sizes > SMALL_ENTRY].tolist(), sizes[sizes > SMALL_ENTRY].tolist()):
        out += _search(fps[a : a + n], most)
    return out


def entry_links(rows: DataFrame, most: int, limit: int) -> DataFrame:
    """(a, b, held, entry): links between the fingerprints of an entry; rows of entries above `limit` come with a null b.

    Of an entry no more than `limit` rows are held at once: a longer one is linked run by run, in the order of its
    fingerprints, and its rows are listed, as links between the runs are missing.
    """
    names = ["a", "b", "held", "entry"]

    def linked(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = links_in(keys, fps.view(np.uint64), most)
        a = np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint64)]).view(np.int64)
        b = np.concatenate([y for _, y in found] or [np.zeros(0, np.uint64)]).view(np.int64)
        if len(a):
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
            none = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1]), none, none], names=names)

    def listed(held: int, entry: int, fps: np.ndarray) -> pa.RecordBatch:
        n = len(fps)
        own = [pa.array(np.full(n, held)), pa.array(np.full(n, entry))]
        return pa.record_batch([pa.array(fps), pa.nulls(n, pa.int64()), *own], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The entry that the last rows belong to, its rows since the last run, and whether it had a run before.
        last, kept, long = None, np.zeros(0, np.int64), False

        def closed() -> Iterator[pa.RecordBatch]:
            yield from linked(np.zeros(len(kept), np.int64), kept)
            if long and len(kept):
                yield listed(*last, kept)

        for batch in batches:
            if not batch.num_rows:
                continue
            held, entry, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((held[1:] != held[:-1]) | (entry[1:] != entry[:-1])) + 1
            first, final = (int(cuts[0]), int(cuts[-1])) if len(cuts) else (len(fps), 0)
            if last == (held[0], entry[0]):
                kept = np.concatenate([kept, fps[:first]])
            else:
                yield from closed()
                last, kept, long = (held[0], entry[0]), fps[:first], False
            while len(kept) > limit:
                yield from linked(np.zeros(limit, np.int64), kept[:limit])
                yield listed(*last, kept[:limit])
                kept, long = kept[limit:], True
            if not len(cuts):
                continue
            yield from closed()
            # Whole entries of one batch, all together but for long ones.
            bounds = [first, *cuts[1:].tolist()]
            small = np.ones(final - first, bool)
            for a, b in zip(bounds, bounds[1:]):
                if b - a > limit:
                    small[a - first : b - first] = False
                    for at in range(a, b, limit):
                        part = fps[at : min(at + limit, b)]
                        yield from linked(np.zeros(len(part), np.int64), part)
                        yield listed(held[a], entry[a], part)
            keys = np.zeros(final - first, np.int64)
            keys[np.array(bounds[1:-1], np.int64) - first] = 1
            yield from linked(np.cumsum(keys)[small], fps[first:final][small])
            last, kept, long = (held[-1], entry[-1]), fps[final:], False
            while len(kept) > limit:
                yield from linked(np.zeros(limit, np.int64), kept[:limit])
                yield listed(*last, kept[:limit])
                kept, long = kept[limit:], True
        if last is not None:
            yield from closed()

    sorted_rows = rows.repartition("held", "entry").sortWithinPartitions("held", "entry", "fp")
    return mapped(sorted_rows, run, "a bigint, b bigint, held bigint, entry bigint")


def undecided(hot: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (held, entry, fp) of entries whose fingerprints lie in several components; others need no more links."""
    rooted = hot.join(roots, hot.fp == roots.node, "left").select("held", "entry", "fp", F.coalesce("root", "fp").alias("root"))
    spread = rooted.groupBy("held", "entry").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b")
    return rooted.join(spread.select("held", "entry"), ["held", "entry"], "left_semi").select("held", "entry", "fp")


def joined(nodes: DataFrame, max_bits: int = MAX_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(node, root) of the fingerprints (fp) reachable from a smaller one over steps of `max_bits` or fewer bits.

    Entries above `split_above` are linked run by run first. Only if their members still lie in several components are
    they dealt out again by the bits they do not hold, and so on: every round holds more bits, until an entry of the few
    left cannot be too large any more.
    """
    parts = max(1, (max_bits + 2) // 2)
    rows, roots, limit = variant_rows(nodes.select("fp"), parts), None, split_above
    while True:
        found = stored(entry_links(rows, max_bits, limit), "links")
        links = found.where("b is not null").select("a", "b")
        roots = components(links if roots is None else links.union(roots.select("node", "root")))
        hot = found.where("b is null").select("held", "entry", F.col("a").alias("fp"))
        if hot.isEmpty():
            return roots
        hot = stored(undecided(hot, roots), "undecided")
        if hot.isEmpty():
            return roots
        # An entry with more rows than this has two bits at least for each part, so the next round holds more of them.
        rows, limit = split_rows(hot, parts), max(split_above, 4**parts)


def _grouped(docs: DataFrame, shingle_words: int, max_bits: int, split_above: int) -> DataFrame:
    """doc_id, mark, fp, root (of the fingerprint's component), component_id for each row of `docs`."""
    prints = stored(fingerprints(docs, shingle_words), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = joined(nodes, max_bits, split_above)
    member = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(member.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of `docs`.

    Fingerprints that differ in `max_bits` or fewer bits are linked; component_id is the smallest doc_id reachable,
    null only if no row of the component has an id. Rows with equal fingerprints are one node, so copies are never
    paired; rows that repeat a doc_id are each judged by their own text. Fingerprint 0 (no words) is linked like any
    other. An empty table gives an empty result. Columns other than doc_id and text are ignored.
    """
    return _grouped(docs, shingle_words, max_bits, split_above).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component, the document with the smallest id stays.

    Several rows of a component with that id, or a component without ids, leave one text, and of rows alike in id and
    text any one. Columns are kept as they are.
    """
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    judged = _grouped(docs, shingle_words, max_bits, split_above)
    kept = (
        judged.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("doc_id").alias("_id"), F.min("mark").alias("_mark"))
        .drop("root")
    )
    mark = F.xxhash64(F.coalesce(text, F.lit("")))
    stay = own.join(kept, doc_id.eqNullSafe(F.col("_id")) & (mark == F.col("_mark")), "left_semi")
    if not judged.groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        stay = stay.dropDuplicates([f"c{docs.columns.index(c)}" for c in ("doc_id", "text")])
    return stay.toDF(*docs.columns)
