"""Removal of byte strings that occurred before, by Burrows-Wheeler transforms of blocks of text.

A string of `length` bytes must be found wherever it occurs, yet no task may see the whole text. So the text is first
dealt into blocks by content: every window of `length` bytes has an anchor, the least hash among its `gram`-byte
substrings, and neighbouring windows with one anchor form a segment. Equal windows have equal anchors, so they meet in
the segments of one anchor. Equal segments collapse to their first occurrence before anything is grouped. What differs
is judged by the transform: the segments of a block are sorted into one Burrows-Wheeler transform, intervals of equal
prefixes grow backwards one byte a round, all at once, so that common prefixes come out in increasing order, and the
rounds stop at `length`. Windows left in one interval are equal; all but the first are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.frames import flat_bytes, id_or_none, mapped, release, stored, told_apart

LENGTH = 100
GRAM = 24
#: Bytes hashed at once; longer texts go in overlapping pieces.
PIECE = 1 << 16
#: Segment bytes in one transform.
BLOCK = 1 << 18
#: Anchors with more different segments than this are dealt out window by window.
SPLIT_ABOVE = 32768

#: Bytes that one round of backward extension puts in front.
WIDE = 8

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


# -- segments ----------------------------------------------------------------


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each `gram` bytes (a multiple of 8)."""
    n = len(data) - gram + 1
    words = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    out = words[:n] * _ODD[0]
    for k in range(8, gram, 8):
        out += words[k : k + n] * _ODD[k // 8 % 4]
        out ^= out >> np.uint64(32)
    out *= _ODD[3]
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours."""
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[: len(values) - width + 1], least[width - span :]) if span < width else least


def cut(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of one stretch of bytes: anchor hash, first window, number of windows."""
    hashes = gram_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64(0xFFFFF)
    # The leftmost of equal hashes is the anchor, so the place decides among them.
    anchor = sliding_least((hashes & ~low) | place, length - gram + 1)
    first = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
    sizes = np.diff(np.concatenate((first, [len(anchor)])))
    return hashes[(anchor[first] & low).astype(np.int64)], first, sizes


def _segments_of(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    """(key, row, first window, windows) arrays over texts laid end to end."""
    rows = len(starts) - 1
    row = 0
    while row < rows:
        last = max(row + 1, int(np.searchsorted(starts, starts[row] + PIECE, "right")) - 1)
        a, b = int(starts[row]), int(starts[last])
        for at in range(a, max(b - length + 1, a), PIECE):  # more than one piece only for one long text
            piece = data[at : min(b, at + PIECE + length - 1)]
            if len(piece) < length:
                continue
            key, first, size = cut(piece, length, gram)
            # Windows must lie in one text: cut segments where texts begin, drop windows over an end.
            begins = starts[row:last] - at
            inner = begins[(begins > 0) & (begins < len(piece) - length + 1)]
            points = np.union1d(first, inner)
            seg = np.searchsorted(first, points, "right") - 1
            ends = np.minimum(first[seg] + size[seg], np.append(points[1:], len(piece) - length + 1))
            owner = np.searchsorted(starts[row : last + 1], points + at, "right") - 1
            stop = starts[row + 1 + owner] - at - length + 1
            n = np.minimum(ends, stop) - points
            ok = n > 0
            yield key[seg[ok]], owner[ok] + row, points[ok] + at - starts[row + owner[ok]], n[ok]
        row = last


_SEGMENT = "key bigint, content bigint, id bigint, pos bigint, n int, again boolean"


def segments(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments of (id, base, text). `again`: its text held the same segment before."""

    digest = xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            base = batch.column(1).to_numpy(zero_copy_only=False)
            data, starts = flat_bytes(batch.column(2))
            whole = memoryview(np.ascontiguousarray(data))
            cuts = list(_segments_of(data, starts, length, gram))
            if not cuts:
                continue
            key, row, first, n = (np.concatenate(c) for c in zip(*cuts))
            a = first + starts[row]
            content = np.fromiter(
                map(digest, [whole[i:j] for i, j in zip(a.tolist(), (a + n + length - 1).tolist())]),
                np.uint64,
                len(a),
            )
            # Of equal segments in one text only the first has anything new.
            which = content ^ (key * _ODD[1]) ^ (row.astype(np.uint64) * _ODD[2])
            order = np.argsort(which, kind="stable")
            again = np.zeros(len(key), bool)
            again[order[1:]] = which[order[1:]] == which[order[:-1]]
            # Neighbouring repeats are one row; it has no partner to look for, so any key will do.
            joined = again[1:] & again[:-1] & (row[1:] == row[:-1]) & (first[1:] == first[:-1] + n[:-1])
            head = np.concatenate(([True], ~joined))
            n = np.add.reduceat(n, np.flatnonzero(head))
            key, content, row, first, again = (x[head] for x in (key, content, row, first, again))
            pos = base[row] + first
            key = np.where(again, (pos.astype(np.uint64) + ids[row].astype(np.uint64)) * _ODD[0], key)
            yield pa.record_batch(
                [key.view(np.int64), content.view(np.int64), ids[row], pos, n.astype(np.int32), again],
                names=["key", "content", "id", "pos", "n", "again"],
            )

    return mapped(rows, run, _SEGMENT)


# -- the transform -----------------------------------------------------------


def packed(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next WIDE bytes of each place as one number; nothing beyond the segment counts."""
    n = len(data)
    key = np.zeros(n, np.uint64)
    for k in range(WIDE):
        byte = np.zeros(n, np.uint64)
        byte[: max(n - k, 0)] = data[k:]
        byte += np.uint64(1)  # 0 is the end of a segment; 255 is not in UTF-8
        byte[left <= k] = 0
        key = (key << np.uint64(8)) | byte
    return key


def _sorted_rows(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of `key` (which has `bits` bits), and where it differs from the row before."""
    room = len(key).bit_length()
    if bits + room <= 63:  # sorting values that hold their place is twice as fast as sorting places
        both = np.sort((key.astype(np.int64) << room) | np.arange(len(key)))
        ranked, order = both >> room, both & ((1 << room) - 1)
    else:
        order = np.argsort(key)
        ranked = key[order]
    return order, np.concatenate(([False], ranked[1:] != ranked[:-1]))


def suffix_order(key: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first `depth` bytes at least, each ending with its segment."""
    n, span = len(key), 5
    bits = n.bit_length()
    key, used = key >> np.uint64(8 * (WIDE - span)), 8 * span
    while True:
        order, differ = _sorted_rows(key, used)
        if span >= depth:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(differ)
        ahead = np.zeros(n, np.int64)
        ahead[: max(n - span, 0)] = rank[span:] + 1
        ahead[left <= span] = 0
        key, used = (rank << bits) | ahead, 2 * bits
        span *= 2


def equal_prefixes(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the segments in `data`; for each row its common prefix with the row before, as found.

    Breadth-first backward extension of the intervals of the sorted column, with blocks of WIDE bytes as letters:
    round k knows the borders of the intervals whose rows share k blocks. Putting one block in front of an interval
    gives an interval one block longer, so two neighbours with one first block are parted in round k + 1 if the rows
    after that block lie in different intervals of round k. Borders appear in increasing order of the common prefix,
    each row once, and the rounds stop at `length`: values are exact in whole blocks, `length` stands for that or more.
    """
    n, m = len(data), len(sizes)
    segment = np.repeat(np.arange(m), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    key = packed(data, left)
    order = suffix_order(key, left, length)
    # Rows 0 to m - 1 of the column are the ends of the segments; row m + i is order[i].
    place = np.empty(n + WIDE, np.int32)
    place[order] = np.arange(m, m + n, dtype=np.int32)
    # The row that the row's first WIDE bytes stand in front of.
    after = np.where(left > WIDE, place[WIDE:], segment)[order]

    def parted(width: int) -> np.ndarray:
        first = (key >> np.uint64(8 * (WIDE - width)))[order]
        short = (left < width)[order]
        return np.concatenate(([True], (first[1:] != first[:-1]) | short[1:] | short[:-1]))

    # A first round of `length` modulo WIDE bytes lets the others end at `length`.
    known = length % WIDE or WIDE
    border = np.ones(m + n, bool)
    border[m:] = parted(known)
    common = np.where(border[m:], 0, length)
    block = parted(WIDE)
    while known < length:
        following = np.cumsum(border, dtype=np.int32)[after]
        part = block.copy()
        part[1:] |= following[1:] != following[:-1]
        common[part & ~border[m:]] = known
        border[m:] |= part
        known += WIDE
    return order, common


def repeated_windows(data: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """Places in `data` whose `length` bytes, inside their segment, occur at a smaller place too."""
    order, common = equal_prefixes(data, sizes, length)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
    group = np.cumsum(common < length)
    whole = left[order] >= length
    least = np.full(group[-1] + 1, len(data))
    np.minimum.at(least, group[whole], order[whole])
    return np.sort(order[whole & (order != least[group])])


def _judge(rows: list[tuple], length: int) -> Iterator[tuple[int, int, int]]:
    """(id, pos, windows) of the runs of repeats in segments (id, pos, n, bytes), given in any order."""
    rows.sort(key=lambda r: r[:2])
    sizes = np.array([len(r[3]) for r in rows])
    found = repeated_windows(np.frombuffer(b"".join(r[3] for r in rows), np.uint8), sizes, length)
    starts = np.cumsum(sizes) - sizes
    of = np.searchsorted(starts, found, "right") - 1
    new = np.concatenate(([True], (found[1:] != found[:-1] + 1) | (of[1:] != of[:-1])))[: len(found)]
    heads = np.flatnonzero(new)
    for a, n in zip(heads.tolist(), np.diff(np.append(heads, len(found))).tolist()):
        r = rows[of[a]]
        yield r[0], r[1] + int(found[a] - starts[of[a]]), n


def judged(rows: DataFrame, length: int, block: int) -> DataFrame:
    """Repeats among segments (key, id, pos, n, bytes). Whole keys go to a block; a block has `block` bytes or one key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def out(held):
            got = list(_judge(held, length))
            if got:
                ids, pos, n = (np.array(c) for c in zip(*got))
                yield pa.record_batch([ids, pos, n.astype(np.int32)], names=["id", "pos", "n"])

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= block and key != last:
                    yield from out(held)
                    held, size = [], 0
                held.append(tuple(row))
                size += len(row[3])
                last = key
        if held:
            yield from out(held)

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # work follows bytes many times over
    dealt = rows.select("key", "id", "pos", "n", "bytes").repartition(tasks, "key").sortWithinPartitions("key")
    return mapped(dealt, run, "id bigint, pos bigint, n int")


# -- the whole ---------------------------------------------------------------


def _keyed(docs: DataFrame) -> tuple[DataFrame, Column]:
    """All columns as c0, c1 and so on, with _text and _base, and the id to compare: the row's own number if ids repeat.

    _base is where a row begins among those of its id: at 0, since every row has an id of its own here.
    """
    at = docs.columns.index("doc_id")
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).withColumn("_base", F.lit(0).cast("bigint"))
    rows = rows.withColumnRenamed(f"c{docs.columns.index('text')}", "_text")
    key = id_or_none(f"c{at}")
    numbered = told_apart(rows, key, "_text", "_row")
    return (rows, key) if numbered is None else (numbered, F.col("_row"))


def repeats(
    keyed: DataFrame, own_id: Column, length: int, gram: int, block: int, split_above: int
) -> DataFrame:
    """(id, pos, n, level, first): runs of n windows from pos that repeat, unless a row with `first` has the same place."""
    segs = stored(segments(keyed.select(own_id, "_base", F.coalesce("_text", F.lit(""))), length, gram), "segments")
    shared = segs.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(F.col("key").alias("_key"))
    met = stored(
        segs.join(shared.hint("shuffle_hash"), F.col("key") == F.col("_key"), "left")
        .where("again OR _key IS NOT NULL")
        .drop("_key"),
        "shared-segments",
    )
    release(segs)
    occurrence = met.select("id", "pos", "n", F.lit(0).alias("level"), F.lit(False).alias("first"))
    firsts = met.where("NOT again").groupBy("key", "content").agg(F.min(F.struct("id", "pos", "n")).alias("at"))
    firsts = firsts.select("key", "at.*")
    varied = firsts.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    heads = firsts.join(varied.select(F.col("key").alias("_key")), F.col("key") == F.col("_key")).drop("_key")
    crowded = heads.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > split_above)
    crowded = crowded.select(F.col("key").alias("_key"))
    places = heads.join(crowded, F.col("key") == F.col("_key"), "left").select(
        "id", "pos", "n", "key", F.col("_key").isNotNull().alias("split")
    )
    by_text = places.groupBy("id").agg(F.collect_list(F.struct("pos", "n", "key", "split")).alias("s"))
    cut_out = (
        keyed.join(by_text, own_id == F.col("id"))
        .select("id", "_base", F.col("_text").cast("binary").alias("_bytes"), F.explode("s").alias("s"))
        .where("s.pos >= _base AND s.pos < _base + octet_length(_bytes)")
        .select("id", "s.*", F.expr(f"substring(_bytes, int(s.pos - _base) + 1, s.n + {length - 1})").alias("bytes"))
    )
    kept = firsts.select("id", "pos", "n", F.lit(0).alias("level"), F.lit(True).alias("first"))
    by_transform = judged(cut_out.where("NOT split"), length, block).select(
        "id", "pos", "n", F.lit(1).alias("level"), F.lit(False).alias("first")
    )
    single = (
        cut_out.where("split")
        .select("id", F.expr("posexplode(transform(sequence(1, n), i -> md5(substring(bytes, i, %d))))" % length), "pos")
        .toDF("id", "at", "window", "pos")
        .select("id", (F.col("pos") + F.col("at")).alias("pos"), "window")
    )
    single_first = single.groupBy("window").agg(F.min(F.struct("id", "pos")).alias("at")).select("at.*")
    columns = ("id", "pos", F.lit(1).alias("n"), F.lit(2).alias("level"))
    return (
        occurrence.union(kept)
        .union(by_transform)
        .union(single.select(*columns, F.lit(False).alias("first")))
        .union(single_first.select(*columns, F.lit(True).alias("first")))
    )


_RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, spans array<struct<start:bigint,stop:bigint>>"


def _covered(n: int, pos: np.ndarray, count: np.ndarray, level: np.ndarray, first: np.ndarray, length: int):
    """Starts and stops of the maximal runs of covered bytes of a text of n bytes."""
    kept = (pos * 3 + level)[first]
    gone = (pos >= 0) & (pos < n) & ~first
    if len(kept):
        gone &= ~np.isin(pos * 3 + level, kept)
    a, b = pos[gone], np.minimum(pos[gone] + count[gone] + length - 1, n)
    order = np.argsort(a)
    a, reach = a[order], np.maximum.accumulate(b[order])
    new = np.concatenate(([True], a[1:] > reach[:-1]))[: len(a)]
    return a[new], reach[np.concatenate((new[1:], [True]))[: len(a)]]


def _left(text: bytes, starts: list[int], stops: list[int]) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)]))


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    block: int = BLOCK,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans, kept (the remaining bytes) and spans (start, stop) of what goes.

    A byte goes if it lies in a `length`-byte string that also starts earlier: in a smaller doc_id, or earlier in the
    same text. Judged on the input as a whole. Null texts count as empty. Null ids come first. Rows that share an id
    follow each other in the order of their texts' first 64 characters, then of a hash, so a repeated row goes as a later
    copy; an id may hold any number of rows. Own columns of these names are replaced; others are kept. An empty table
    gives an empty result.
    """
    if gram % 8 or not 8 <= gram <= length:
        raise ValueError("gram: a multiple of 8, at most length")
    own = ["n_bytes", "n_removed", "n_spans", "kept", "spans"]
    docs = docs.drop(*own)
    keyed, own_id = _keyed(docs)
    found = (
        stored(repeats(keyed, own_id, length, gram, block, split_above), "repeats")
        .groupBy("id")
        .agg(F.collect_list(F.struct("pos", "n", "level", "first")).alias("_found"))
    )
    rows = keyed.join(found, own_id == F.col("id"), "left")
    rows = rows.select(*[c for c in keyed.columns if c != "_row"], "_found")
    text_at = docs.columns.index("text")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.num_columns - 2
            base = batch.column(width).to_numpy(zero_copy_only=False)
            data, starts = flat_bytes(batch.column(text_at))
            lists = batch.column(width + 1)
            flat = lists.flatten()
            lens = np.asarray(pa.compute.list_value_length(lists).fill_null(0), np.int64)
            ends = np.cumsum(lens)
            pos, count, level, first = (
                f.to_numpy(zero_copy_only=False) for f in flat.flatten()
            )
            out: dict[str, list] = {c: [] for c in own}
            whole = data.tobytes()
            for i, n in enumerate(lens.tolist()):
                text, s = whole[starts[i] : starts[i + 1]], slice(ends[i] - n, ends[i])
                a, b = [], []
                if n:
                    runs = _covered(len(text), pos[s] - base[i], count[s], level[s], first[s], length)
                    a, b = runs[0].tolist(), runs[1].tolist()
                out["n_bytes"].append(len(text))
                out["n_removed"].append(sum(b) - sum(a))
                out["n_spans"].append(len(a))
                out["kept"].append(_left(text, a, b))
                out["spans"].append([{"start": x, "stop": y} for x, y in zip(a, b)])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
            yield pa.record_batch(
                [*batch.columns[:width], *(pa.array(out[c], k) for c, k in zip(own, kinds))],
                names=[*names, *own],
            )

    return mapped(rows, run, f"{schema}{', ' if schema else ''}{_RESULT}")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """`docs` with the text that is left; characters of which any byte stays are kept whole, n_chars follows.

    Cases as in `remove_repeats`, but no own column is replaced.
    """
    columns = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]
    own = docs.toDF(*columns)
    judged_rows = remove_repeats(own, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index("text")
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist()
            new = []
            for text, cuts in zip(texts, spans):
                if cuts:
                    raw, starts, stops = text.encode(), [], []
                    for c in cuts:
                        a, b = c["start"], c["stop"]
                        while a < b and raw[a] & 0xC0 == 0x80:  # inside a character: its first bytes stay
                            a += 1
                        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                            b -= 1
                        starts.append(min(a, b))
                        stops.append(max(a, b))
                    text = _left(raw, starts, stops).decode()
                new.append(text)
            yield pa.record_batch(
                [*batch.columns[:at], pa.array(new, batch.column(at).type), *batch.columns[at + 1 : len(columns)]],
                names=columns,
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    left = mapped(judged_rows.select(*columns, "spans"), run, schema).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left
