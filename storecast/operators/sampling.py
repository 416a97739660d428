"""Samples of an exact size, and copies of sampled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 32
LEVEL_BITS = 12
# Once the undecided hash range holds no more rows than this, they are sorted.
SORTED_ROWS = 100_000


def default_hash(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(2**HASH_BITS))


def exact_sample(
    df: DataFrame,
    fraction: float,
    key: str,
    hashed: Column | None = None,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """int(rows x fraction) rows without replacement, the same ones every time.

    Rows are taken in order of (hash of key, key); `key` is unique. The cut is
    found by counting rows per hash range, at most 4096 ranges at a time; only
    rows of the last undecided range are sorted. `hashed` replaces the default
    hash and gives integers from 0 to 2^32 - 1.
    """
    hashed = default_hash(key) if hashed is None else hashed
    marked = df.withColumn("__hash", hashed)
    low, width = 0, 2**HASH_BITS
    wanted = None
    while True:
        step = max(width >> LEVEL_BITS, 1)
        inside = marked.where(F.col("__hash").between(low, low + width - 1))
        cell = F.floor((F.col("__hash") - F.lit(low)) / F.lit(step)).cast("long")
        counts = dict(
            (row[0], row[1]) for row in inside.groupBy(cell).agg(F.count(F.lit(1))).collect()
        )
        if wanted is None:
            wanted = int(sum(counts.values()) * fraction)
            if wanted <= 0:
                return df.limit(0)
        open_cell, held = None, 0
        for number in sorted(counts):
            if counts[number] >= wanted:
                open_cell, held = number, counts[number]
                break
            wanted -= counts[number]
        if open_cell is None:
            return df
        low, width = low + open_cell * step, step
        if held == wanted or held <= sorted_rows or width == 1:
            break
    if held == wanted:
        return marked.where(F.col("__hash") < low + width).drop("__hash")
    below = marked.where(F.col("__hash") < low)
    undecided = marked.where(F.col("__hash").between(low, low + width - 1))
    return below.unionAll(undecided.orderBy("__hash", key).limit(wanted)).drop("__hash")


def append_copies(
    df: DataFrame, fraction: float, key: str, hashed: Column | None = None
) -> DataFrame:
    """The frame plus copies of an exact sample of its rows."""
    return df.unionAll(exact_sample(df, fraction, key, hashed))
