"""Sharding over a fixed number of virtual slots.

Records are hashed into thousands of slots once and for all. Bytes are summed per slot, and a small versioned map says
which shard holds a slot. Rebalancing edits the map, never the hash: a new version lists what moved.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storecast.llm.frames import text_or_empty

SLOTS = 4096
SHARDS = 16


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, slot_id for each row of `docs`.

    The slot follows from doc_id and text, so rows that share an id (or have none) still spread; rows alike in both
    share a slot. Null texts count as empty. Other columns are ignored.
    """
    raw = F.encode(text_or_empty("text"), "UTF-8")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text_or_empty("text")) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)).cast("int").alias("slot_id"),
    )


def slot_totals(rows: DataFrame) -> DataFrame:
    """slot_id, bytes, rows of every slot in use."""
    return rows.groupBy("slot_id").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(totals: dict[int, int], slots: int = SLOTS, shards: int = SHARDS) -> dict[int, int]:
    """Slot to shard: largest slots first, each to the shard with the fewest bytes."""
    load = [(0, 0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-totals.get(s, 0), s)):
        size, count, shard = heapq.heappop(load)
        out[slot] = shard
        heapq.heappush(load, (size + totals.get(slot, 0), count + 1, shard))
    return out


def edited_map(old: dict[int, int], totals: dict[int, int], shards: int) -> dict[int, int]:
    """The map for another number of shards or other sizes, moving few slots.

    Slots of shards that no longer exist go first to the emptiest shard; then, as long as it evens them out, the
    fullest shard hands a slot to the emptiest one. Slots that do not move keep their shard.
    """
    out, held = dict(old), {s: set() for s in range(shards)}
    load = dict.fromkeys(held, 0)
    homeless = []
    for slot, shard in old.items():
        if shard in held:
            held[shard].add(slot)
            load[shard] += totals.get(slot, 0)
        else:
            homeless.append(slot)

    def move(slot: int, shard: int) -> None:
        out[slot] = shard
        held[shard].add(slot)
        load[shard] += totals.get(slot, 0)

    for slot in sorted(homeless, key=lambda s: (-totals.get(s, 0), s)):
        move(slot, min(load, key=lambda s: (load[s], s)))
    while True:
        full, empty = max(load, key=lambda s: (load[s], -s)), min(load, key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        fitting = [s for s in held[full] if 0 < totals.get(s, 0) <= gap // 2]
        if not fitting:
            return out
        slot = max(fitting, key=lambda s: (totals[s], -s))
        held[full].remove(slot)
        load[full] -= totals[slot]
        move(slot, empty)


class SlotMaps:
    """Versions of a slot map as a table: version, slot_id, shard. `slots` rows to a version, so a version fits a driver."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def write(self, version: int, mapping: dict[int, int]) -> None:
        """A version is a folder of its own, written once."""
        rows = self.spark.createDataFrame(sorted(mapping.items()), "slot_id int, shard int")
        rows.coalesce(1).write.parquet(f"{self.path}/version={version}")

    def frame(self, version: int) -> DataFrame:
        return self.spark.read.schema("slot_id int, shard int").parquet(f"{self.path}/version={version}")

    def read(self, version: int) -> dict[int, int]:
        return {r.slot_id: r.shard for r in self.frame(version).collect()}


def totals_of(rows: DataFrame) -> dict[int, int]:
    """Bytes per slot on the driver: one number for each of the fixed slots."""
    return {r.slot_id: r.bytes for r in slot_totals(rows).collect()}


def placed(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """`rows` with shard and slot, the position in the shard, gapless from 0.

    A slot is numbered by itself, by doc_id and content; where its numbers begin follows from the counts of the slots
    before it in the shard.
    """
    counts = slot_totals(rows).join(F.broadcast(mapping), "slot_id")  # at most one row for each slot
    before = Window.partitionBy("shard").orderBy("slot_id").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("slot_id", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("slot_id").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(begins), "slot_id").withColumn("slot", F.col("begin") + F.col("place"))


def sharded(docs: DataFrame, maps: SlotMaps, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, slot_id, map_version for each row of `docs`.

    The law is `bytes`: shards have nearly equal sizes. Writes version 1 of the map and numbers rows by it. An empty
    table gives an empty result and a map of empty slots.
    """
    rows = records(docs, slots)
    maps.write(1, first_map(totals_of(rows), slots, shards))
    return placed(rows, maps.frame(1)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "slot_id",
        F.lit(1).alias("map_version"),
    )


def rebalanced(docs: DataFrame, maps: SlotMaps, version: int, shards: int = SHARDS) -> DataFrame:
    """slot_id, bytes, from_shard, to_shard: the slots that move when `docs` go to `shards` shards.

    Reads `version` of the map, sums bytes per slot anew and writes the edited map as the version after it. Rows keep
    their slots: place them by the new version with `placed`.
    """
    old = maps.read(version)
    totals = totals_of(records(docs, len(old)))
    new = edited_map(old, totals, shards)
    maps.write(version + 1, new)
    moved = [(slot, totals.get(slot, 0), old[slot], new[slot]) for slot in sorted(old) if new[slot] != old[slot]]
    return maps.spark.createDataFrame(moved, "slot_id int, bytes bigint, from_shard int, to_shard int")
