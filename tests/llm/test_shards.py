"""Virtual slots: whole results, even sizes, and few moves."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from storecast.llm import shards
from storecast.session import scratch_path


@pytest.fixture
def maps(spark):
    return shards.SlotMaps(spark, scratch_path(spark, "maps"))


def test_every_row_once_with_gapless_positions(spark, make_docs, maps):
    rng = random.Random(1)
    rows = [(i, "é" * int(rng.expovariate(1 / 200))) for i in range(2000)] + [(5000, None), (None, "x"), (None, "y"), (7, "again")]
    got = shards.sharded(make_docs(rows), maps, slots=512, shards=16).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=str
    )
    total, most = [0] * 16, max(r.size for r in got)
    for s in range(16):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        total[s] = sum(r.size for r in own)
    assert max(total) - min(total) <= most
    assert {(r.law, r.grown_shard, r.map_version) for r in got} == {("bytes", None, 1)}


def test_the_map_decides_the_shard_and_is_kept(spark, make_docs, maps):
    docs = make_docs([(i, "x" * (i % 50)) for i in range(500)])
    got = shards.sharded(docs, maps, slots=64, shards=4).collect()
    mapping = maps.read(1)
    assert sorted(mapping) == list(range(64))
    assert all(mapping[r.slot_id] == r.shard for r in got)


@pytest.mark.parametrize("change", ["grow", "shrink", "resize"])
def test_an_edited_map_moves_little_and_evens_out(change):
    rng = random.Random(3)
    totals = {s: rng.randint(1, 1000) for s in range(1000)}
    old = shards.first_map(totals, 1000, 8)
    if change == "resize":
        totals = {s: n * (9 if old[s] == 2 else 1) for s, n in totals.items()}
    count = {"grow": 9, "shrink": 7, "resize": 8}[change]
    new = shards.edited_map(old, totals, count)
    load = [sum(n for s, n in totals.items() if new[s] == k) for k in range(count)]
    assert set(new) == set(old) and max(load) - min(load) <= 2 * max(totals.values())
    moved = sum(totals[s] for s in old if old[s] != new[s])
    ideal = sum(totals.values()) / count
    before = [sum(n for s, n in totals.items() if old[s] == k) for k in range(8)]
    needed = {"grow": ideal, "shrink": before[7], "resize": before[2] - ideal}[change]
    assert moved <= 1.3 * needed


@pytest.mark.parametrize("count", [5, 3, 4])
def test_rebalancing_writes_the_next_version_and_lists_what_moved(spark, make_docs, maps, count):
    rng = random.Random(4)
    rows = [(i, "é" * rng.randint(0, 80)) for i in range(1500)] + [(None, "x"), (None, None)]
    first = shards.sharded(make_docs(rows), maps, slots=128, shards=4).collect()
    if count == 4:  # the same shards, other sizes: one shard's rows come three times
        texts = dict(rows[:1500])
        rows = rows + [(r.doc_id, texts[r.doc_id]) for r in first if r.shard == 2 and r.doc_id is not None] * 2
    docs = make_docs(rows)
    moved = shards.rebalanced(docs, maps, 1, shards=count)
    old, new = maps.read(1), maps.read(2)
    totals = shards.totals_of(shards.records(docs, 128))
    assert sorted(tuple(r) for r in moved.collect()) == [
        (s, totals.get(s, 0), old[s], new[s]) for s in sorted(old) if old[s] != new[s]
    ]
    assert moved.count() and set(new) == set(old) and set(new.values()) == set(range(count))
    assert {r.slot_id: r.shard for r in first} == {s: old[s] for s in {r.slot_id for r in first}}
    placed = shards.placed(shards.records(docs, 128), maps.frame(2)).collect()
    assert len(placed) == len(rows) and all(new[r.slot_id] == r.shard for r in placed)
    load = [sum(r.size for r in placed if r.shard == k) for k in range(count)]
    assert max(load) - min(load) <= 2 * max(totals.values())


def test_versions_are_separate(maps):
    maps.write(1, {0: 0, 1: 1})
    maps.write(2, {0: 0, 1: 0})
    assert maps.read(1) == {0: 0, 1: 1} and maps.read(2) == {0: 0, 1: 0}
    with pytest.raises(Exception, match="exist"):
        maps.write(2, {0: 1, 1: 1})


def test_empty_table_and_clashing_columns(spark, make_docs, maps):
    assert shards.sharded(make_docs([]), maps, slots=16, shards=2).count() == 0
    df = make_docs([(1, "a"), (1, "a")]).withColumns({"size": F.lit("own"), "shard": F.lit(9), "slot_id": F.lit(1)})
    other = shards.SlotMaps(maps.spark, scratch_path(spark, "maps"))
    assert sorted(r.slot for r in shards.sharded(df, other, slots=16, shards=2).collect()) == [0, 1]


def test_a_very_long_text_is_one_record(make_docs, maps):
    got = shards.sharded(make_docs([(1, "é" * 400_000), (2, "a")]), maps, slots=64, shards=4).collect()
    assert sorted((r.doc_id, r.size) for r in got) == [(1, 800_001), (2, 2)]
