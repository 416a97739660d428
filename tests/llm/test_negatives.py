from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storecast.llm import negatives
from tests.conftest import SMALL

ROWS = "vec_id bigint, label int, embedding array<double>"


def brute(rows, every=50, positives=5, negative=3, scale=256):
    kept = [
        (i, lab, [math.floor(scale * x) for x in e])
        for i, lab, e in rows
        if lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    place = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for at, (anchor, own, x) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        score = [(sum(a * b for a, b in zip(x, y)), i, lab) for k, (i, lab, y) in enumerate(kept) if k != at]
        for ps, pid, _ in sorted((s for s in score if s[2] == own), key=place)[:positives]:
            fits = sorted((s for s in score if s[2] != own and 50 * ps <= 100 * s[0] <= 95 * ps), key=place)
            out += [(anchor, pid, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(fits[:negative], 1)]
    return out


def mined(spark, rows, every=50, **kw):
    df = spark.createDataFrame([(*r, 1.5) for r in rows], f"{ROWS}, score double").withColumn("q", F.lit("x"))
    return negatives.hard_negatives(negatives.whole_vectors(df), F.col("vec_id") % every == 0, **kw)


def same(spark, rows, every=50, **kw):
    got = mined(spark, rows, every, **kw)
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows, every))


def grouped(n, dims, seed, groups=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (groups, dims))
    return [(i, int(rng.integers(0, 3)), (centre[i % groups] + rng.normal(0, 0.1, dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize("block_rows", [16384, 40])
def test_equals_whole_scans_with_a_deep_tree(spark, block_rows):
    rows = grouped(700, 6, 1)
    same(spark, rows, every=10, sample=300, ways=4, leaf_sample=5, block_rows=block_rows)


def test_odd_rows(spark):
    rows = grouped(120, 3, 2)
    rows += [(None, 1, [1.0, 0.5, -1.0]), (None, 1, [1.0, 0.5, -1.0]), (50, 1, [1.0, 1.0, 1.0]), (50, 1, [1.0, 1.0, 1.0])]
    rows += [(200, None, [1.0, 1.0, 1.0]), (201, 1, None), (202, 1, [1.0, None, 1.0]), (203, 1, [float("nan"), 1.0, 1.0])]
    rows += [(204, 1, [float("-inf"), 1.0, 1.0]), (205, 1, [2.0]), (250, 2, [0.0, 0.0, 0.0]), (206, 2, []), (-50, 2, [1.0, 2.0, 0.0])]
    same(spark, rows, every=25, sample=40, ways=3, leaf_sample=3)


def test_hot_vectors_ids_and_labels(spark):
    rows = grouped(200, 4, 3)
    rows += [(1000 + i, 1, [1.0, 0.5, 0.25, 0.0]) for i in range(150)]  # one vector holds a third
    rows += [(2000 + i, 2, [0.8, 0.4, 0.25, 0.0]) for i in range(150)]
    same(spark, rows, every=25, sample=100, ways=4, leaf_sample=5, block_rows=32)
    one_id = [(0, lab, e) for _, lab, e in grouped(40, 4, 4)]
    same(spark, one_id, every=25, sample=20, ways=4, leaf_sample=5, block_rows=8)


def test_nothing_to_find(spark):
    assert mined(spark, []).count() == 0
    assert mined(spark, [(1, 1, [1.0])]).count() == 0
    assert mined(spark, [(50, 1, [1.0]), (51, 2, [1.0])]).count() == 0  # no positive
    assert mined(spark, [(50, None, [1.0])]).columns == mined(spark, [(50, 1, [1.0])]).columns


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, i % 2, (rng.random(3) * 60000).tolist()) for i in range(60)]
    same(spark, rows, every=5, sample=20, ways=3, leaf_sample=2)


@pytest.mark.parametrize("seed", range(5))
def test_the_tree_never_loses_a_row_of_the_window(seed):
    """Rows between two scores are in leaves that are reached, and on grouped data most leaves are not."""
    rng = np.random.default_rng(seed)
    x = (256 * np.array([e for _, _, e in grouped(600, 5, seed)])).astype(np.int64)
    radius2 = int((x * x).sum(axis=1).max())
    ids = np.arange(len(x))
    tree = negatives.grown(radius2, ids, ids, x[:200], 4, 6)
    tree.ranges = np.empty((len(tree.nodes), 4, 4, 2))
    tree.ranges[..., 0], tree.ranges[..., 1] = np.inf, -np.inf
    leaf = tree.placed(x, tree.ranges)
    anchors = x[rng.integers(0, 600, 40)]
    scores = anchors @ x.T
    high = scores.max(axis=1)
    low = np.partition(scores, -5, axis=1)[:, -5]
    reached = tree.reached(anchors, low, high)
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    assert all(reached[a, leaf[p]] for a, p in zip(*np.nonzero(inside)))
    assert reached.mean() < 0.5


def test_bounds_of_windows_are_whole_numbers(spark):
    df = spark.range(-250, 250).withColumnRenamed("id", "w")
    got = df.select("w", negatives._floor_share("w", 95).alias("f"), negatives._ceil_share("w", 50).alias("c")).collect()
    assert all(r.f == (95 * r.w) // 100 and r.c == -((-50 * r.w) // 100) for r in got)


def test_the_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.label, [float(x) for x in r.embedding]) for r in table.collect()]
    same(spark, rows)
