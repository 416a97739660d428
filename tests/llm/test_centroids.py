from __future__ import annotations

import hashlib

import numpy as np
import pytest

from storecast.llm import centroids
from tests.conftest import SMALL


def brute(rows, k=8, rounds=10, dims=64, scale=1024, salt="3:"):
    """vec_id, cluster, distance of each kept row, by whole scans in exact integers."""
    kept = [(i, [int(np.floor(scale * float(v))) for v in e]) for i, e in rows if e is not None and len(e) == dims and all(v is not None and np.isfinite(v) for v in e)]
    if not kept:
        return [], []
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest(), r[1]))
    cents = [r[1] for r in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for j in range(len(cents)):
            own = [v for (_, v), (_, c, _) in zip(kept, got) if c == j]
            if own:
                cents[j] = [sum(col) // len(own) for col in zip(*own)]
    return assign(), cents


def frame(spark, rows, dims_type="array<double>"):
    return spark.createDataFrame([(i, e, 7) for i, e in rows], f"vec_id bigint, embedding {dims_type}, cluster int")


def key(row):
    return (row[0] is None, row)


def same(spark, rows, **kw):
    found = centroids.clustered(frame(spark, rows), **kw)
    want, cents = brute(rows, **kw)
    got = [tuple(r) for r in found.rows.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert found.centroids == [list(c) for c in cents]
    return found


def test_equals_whole_scans_on_the_given_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = same(spark, rows)
    assert found.scans[0] == 8 * len(rows)
    totals = centroids.with_totals(found).collect()
    assert {r.inertia for r in totals} == {sum(r.distance for r in totals)}


def test_bounds_spare_distances_on_grouped_data(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 1, (6, 8))
    rows = [(i, (centre[i % 6] + rng.normal(0, 0.05, 8)).tolist()) for i in range(1200)]
    found = same(spark, rows, k=6, dims=8)
    assert found.scans[-1] < found.scans[0] / 10


def test_odd_rows_ties_and_hot_copies(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-3, 3, 4).astype(float).tolist()) for i in range(150)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(75)]  # a third of all rows are one vector
    rows += [(None, [0.5, 0.0, -0.5, 2.0]), (None, [0.5, 0.0, -0.5, 2.0]), (3, [2.0, 2.0, 2.0, 2.0])]
    rows += [(500, None), (501, [1.0]), (502, []), (503, [1.0, None, 1.0, 1.0]), (504, [float("nan"), 0.0, 0.0, 0.0])]
    rows += [(505, [float("inf"), 0.0, 0.0, 0.0])]
    same(spark, rows, k=5, rounds=4, dims=4)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.random(3) * 2e5 - 1e5).tolist()) for i in range(60)]
    same(spark, rows, k=3, rounds=3, dims=3)
    left_out = rows + [(99, [1e9, 0.0, 0.0])]
    assert centroids.clustered(frame(spark, left_out), k=3, rounds=1, dims=3).rows.count() == 60


def test_fewer_vectors_than_centroids_and_none(spark):
    same(spark, [(1, [0.0, 1.0]), (2, [5.0, 5.0])], k=8, dims=2)
    empty = centroids.with_totals(centroids.clustered(frame(spark, []), dims=2))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert empty.count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_bounds_never_lose_a_nearer_centroid(seed):
    """Random walks of centroids, evaluated only where in doubt, against whole scans."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-50, 50, (300, 5))
    k = 7
    cluster, dist2, seen = np.full(300, -1), np.zeros((300, k), np.int64), np.zeros((300, k), np.int64)
    history = rng.integers(-50, 50, (1, k, 5))
    for step in range(12):
        cluster, _ = centroids.reassigned(x, cluster, dist2, seen, history)
        whole = np.stack([centroids.squared(x, c) for c in history[-1]], axis=1)
        assert (cluster == whole.argmin(axis=1)).all()
        history = np.concatenate([history, history[-1:] + rng.integers(-4, 5, (1, k, 5))])
