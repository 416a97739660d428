"""Exact k-means whose bounds are loosened by the norm of a centroid's total displacement (ns-bounds).

Each vector keeps, for every centroid, its squared distance when it was last evaluated and the round of that. The history
of all centroids is retained, so a stored distance is off by at most the length of the straight line from where the
centroid was then to where it is now, which is never longer than the sum of its drifts. A vector whose upper bound stays
below all its lower bounds keeps its cluster unseen; any other is evaluated exactly against the centroids in doubt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storecast.llm.frames import mapped, release, stored

#: Integer components beyond this are not kept: with 64 of them a squared distance would leave 64 bits.
LARGEST = 1 << 27
#: What rounding of square roots and their sums may come to, as a share.
_SLACK = 1e-9
_FAR = np.iinfo(np.int64).max

_STATE = "vec_id bigint, vec array<int>, cluster int, dist2 array<bigint>, seen array<int>"
_PART = "part int, part_n bigint, part_sums array<bigint>, scans bigint"


def kept_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and vec, the integers floor(scale * x): vectors of `dims` components, none null, non-finite or too large."""
    parts = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), parts.alias("e"))
    fits = F.forall("e", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(LARGEST / scale)))
    floor = F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x).cast("int"))
    return rows.where((F.size("e") == dims) & fits).select("vec_id", floor.alias("vec"))


def first_centroids(kept: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of salt and id, ties by components; ids that are null come last."""
    mark = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(mark.asc_nulls_last(), "vec").select("vec").limit(k).collect()
    return [r.vec for r in rows]


def squared(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one centroid."""
    gap = rows - centre
    return np.einsum("ij,ij->i", gap, gap)


def reassigned(
    x: np.ndarray, cluster: np.ndarray, dist2: np.ndarray, seen: np.ndarray, history: np.ndarray
) -> tuple[np.ndarray, int]:
    """New clusters and the number of distances taken; dist2 and seen are brought up to date in place.

    history has the centroids of every round so far, the present ones last. A cluster of -1 was never evaluated.
    """
    now = len(history) - 1
    k = history.shape[1]
    every = np.arange(len(x))
    moved = np.sqrt(((history[now] - history).astype(np.float64) ** 2).sum(axis=2))  # by round and centroid
    loose = moved[seen, np.arange(k)]
    # Distances of rows never seen are 0 at round 0: they fail the test and all their centroids are in doubt.
    far = np.sqrt(dist2.astype(np.float64))
    low = np.where(cluster[:, None] < 0, 0.0, (far - loose) * (1 - _SLACK) - _SLACK)
    held = np.maximum(cluster, 0)
    high = (far[every, held] + loose[every, held]) * (1 + _SLACK) + _SLACK
    high[cluster < 0] = np.inf
    rivals = low.copy()
    rivals[every, held] = np.inf
    doubt = np.flatnonzero((rivals.min(axis=1) <= high) | (cluster < 0)) if k > 1 else np.flatnonzero(cluster < 0)
    out, scans = cluster.copy(), 0

    def evaluate(rows: np.ndarray, j: int) -> None:
        dist2[rows, j] = squared(x[rows], history[now][j])
        seen[rows, j] = now

    # Tighten the upper bound first; it may settle the rest.
    for j in range(k):
        rows = doubt[cluster[doubt] == j]
        evaluate(rows, j)
        scans += len(rows)
    known = cluster[doubt] >= 0
    exact = np.sqrt(dist2[doubt, held[doubt]].astype(np.float64)) * (1 + _SLACK) + _SLACK
    high[doubt] = np.where(known, exact, np.inf)
    best = np.where(known, dist2[doubt, held[doubt]], _FAR)
    choice = np.where(known, held[doubt], k)
    for j in range(k):
        near = (low[doubt, j] <= high[doubt]) & (cluster[doubt] != j)
        rows = doubt[near]
        evaluate(rows, j)
        scans += len(rows)
        got = dist2[rows, j]
        better = (got < best[near]) | ((got == best[near]) & (j < choice[near]))
        at = np.flatnonzero(near)[better]
        best[at], choice[at] = got[better], j
    out[doubt] = choice
    return out, scans


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)


def _lists(values: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _step(frame: DataFrame, history: np.ndarray, last: bool) -> DataFrame:
    """The frame after one assignment, and beside it what each task found: k rows of changed counts and sums."""
    shared = frame.sparkSession.sparkContext.broadcast(history)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = shared.value
        _, k, d = history.shape
        counts, sums, scans = np.zeros(k, np.int64), np.zeros((k, d), np.int64), 0
        names = ["vec_id", "vec", "cluster", "dist2", "seen", "part", "part_n", "part_sums", "scans"]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, cluster = _matrix(batch.column(1), d), batch.column(2).to_numpy(zero_copy_only=False)
            dist2, seen = _matrix(batch.column(3), k), _matrix(batch.column(4), k)
            new, more = reassigned(x, cluster, dist2, seen, history)
            scans += more
            if last:
                # The distance that is returned is the one to the centroid as it stands.
                for j in range(k):
                    rows = np.flatnonzero((new == j) & (seen[:, j] < len(history) - 1))
                    dist2[rows, j], seen[rows, j] = squared(x[rows], history[-1][j]), len(history) - 1
            changed = new != cluster
            for side, sign in ((cluster, -1), (new, 1)):
                for j in np.unique(side[changed]):
                    if j >= 0:
                        rows = x[changed & (side == j)]
                        counts[j] += sign * len(rows)
                        sums[j] += sign * rows.sum(axis=0)
            none = pa.nulls(n)
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(new, pa.int32()),
                    _lists(dist2),
                    _lists(seen.astype(np.int32)),
                    none.cast(pa.int32()),
                    none.cast(pa.int64()),
                    none.cast(pa.list_(pa.int64())),
                    none.cast(pa.int64()),
                ],
                names=names,
            )
        blank = pa.nulls(k)
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        found = [pa.array(np.arange(k), pa.int32()), pa.array(counts), _lists(sums), pa.array([scans] + [0] * (k - 1))]
        yield pa.record_batch([*(blank.cast(t) for t in kinds), *found], names=names)

    return mapped(frame, run, f"{_STATE}, {_PART}")


@dataclass
class Clusters:
    """rows: vec_id, cluster, distance; centroids and inertia by cluster; distances taken in each assignment."""

    rows: DataFrame
    centroids: list[list[int]]
    inertia: list[int]
    scans: list[int]


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3:") -> Clusters:
    """k-means over vec_id and embedding, exact in integers, with `rounds` updates and a last assignment after them.

    Vectors of another size than `dims`, or with a null, non-finite or too large component (over LARGEST / scale), and
    null vectors are left out. A null vec_id is kept but starts no centroid unless there are too few others; rows that
    repeat a vec_id are each assigned. Fewer vectors than k give as many centroids; none give an empty result. Ties go to
    the smaller centroid. Other columns are ignored. Every assignment is one pass that writes the vectors with their
    bounds to the shared folder and drops what it read; sums travel as one row per task and centroid, only for vectors
    that changed.
    """
    kept = kept_vectors(vectors, dims, scale)
    spark = vectors.sparkSession
    start = first_centroids(kept, k, salt)
    k = len(start)
    if not k:
        return Clusters(spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), [], [], [])
    history = np.array([start], np.int64)
    counts, sums, scans = [0] * k, [[0] * dims for _ in range(k)], []
    zeros = F.array_repeat(F.lit(0), k)
    frame = kept.select("vec_id", "vec", F.lit(-1).alias("cluster"), zeros.cast("array<bigint>").alias("dist2"), zeros.alias("seen"))
    for r in range(rounds + 1):
        before, frame = frame, stored(_step(frame, history, last=r == rounds), f"clusters-{r}")
        if r:
            release(before)
        found = frame.where("part is not null")
        scans.append(found.agg(F.sum("scans")).first()[0])
        frame = frame.where("part is null").select("vec_id", "vec", "cluster", "dist2", "seen")
        if r == rounds:
            break
        for row in found.groupBy("part").agg(F.sum(F.col("part_n").cast("decimal(38,0)")).alias("n")).collect():
            counts[row.part] += int(row.n)
        spread = found.where("part_n is not null").select("part", F.posexplode("part_sums").alias("at", "s"))
        for row in spread.groupBy("part", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
            sums[row.part][row.at] += int(row.s)
        present = [[s // n for s in own] if n else list(old) for own, n, old in zip(sums, counts, history[-1].tolist())]
        history = np.concatenate([history, np.array([present], np.int64)])
    rows = frame.select("vec_id", "cluster", F.element_at("dist2", F.col("cluster") + 1).alias("distance"))
    total = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    return Clusters(rows, history[-1].tolist(), [total.get(j, 0) for j in range(k)], scans)


def with_totals(found: Clusters) -> DataFrame:
    """The rows with their cluster's inertia, the whole inertia and a digest of their centroid; k rows are joined."""
    spark = found.rows.sparkSession
    whole = sum(found.inertia)
    of = [
        (j, own, whole, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for j, (c, own) in enumerate(zip(found.centroids, found.inertia))
    ]
    table = spark.createDataFrame(of, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.rows.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
