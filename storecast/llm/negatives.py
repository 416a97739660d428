"""Hard negatives by inner product, searched in a GNAT-style multiway tree.

One more coordinate puts all vectors on one sphere, so that a window of inner products with an anchor is a ring of distances
around it. A node of the tree has several split points and each vector belongs to the nearest of them; the node stores,
for each split point and each subtree beside it, the range of distances that occur. A subtree whose range at any split
point does not meet the ring cannot hold a result. What is left is compared exactly, leaf by leaf.

The split points come from a bounded sample, the ranges from all rows. The sample also gives each search a first bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.llm.frames import NO_ID, mapped, stored

#: Integer components beyond this take no part: scores times 100 would leave 64 bits.
LARGEST = 1 << 24
#: Rows that split points are taken from, split points of a node, and sampled rows that are not split further.
SAMPLE, WAYS, LEAF_SAMPLE = 4096, 8, 32
#: Rows that a task holds at once; larger leaves are dealt out over several blocks.
BLOCK_ROWS = 16384
#: Searches that are compared with a block at once.
SEARCHES = 128
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and vec, the integers floor(scale * x), of rows with a label and only finite components."""
    parts = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    fits = F.forall("e", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(LARGEST / scale)))
    return (
        rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), parts.alias("e"))
        .where(F.col("label").isNotNull() & F.col("e").isNotNull() & fits)
        .select("vec_id", "label", F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x).cast("int")).alias("vec"))
    )


def _norm2(vec: str) -> Column:
    return F.aggregate(vec, F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint") * x)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, short ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


@dataclass
class Node:
    """Split points; the child below each is another node, or a leaf by its number."""

    points: np.ndarray
    children: list[int] = field(default_factory=list)  # node numbers, leaves as -1 - number


@dataclass
class Tree:
    """ranges: by node, split point and subtree, the smallest and largest distance that occurs."""

    radius2: int
    nodes: list[Node]
    leaves: int
    ids: np.ndarray  # the sample: ids (NO_ID last), labels, vectors
    labels: np.ndarray
    sample: np.ndarray
    ranges: np.ndarray | None = None
    cell: np.ndarray | None = None  # of each leaf
    blocks: np.ndarray | None = None  # of each cell

    def lift(self, x: np.ndarray) -> np.ndarray:
        """The coordinate that puts each row on the sphere."""
        return np.sqrt(np.maximum(self.radius2 - (x * x).sum(axis=1), 0).astype(np.float64))

    def distances(self, x: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Between lifted rows and lifted points."""
        near = products(x, points) + np.outer(self.lift(x), self.lift(points))
        return np.sqrt(np.maximum(2.0 * (self.radius2 - near), 0))

    def placed(self, x: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        """The leaf of each row; widens `ranges` by what the rows on the way measure."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            number, rows = todo.pop()
            node = self.nodes[number]
            far = self.distances(x[rows], node.points)
            side = far.argmin(axis=1)
            for j in np.unique(side):
                at, n = side == j, len(node.points)
                ranges[number, :n, j, 0] = np.minimum(ranges[number, :n, j, 0], far[at].min(axis=0))
                ranges[number, :n, j, 1] = np.maximum(ranges[number, :n, j, 1], far[at].max(axis=0))
                child = node.children[j]
                if child < 0:
                    out[rows[at]] = -1 - child
                else:
                    todo.append((child, rows[at]))
        return out

    def reached(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """By row and leaf: whether the leaf may hold a product between low and high with the row."""
        out = np.zeros((len(x), self.leaves), bool)
        if not self.nodes:
            out[:, :] = True
            return out
        around = (x * x).sum(axis=1) + self.radius2
        slack = 1e-6 * np.sqrt(np.maximum(around, 1).astype(np.float64))  # for rounding; it only keeps more
        inner = np.sqrt(np.maximum(around - 2.0 * high, 0)) - slack
        outer = np.sqrt(np.maximum(around - 2.0 * low, 0)) + slack
        todo = [(0, np.flatnonzero(low <= high))]
        while todo:
            number, rows = todo.pop()
            node = self.nodes[number]
            own = np.sqrt(np.maximum(around[rows, None] - 2.0 * products(x[rows], node.points), 0))
            for j, child in enumerate(node.children):
                least, most = self.ranges[number, : len(node.points), j].T
                misses = (own + outer[rows, None] < least) | (own - outer[rows, None] > most) | (inner[rows, None] - own > most)
                left = rows[~misses.any(axis=1)]
                if len(left) and child < 0:
                    out[left, -1 - child] = True
                elif len(left):
                    todo.append((child, left))
        return out


def grown(radius2: int, ids: np.ndarray, labels: np.ndarray, sample: np.ndarray, ways: int, leaf_sample: int) -> Tree:
    """A tree over the sample: split points far from each other, until few or only equal rows are left."""
    tree = Tree(radius2, [], 0, ids, labels, sample)

    def grow(rows: np.ndarray) -> int:
        x = sample[rows]
        if len(rows) > leaf_sample:
            chosen = [0]
            near = tree.distances(x, x[:1])[:, 0]
            while len(chosen) < ways and near.max() > 1e-6 * np.sqrt(max(radius2, 1)):
                chosen.append(int(near.argmax()))
                near = np.minimum(near, tree.distances(x, x[chosen[-1:]])[:, 0])
            if len(chosen) > 1:
                node = Node(x[chosen])
                number = len(tree.nodes)
                tree.nodes.append(node)
                side = tree.distances(x, node.points).argmin(axis=1)
                node.children = [grow(rows[side == j]) for j in range(len(chosen))]
                return number
        tree.leaves += 1
        return -tree.leaves

    grow(np.arange(len(sample)))
    return tree


def best_of(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first k entries of each row: higher scores first, ties by smaller id, missing ids last."""
    order = np.lexsort((ids.view(np.uint64) ^ np.uint64(1 << 63), ids == NO_ID, -score, row))
    row, score, ids = row[order], score[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, int)
    place = np.arange(len(row)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(row)]))))
    return row[place < k], score[place < k], ids[place < k]


class Search:
    """The best k of rows with windows of scores, over point sets that come one after the other."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.x, self.labels, self.low, self.high, self.k, self.same = x, labels, low.copy(), high, k, same
        self.found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def see(self, rows: np.ndarray, points: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        """Compares some of the rows with points and narrows their windows to what can still be better."""
        score = products(self.x[rows], points)
        fits = (score >= self.low[rows, None]) & (score <= self.high[rows, None])
        fits &= (labels[None, :] == self.labels[rows, None]) == self.same
        if score.shape[1] > self.k:
            held = np.where(fits, score, _LOWEST)
            fits &= held >= np.partition(held, score.shape[1] - self.k, axis=1)[:, [score.shape[1] - self.k]]
        at, point = np.nonzero(fits)
        new = (rows[at], score[at, point], ids[point])
        self.found = best_of(*(np.concatenate(x) for x in zip(self.found, new)), self.k)
        row, score, _ = self.found
        full = np.bincount(row, minlength=len(self.x)) >= self.k
        last = np.full(len(self.x), _HIGHEST)
        np.minimum.at(last, row, score)
        self.low = np.where(full, np.maximum(self.low, last), self.low)


def indexed(points: DataFrame, sample: int = SAMPLE, ways: int = WAYS, leaf_sample: int = LEAF_SAMPLE, block_rows: int = BLOCK_ROWS):
    """The tree, broadcast, and the stored points (vec_id, label, vec, leaf, cell, block); None if there are no points.

    The sample are the rows with the smallest hashes. All rows are placed, and widen the ranges, in one pass; ranges
    travel as one row per task and subtree. Small leaves share a cell, a large one has several blocks of its rows.
    """
    spark = points.sparkSession
    size = points.agg(F.max(_norm2("vec")), F.max(F.size("vec"))).first()
    if size[0] is None:
        return None
    radius2, dims = int(size[0]), max(1, int(size[1]))
    some = points.orderBy(F.xxhash64("vec", "label", "vec_id"), "vec", "label", "vec_id").limit(sample).collect()
    rows = np.zeros((len(some), dims), np.int64)
    for i, r in enumerate(some):
        rows[i, : len(r.vec)] = r.vec
    ids = np.array([NO_ID if r.vec_id is None else r.vec_id for r in some], np.int64)
    tree = grown(radius2, ids, np.array([r.label for r in some], np.int64), rows, ways, leaf_sample)
    bare = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = bare.value
        ranges = np.empty((max(1, len(tree.nodes)), ways, ways, 2))
        ranges[..., 0], ranges[..., 1] = np.inf, -np.inf
        names, seen = ["vec_id", "label", "vec", "leaf", "nr", "spot", "least", "most"], 0
        for batch in batches:
            leaf = tree.placed(matrix(batch.column(2), dims), ranges)
            n = batch.num_rows
            number = pa.array(np.arange(seen, seen + n))
            seen += n
            none = pa.nulls(n, pa.float64())
            yield pa.record_batch([*batch.columns, pa.array(leaf), number, pa.nulls(n, pa.int64()), none, none], names=names)
        met = np.flatnonzero(np.isfinite(ranges[..., 0]).ravel())
        n, none = len(met), pa.nulls(len(met), pa.int64())
        least, most = (pa.array(ranges[..., i].ravel()[met]) for i in (0, 1))
        yield pa.record_batch([none, none, pa.nulls(n, pa.list_(pa.int32())), none, none, pa.array(met), least, most], names=names)

    schema = "vec_id bigint, label bigint, vec array<int>, leaf bigint, nr bigint, spot bigint, least double, most double"
    placed = stored(mapped(points.select("vec_id", "label", "vec"), place, schema), "placed")
    tree.ranges = np.empty((max(1, len(tree.nodes)), ways, ways, 2))
    # A subtree without rows is never reached.
    tree.ranges[..., 0], tree.ranges[..., 1] = np.inf, -np.inf
    for r in placed.where("spot is not null").groupBy("spot").agg(F.min("least").alias("a"), F.max("most").alias("b")).collect():
        tree.ranges.reshape(-1, 2)[r.spot] = r.a, r.b
    placed = placed.where("spot is null")
    counts = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():
        counts[r.leaf] = r["count"]
    tree.cell, tree.blocks = cells(counts, block_rows)
    of = F.array(*[F.lit(int(c)) for c in tree.cell])
    parts = F.array(*[F.lit(int(b)) for b in tree.blocks])
    placed = placed.withColumn("cell", F.get(of, F.col("leaf").cast("int"))).withColumn("block", (F.col("nr") % F.get(parts, F.col("cell"))).cast("int"))
    return spark.sparkContext.broadcast(tree), dims, placed.select("vec_id", "label", "vec", "leaf", "cell", "block")


def cells(counts: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring small leaves put together, and how many blocks each cell has."""
    cell, blocks, held = np.zeros(len(counts), np.int64), [], None
    for leaf, n in enumerate(counts.tolist()):
        if held is None or held + n > block_rows:
            blocks.append(1)
            held = 0
        held += n
        cell[leaf] = len(blocks) - 1
        blocks[-1] = max(1, -(-held // block_rows))
    return cell, np.array(blocks or [1])


def searched(index, searches: DataFrame, k: int, same: bool) -> DataFrame:
    """(q, w, score, vec_id), the best k points of each search (q, w, label, vec, low, high), ranked by `nr` from 1.

    A search names a window of scores, and `same` whether points of its label or of others count. Searches go to the cells
    they may find something in, to each block of them; a task holds one block and lets the searches stream by.
    """
    tree, dims, points = index

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree.value
        names = ["q", "w", "label", "vec", "low", "high", "cell", "block"]
        for batch in batches:
            for at in range(0, batch.num_rows, SEARCHES):
                part = batch.slice(at, SEARCHES)
                x = matrix(part.column(3), dims)
                label, low, high = (part.column(i).to_numpy() for i in (2, 4, 5))
                first = Search(x, label, low, high, k, same)
                first.see(np.arange(len(x)), own.sample, own.labels, own.ids)
                reached = own.reached(x, first.low, high)
                in_cell = np.zeros((len(x), len(own.blocks)), bool)
                row, leaf = np.nonzero(reached)
                in_cell[row, own.cell[leaf]] = True
                row, cell = np.nonzero(in_cell)
                times = own.blocks[cell]
                block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                columns = [c.take(pa.array(row)) for c in part.columns]
                columns[4] = pa.array(first.low[row])
                yield pa.record_batch([*columns, pa.array(cell, pa.int32()), pa.array(block, pa.int32())], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now = tree.value, None
        held: list[tuple] = []
        leaves: dict[int, tuple] = {}
        for batch in batches:
            place = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2)], axis=1)
            cuts = np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                part, key = batch.slice(a, b - a), tuple(place[a, :2])
                x, label = matrix(part.column(6), dims), part.column(5).to_numpy()
                if key != now:
                    now, held, leaves = key, [], {}
                if place[a, 2] == 0:
                    held.append((part.column(3).to_numpy(), x, label, part.column(4).to_numpy()))
                    continue
                if held:
                    leaf, points, labels, ids = (np.concatenate(c) for c in zip(*held))
                    leaves = {i: (points[leaf == i], labels[leaf == i], ids[leaf == i]) for i in np.unique(leaf).tolist()}
                    held = []
                low, high = part.column(7).to_numpy(), part.column(8).to_numpy()
                for s in range(0, len(x), SEARCHES):
                    cut = slice(s, s + SEARCHES)
                    search = Search(x[cut], label[cut], low[cut], high[cut], k, same)
                    reached = own.reached(search.x, search.low, search.high)
                    for i, leaf_points in leaves.items():
                        rows = np.flatnonzero(reached[:, i])
                        if len(rows):
                            search.see(rows, *leaf_points)
                    row, score, ids = search.found
                    names = ["q", "w", "score", "vec_id"]
                    taken = pa.array(row + s)
                    missing = pa.array(ids, mask=ids == NO_ID)
                    yield pa.record_batch([part.column(3).take(taken), part.column(4).take(taken), pa.array(score), missing], names=names)

    named = searches.select("q", "w", "label", "vec", "low", "high")
    visits = mapped(named, route, "q bigint, w bigint, label bigint, vec array<int>, low bigint, high bigint, cell int, block int")
    none = F.lit(None).cast("bigint")
    own_id = F.coalesce("vec_id", F.lit(NO_ID))
    held = ["cell", "block", F.lit(0).alias("kind"), F.col("leaf").alias("a"), own_id.alias("b"), "label", "vec"]
    coming = visits.select("cell", "block", F.lit(1), "q", "w", "label", "vec", "low", "high")
    both = points.select(*held, none.alias("low"), none.alias("high")).union(coming)
    dealt = both.repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    found = mapped(dealt, scan, "q bigint, w bigint, score bigint, vec_id bigint")
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    sample: int = SAMPLE,
    ways: int = WAYS,
    leaf_sample: int = LEAF_SAMPLE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over rows (vec_id, label, vec of integers).

    An anchor's positives are its best `positives` other rows of its label. For each, rank 1 up are the best rows of another
    label whose score lies between the two percentages of the positive's. Equal scores go by smaller vec_id, missing ids
    last. Rows of one id are rows of their own, also as anchors: a row that is repeated finds its copy as a positive, and
    its results are repeated. Vectors of unequal size count as filled with zeros. Without points, anchors or results, the
    result is empty. Other columns are ignored.
    """
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    points = rows.select("vec_id", "label", "vec")
    index = indexed(points, sample, ways, leaf_sample, block_rows)
    if index is None:
        return rows.sparkSession.createDataFrame([], schema)
    chosen = points.where(is_anchor).groupBy("vec_id", "label", "vec").agg(F.count(F.lit(1)).alias("times"))
    anchors = stored(chosen.withColumn("q", F.monotonically_increasing_id()), "anchors")
    wide = [F.lit(_LOWEST).alias("low"), F.lit(_HIGHEST).alias("high")]
    # One more than asked for, as the anchor itself may be among them.
    best = searched(index, anchors.select("q", F.lit(0).cast("bigint").alias("w"), "label", "vec", *wide), positives + 1, True)
    lists = best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("nr", "score", F.col("vec_id").alias("id")))).alias("best"))
    itself = F.struct(_norm2("vec").alias("score"), F.col("vec_id").alias("id"))
    alike = F.array_position(F.transform("best", lambda b: F.struct(b["score"].alias("score"), b["id"].alias("id"))), itself)
    others = F.filter("best", lambda b, i: (i + 1) != F.col("own"))
    found = lists.join(anchors, "q").withColumn("own", alike).withColumn("best", F.slice(others, 1, positives))
    pairs = stored(
        found.select("q", "label", "vec", F.col("vec_id").alias("anchor_id"), "times", F.posexplode("best").alias("place", "p")).select(
            "q", "label", "vec", "anchor_id", "times", "place", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score")
        ),
        "positives",
    )
    score = F.col("positive_score")
    windows = pairs.select("q", score.alias("w"), "label", "vec").dropDuplicates(["q", "w"])
    windows = windows.withColumn("low", _ceil_share("w", least_percent)).withColumn("high", _floor_share("w", most_percent))
    got = searched(index, windows.where("low <= high"), negatives, False)
    got = got.select("q", F.col("w").alias("positive_score"), F.col("nr").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = pairs.select("q", "anchor_id", "times", "positive_id", "positive_score").join(got, ["q", "positive_score"])
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _floor_share(column: str, percent: int) -> Column:
    """The largest integer n with 100 * n <= percent * column."""
    whole, hundred = F.col(column) * percent, F.lit(100).cast("bigint")
    return F.call_function("div", whole - F.pmod(whole, hundred), hundred)


def _ceil_share(column: str, percent: int) -> Column:
    """The smallest integer n with 100 * n >= percent * column."""
    return F.lit(0).cast("bigint") - _floor_share(column, -percent)
