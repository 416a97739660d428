"""Document quality: a kernel classifier over document statistics, fitted by sums.

Random Fourier features turn a Gaussian kernel over standardised statistics into inner products. Ridge scores follow from
the normal equations, whose sums every partition forms for itself. Isotonic regression maps scores of rows that were left
out of the fit to probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.frames import mapped, stored

#: At most so many labelled rows are fitted, those with the smallest hashes of their ids.
MAX_LABELLED = 50_000
FEATURES = 256
WIDTH = 0.15
RIDGE = 1.0
FOLDS = 4
#: Tasks that form sums (at most), and levels of scores that isotonic regression sees. Neither follows the data.
TASKS = 16
LEVELS = 512
SEED = 20
THRESHOLD = 0.3

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
#: One class per byte: space, lower, upper, digit, line end, full stop and comma, other ASCII sign, beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[_SPACES], _CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[10], _CLASS[[44, 46]] = 0, 1, 2, 3, 4, 5
_CLASS[128:] = 7
STATISTICS = 28


REPEAT_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def statistics(text: bytes) -> np.ndarray:
    """Numbers that describe the form of a text, whatever its language: lengths, shares of kinds of characters, repetition."""
    out = np.zeros(STATISTICS)
    n = len(text)
    if not n:
        return out
    data = np.frombuffer(text, np.uint8)
    kind = _CLASS[data]
    out[0] = np.log1p(n)
    out[1:9] = np.bincount(kind, minlength=8)[:8] / n
    # What follows what: capitals in a row, signs after letters, letters after signs.
    pairs = np.bincount(kind[:-1].astype(np.int64) * 8 + kind[1:], minlength=64).reshape(8, 8) / n
    out[9], out[10], out[11], out[12], out[13] = pairs[2, 2], pairs[1, 6] + pairs[2, 6], pairs[6, 6], pairs[0, 6], pairs[6, 0]
    counts = np.bincount(data, minlength=256)
    share = counts[counts > 0] / n
    out[14] = -(share * np.log2(share)).sum()
    words = text.split()
    if words:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out[15], out[16], out[17] = np.log1p(len(words)), np.log(sizes.mean()), np.log1p(sizes.std())
        out[18], out[19] = np.log(sizes.max()), (sizes <= 2).mean()
        different = len(set(words))
        out[20] = different / len(words)
        out[21] = np.log(different) / np.log(len(words) + 1)
        out[22] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
        out[23] = words.count(b"|") / len(words)
    lines = [x for x in text.split(b"\n") if x]
    if lines:
        out[24], out[25] = np.log1p(len(lines)), np.log(n / len(lines))
        out[26] = len(set(lines)) / len(lines)
    out[27] = _repeats(data)
    return out


def _repeats(data: np.ndarray) -> float:
    """Share of 8-byte strings that occur before, of those whose hash ends in 00: a quarter of all, wherever they stand."""
    if len(data) < 64:
        return 0.0
    whole, kept = np.ascontiguousarray(data), []
    for at in range(0, len(whole) - 7, REPEAT_BYTES):  # a long text stays small in memory
        part = whole[at : at + REPEAT_BYTES + 7]
        grams = np.ndarray(len(part) - 7, "<u8", part, strides=(1,))
        kept.append(grams[(grams * _MIX) >> np.uint64(62) == 0])
    grams = np.concatenate(kept)
    return 1 - len(np.unique(grams)) / len(grams) if len(grams) else 0.0


def _vectors(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(len(texts), STATISTICS)


@dataclass
class Model:
    """Everything that scores a text; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    levels: np.ndarray
    values: np.ndarray

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Between 0 and 1, never falling with the ridge score."""
        if not len(vectors):
            return np.zeros(0)
        if not len(self.levels):
            return np.full(len(vectors), float(self.values[0]))
        ridge = fourier((vectors - self.mean) / self.scale) @ self.weights
        return np.clip(np.interp(ridge, self.levels, self.values), 0, 1)


def fourier(z: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, WIDTH, (z.shape[1], FEATURES))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    # Far outliers would turn in circles; four deviations say enough.
    waves = np.sqrt(2 / FEATURES) * np.cos(np.clip(z, -4, 4) @ w + b)
    return np.hstack([waves, np.ones((len(z), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising fit to points with weights, by pooling neighbours that fall; x must rise."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, w):
        blocks.append([xi * wi, yi * wi, wi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    sums = np.array(blocks).reshape(-1, 3)
    return sums[:, 0] / sums[:, 2], sums[:, 1] / sums[:, 2]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """id, y, v (statistics) of the labelled rows that are learnt from, `most` at most; several labels of an id are averaged."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    chosen = (
        known.where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("id"))
        .agg(F.avg("quality").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select(
        "id", "y", F.coalesce("text", F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors([t.encode() for t in batch.column(2).to_pylist()])
            flat = pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), STATISTICS).cast(pa.list_(pa.float64()))
            yield pa.record_batch([*batch.columns[:2], flat], names=["id", "y", "v"])

    return mapped(rows, run, "id bigint, y double, v array<double>")


def _sums(rows: DataFrame, parts: list[str]) -> dict[int, list[np.ndarray]]:
    """Sums of the binary columns `parts` (doubles) by fold. Each of the TASKS tasks has added up its rows already."""
    out: dict[int, list[np.ndarray]] = {}
    for r in rows.collect():
        own = [np.frombuffer(r[p]) for p in parts]
        out[r.fold] = [a + b for a, b in zip(out[r.fold], own)] if r.fold in out else own
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """A model of `labels` (doc_id, quality), learnt from the texts of `docs` outside the held-out fifth.

    Labels without an id or a quality, and labels of unknown documents, teach nothing. Without any label left, every
    text scores 0.5.
    """
    rows = stored(_labelled(docs, labels, max_labelled), "labelled")
    dealt = rows.coalesce(TASKS)
    fold_of = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int").alias("fold")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + 2 * STATISTICS)
        for batch in batches:
            if batch.num_rows:
                v = batch.column(0).flatten().to_numpy().reshape(-1, STATISTICS)
                total += np.concatenate(([len(v)], v.sum(axis=0), (v * v).sum(axis=0)))
        if total[0]:
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([total.tobytes()])], names=["fold", "m"])

    got = _sums(mapped(dealt.select("v"), moments, "fold int, m binary"), ["m"])
    if not got:
        none = np.zeros(0)
        return Model(none, none, none, none, np.array([0.5]))
    m = got[0][0]
    mean = m[1 : 1 + STATISTICS] / m[0]
    scale = np.sqrt(np.maximum(m[1 + STATISTICS :] / m[0] - mean**2, 0))
    scale[scale < 1e-9] = 1.0

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(-1, STATISTICS)
            y, fold = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            x = fourier((v - mean) / scale)
            for f in np.unique(fold).tolist():
                own = x[fold == f]
                new = [own.T @ own, own.T @ y[fold == f]]
                sums[f] = [a + b for a, b in zip(sums[f], new)] if f in sums else new
        for f, (xx, xy) in sums.items():
            row = [pa.array([f], pa.int32()), pa.array([xx.tobytes()]), pa.array([xy.tobytes()])]
            yield pa.record_batch(row, names=["fold", "xx", "xy"])

    folded = dealt.select("y", "v", fold_of)
    by_fold = _sums(mapped(folded, equations, "fold int, xx binary, xy binary"), ["xx", "xy"])
    size = FEATURES + 1
    ridge = RIDGE * np.eye(size)
    ridge[-1, -1] = 0  # the constant is free
    whole = [sum(parts) for parts in zip(*by_fold.values())]

    def solved(xx: np.ndarray, xy: np.ndarray) -> np.ndarray:
        return np.linalg.lstsq(xx.reshape(size, size) + ridge, xy, rcond=None)[0]

    weights = solved(*whole)
    # Each fold is scored by the fit to the others, as new texts will be; one fold alone is scored by itself.
    others = {f: solved(*(w - p for w, p in zip(whole, parts))) if len(by_fold) > 1 else weights for f, parts in by_fold.items()}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(-1, STATISTICS)
            x, fold = fourier((v - mean) / scale), batch.column(2).to_numpy()
            score = np.zeros(len(v))
            for f in np.unique(fold).tolist():
                score[fold == f] = x[fold == f] @ others[f]
            yield pa.record_batch([batch.column(0), pa.array(score)], names=["y", "s"])

    pairs = mapped(folded, scored, "y double, s double")
    level = F.round(F.col("s") * LEVELS / 2).cast("bigint")
    points = (
        pairs.groupBy(F.greatest(F.least(level, F.lit(LEVELS)), F.lit(-LEVELS)).alias("level"))
        .agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count("*").alias("n"))
        .orderBy("s")
        .collect()
    )
    levels, values = isotonic(*(np.array([float(p[k]) for p in points]) for k in ("s", "y", "n")))
    return Model(mean, scale, weights, levels, values)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with held_out, score and predicted (1 if score >= threshold) for each row, from the text alone.

    Null texts count as empty and get the score of an empty text. Own columns of these names are replaced, others kept.
    An empty table gives an empty result.
    """
    new = ["held_out", "score", "predicted"]
    names = [c for c in docs.columns if c not in new]
    at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.scores(_vectors([(t or "").encode() for t in batch.column(at).to_pylist()]))
            yield pa.record_batch([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=out)

    rows = docs.select(*names, held_out(F.col("doc_id")).alias("held_out"))
    out = [*rows.columns, "score", "predicted"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return mapped(rows, run, f"{schema}, score double, predicted int")


def good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of `docs` that the classifier does not reject, columns as they are."""
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{docs.columns.index(c)}" for c in ("doc_id", "text")}
    rows = rows.withColumnsRenamed({v: k for k, v in at.items()})
    judged = scored(rows, fit(docs, labels, **options), threshold)
    return judged.where("predicted = 1").select(*rows.columns).toDF(*docs.columns)
