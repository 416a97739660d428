"""Least squares with one intercept for each of any number of series.

Flags for thousands of series would make a vector of that length and a Gram matrix of its square. Subtracting each series'
means from its rows (the within transformation) gives the same coefficients: sums per series combine on the map side, a
Gram matrix of the few other features is solved, and the intercepts come back as means.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.functions import calendar_days
from storecast.operators.features import FEATURES, HISTORY, TARGET, calendar_features
from storecast.session import stored


@dataclass
class WithinFit:
    """coefficients by feature, and effects: one intercept per series, as (series, effect)."""

    features: list[str]
    coefficients: list[float]
    effects: DataFrame
    series: str
    rows: int

    def __call__(self, features: dict[str, Column]) -> Column:
        """The prediction from named feature columns and the series' `effect`; a predictor for forecasts."""
        terms = [F.lit(c) * features[f].cast("double") for f, c in zip(self.features, self.coefficients)]
        return sum(terms, F.col("effect"))

    def scored(self, rows: DataFrame) -> DataFrame:
        """`rows` with prediction; series that were not fitted have none."""
        # One row per series: looked up, so that the rows need no sort.
        known = rows.join(self.effects.hint("shuffle_hash"), self.series, "left")
        named = {f: F.col(f) for f in self.features}
        return known.select(*rows.columns, self(named).alias("prediction"))

    def table(self) -> DataFrame:
        """(feature, coefficient), in the order of the features."""
        listed = list(zip(self.features, self.coefficients))
        return self.effects.sparkSession.createDataFrame(listed, "feature string, coefficient double")


def _pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def _series_sums(rows: DataFrame, series: str, names: Sequence[str]) -> DataFrame:
    """Per series: n, the sum of each column, and the sum of each product of two."""
    value = {c: F.col(c).cast("double") for c in names}
    return rows.groupBy(series).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(value[c]).alias(f"s_{c}") for c in names],
        *[F.sum(value[a] * value[b]).alias(f"p_{a}_{b}") for a, b in _pairs(names)],
    )


def _solved(sums: DataFrame, series: str, features: Sequence[str], target: str) -> WithinFit:
    """Sums of one row per series to coefficients: one row of products of deviations comes to the driver."""
    names = [*features, target]
    # Read for the Gram matrix and for the effects: one row per series, written once.
    sums = stored(sums, "series-sums")
    left = [
        F.sum(F.col(f"p_{a}_{b}") - F.col(f"s_{a}") * F.col(f"s_{b}") / F.col("n")).alias(f"{a}_{b}")
        for a, b in _pairs(names)
    ]
    found = sums.agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"), *left).first()
    gram = np.zeros((len(names), len(names)))
    for a, b in _pairs(names):
        i, j = names.index(a), names.index(b)
        gram[i, j] = gram[j, i] = found[f"{a}_{b}"] or 0.0
    # Equal scales first; features that say nothing new get the smallest coefficients that fit.
    scale = np.sqrt(np.maximum(np.diag(gram)[:-1], 0))
    scale[scale == 0] = 1.0
    inner = gram[:-1, :-1] / np.outer(scale, scale)
    solution = np.linalg.lstsq(inner, gram[:-1, -1] / scale, rcond=1e-12)[0] / scale
    coefficients = [float(c) for c in solution]
    explained = [F.lit(c) * F.col(f"s_{f}") for f, c in zip(features, coefficients)]
    effect = (F.col(f"s_{target}") - sum(explained, F.lit(0.0))) / F.col("n")
    return WithinFit(list(features), coefficients, sums.select(series, effect.alias("effect")), series, int(found.n))


def fit_within(
    rows: DataFrame, series: str = "series", features: Sequence[str] = FEATURES, target: str = TARGET
) -> WithinFit:
    """Fit over the given rows, none of whose features is NULL; series may have any number of rows each."""
    return _solved(_series_sums(rows, series, [*features, target]), series, features, target)


def fit_within_sparse(
    sparse: DataFrame, members: DataFrame, start: str, end: str, series: str = "series"
) -> WithinFit:
    """Fit over every member on every day from `start` to `end`, from the days in reach of a sale alone.

    On the days that `sparse` does not list quantity and history are zero, so they only add to the sums of calendar
    features, which are the same for every series. `sparse` lies within these days and has a complete history.
    """
    cal = [f for f in FEATURES if f not in HISTORY]
    names = [*FEATURES, TARGET]
    spine = members.sparkSession.range(1).select(F.explode(calendar_days(start, end)).alias("order_date"))
    # One row: sums over the days of the calendar.
    days = _series_sums(calendar_features(spine).withColumn("__all", F.lit(1)), "__all", cal).first()
    sums = members.select(series).join(_series_sums(sparse, series, names), series, "left")
    fixed = {"n": days.n, **{f"s_{c}": days[f"s_{c}"] for c in cal}}
    fixed |= {f"p_{a}_{b}": days[f"p_{a}_{b}"] for a, b in _pairs(cal)}
    filled = [
        F.lit(fixed[c]).alias(c) if c in fixed else F.coalesce(c, F.lit(0.0)).alias(c)
        for c in sums.columns
        if c != series
    ]
    return _solved(sums.select(series, *filled), series, FEATURES, TARGET)
