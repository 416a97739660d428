import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storecast.operators import features, forecast, linear, models

START = dt.date(2025, 1, 1)
DAYS = 60
END = str(START + dt.timedelta(days=DAYS - 1))
FIRST = str(START + dt.timedelta(days=7))


@pytest.fixture(scope="module")
def frames(spark):
    """Sparse and dense complete features of five series, the last without a sale."""
    rng = random.Random(1)
    rows = [
        (s, START + dt.timedelta(days=d), rng.randint(1, 9) * (s + 1))
        for s in range(4)
        for d in range(DAYS)
        if rng.random() < 0.15 + 0.2 * s
    ]
    daily = spark.createDataFrame(rows, "series int, order_date date, q int").select(
        "series", "order_date", F.col("q").cast("decimal(12,2)").alias("quantity")
    )
    members = spark.createDataFrame([(s,) for s in range(5)], "series int")
    grid = features.complete_grid(daily, members, str(START), END)
    dense = features.finalize_features(features.build_features(grid))
    sparse = features.finalize_features(features.sparse_features(daily, str(START), END))
    return sparse, dense, members


def by_flags(rows):
    """Least squares with a flag per series: coefficients, and intercept by series."""
    names = sorted({r.series for r in rows})
    x = np.array([[float(r[f]) for f in features.FEATURES] + [float(r.series == s) for s in names] for r in rows])
    solved = np.linalg.lstsq(x, np.array([r.quantity for r in rows]), rcond=None)[0]
    return solved[:7], dict(zip(names, solved[7:]))


def test_equals_least_squares_with_a_flag_per_series(frames):
    rows = frames[1].collect()
    fit = linear.fit_within(frames[1])
    coefficients, effects = by_flags(rows)
    assert fit.rows == len(rows)
    assert fit.coefficients == pytest.approx(list(coefficients), abs=1e-9)
    assert {r.series: r.effect for r in fit.effects.collect()} == pytest.approx(effects, abs=1e-9)


def test_the_days_in_reach_give_the_fit_of_all_days(frames):
    sparse, dense, members = frames
    assert sparse.count() < dense.count()
    few = linear.fit_within_sparse(sparse, members, FIRST, END)
    whole = linear.fit_within(dense)
    assert few.rows == whole.rows == 5 * (DAYS - 7)
    assert few.coefficients == pytest.approx(whole.coefficients, abs=1e-9)
    effects = lambda fit: {r.series: r.effect for r in fit.effects.collect()}
    assert effects(few) == pytest.approx(effects(whole), abs=1e-9)


def test_series_of_unequal_length(frames):
    part = frames[1].where("series > 0 OR order_date < DATE '2025-01-20'")
    coefficients, effects = by_flags(part.collect())
    fit = linear.fit_within(part)
    assert fit.coefficients == pytest.approx(list(coefficients), abs=1e-9)
    assert {r.series: r.effect for r in fit.effects.collect()} == pytest.approx(effects, abs=1e-9)


def test_equals_the_library_on_flags(frames):
    model = models.fit_model(frames[1], models.linear_regression())
    fit = linear.fit_within(frames[1])
    theirs = {(r.series, r.order_date): r.prediction for r in model.transform(frames[1]).collect()}
    ours = {(r.series, r.order_date): r.prediction for r in fit.scored(frames[1]).collect()}
    # Flags and an intercept depend on each other, so the library iterates, to about 1e-6 of the coefficients.
    assert ours == pytest.approx(theirs, abs=1e-3)


def test_a_constant_feature_and_a_copy_change_no_prediction(frames):
    rows = frames[1].withColumns({"same": F.lit(3.0), "copy": F.col("quantity_lag_1") * 2})
    fit = linear.fit_within(rows, features=[*features.FEATURES, "same", "copy"])
    plain = linear.fit_within(frames[1])
    got = {(r.series, r.order_date): r.prediction for r in fit.scored(rows).collect()}
    want = {(r.series, r.order_date): r.prediction for r in plain.scored(frames[1]).collect()}
    assert got == pytest.approx(want, abs=1e-8)


def test_series_that_were_not_fitted_have_no_prediction(frames):
    fit = linear.fit_within(frames[1].where("series < 3"))
    got = fit.scored(frames[1])
    assert got.count() == frames[1].count()
    assert got.where("prediction IS NULL").select("series").distinct().count() == 2
    assert linear.fit_within(frames[1].limit(0)).rows == 0


def test_forecast_follows_the_fit(frames):
    """Day by day in plain Python, with the same features."""
    fit = linear.fit_within(frames[1])
    ahead = forecast.forecast_with_columns(frames[1], fit, 10, context=fit.effects).collect()
    effects = {r.series: r.effect for r in fit.effects.collect()}
    last = {}
    for r in sorted(frames[1].collect(), key=lambda r: r.order_date):
        last.setdefault(r.series, []).append(r.quantity)
    want = {}
    for s, q in last.items():
        for h in range(10):
            day = START + dt.timedelta(days=DAYS + h)
            x = [day.weekday(), day.month, day.weekday() >= 5, day.month in (10, 11), q[-1], q[-7], sum(q[-7:]) / 7]
            q.append(effects[s] + sum(c * float(v) for c, v in zip(fit.coefficients, x)))
            want[s, h + 1] = q[-1]
    assert {(r.series, r.horizon): r.prediction for r in ahead} == pytest.approx(want, abs=1e-9)


def test_one_job_reads_the_rows_and_one_row_comes_back(frames):
    """Sums per series are worked out once; the effects read what was stored."""
    fit = linear.fit_within(frames[1])
    plan = fit.effects._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "series-sums" in plan
