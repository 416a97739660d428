import datetime as dt

import pytest
from pyspark.sql import functions as F

from storecast.functions import portable_hash
from storecast.operators import compiled, features, forecast, models


@pytest.fixture(scope="module")
def rows(spark):
    """Four series whose level depends on the series, so that flags are split on."""
    start = dt.date(2025, 1, 1)
    noise = lambda k: portable_hash(F.col("d") * 31 + F.col("s") * 7 + k) / 2**32
    grid = spark.range(240).select((F.col("id") % 4).alias("s"), F.floor(F.col("id") / 4).alias("d")).select(
        F.concat(F.lit("p"), F.col("s").cast("string")).alias("series"),
        F.date_add(F.lit(str(start)).cast("date"), F.col("d").cast("int")).alias("order_date"),
        (F.col("s") * 10 + noise(1) * 8 + F.sin(F.col("d") / 3.0) * 3 + 5).cast("decimal(12,2)").alias("quantity"),
    )
    return features.finalize_features(features.build_features(grid)).cache()


REGRESSORS = {
    "linear": lambda: models.linear_regression(),
    "forest": lambda: models.random_forest(max_depth=6, min_leaf=5, trees=20),
    "deep": lambda: models.random_forest(trees=3),
    "boosting": lambda: models.gradient_boosting(rounds=20),
    "stump": lambda: models.random_forest(max_depth=0, trees=2),
}


@pytest.fixture(scope="module")
def fitted(rows):
    return {name: models.fit_model(rows, regressor()) for name, regressor in REGRESSORS.items()}


@pytest.mark.parametrize("name", REGRESSORS)
def test_columns_predict_what_the_pipeline_does(spark, rows, fitted, name):
    walked = compiled.ColumnModel(fitted[name])
    scored = fitted[name].transform(rows).drop("series_index").join(walked.context(spark), "series")
    gap = F.abs(F.col("prediction") - walked({f: F.col(f) for f in features.FEATURES}))
    got = scored.agg(F.count(gap).alias("n"), F.max(gap).alias("gap")).first()
    assert got.n == rows.count() and got.gap < 1e-9


@pytest.mark.parametrize("name", ["linear", "forest", "boosting"])
def test_one_projection_forecasts_what_daily_transforms_do(rows, fitted, name):
    one = forecast.forecast(rows, fitted[name], 20)
    each = forecast.forecast_with_model(rows, fitted[name], 20)
    place = lambda df: {(r.series, r.horizon, r.order_date): r.prediction for r in df.collect()}
    got, want = place(one), place(each)
    assert len(got) == 4 * 20 and got == pytest.approx(want, abs=1e-9)


def test_the_plan_does_not_grow_and_runs_no_python(rows, fitted):
    plans = [
        forecast.forecast(rows, fitted["forest"], n)._jdf.queryExecution().executedPlan().toString() for n in (2, 20)
    ]
    assert all("Python" not in p and "UDF" not in p for p in plans)
    assert plans[0].count("Project") == plans[1].count("Project")


def test_flags_are_split_on(fitted):
    split_on = set(compiled.ColumnModel(fitted["forest"]).nodes["feature"])
    assert any(f >= len(features.FEATURES) for f in split_on)


def test_a_series_that_the_model_does_not_know_is_an_error(rows, fitted):
    strange = rows.withColumn("series", F.lit("new"))
    with pytest.raises(Exception, match="not in the model"):
        forecast.forecast(strange, fitted["linear"], 2).collect()


def test_too_large_a_forest_goes_day_by_day(rows, fitted, monkeypatch):
    monkeypatch.setattr(compiled, "MOST_NODES", 10)
    assert not compiled.ColumnModel.fits(fitted["forest"]) and compiled.ColumnModel.fits(fitted["linear"])
    ahead = forecast.forecast(rows, fitted["forest"], 2)
    assert ahead.count() == 8
