import math

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from storecast.functions import portable_hash
from storecast.operators import allocate, features, models
from storecast.plans import restock
from storecast.plans import train as training
from storecast.session import scratch_path


@pytest.fixture(scope="module")
def split(spark):
    """Designed demand of 12 series with hash noise: a year with trend and season to learn."""
    number = F.col("id")
    params = spark.range(12).select(
        F.concat(F.lit("s"), number.cast("string")).alias("series"),
        (number % 5 * 4 + 3).cast("double").alias("base_demand"),
        ((number % 3 - 1) * 0.4).alias("trend"),
        F.when(number % 4 == 0, F.array(F.lit(10), F.lit(11)))
        .otherwise(F.array().cast("array<int>"))
        .alias("seasonal_months"),
        F.lit(3.0).alias("seasonal_multiplier"),
        F.lit(0.9).alias("noise_low"),
        F.lit(1.1).alias("noise_high"),
        F.lit(0.0).alias("zero_order_prob"),
    )
    designed = allocate.expected_demand(params, "2025-01-01", "2025-12-31")
    seed = F.datediff("order_date", F.lit("2025-01-01").cast("date")) * 97 + F.length("series") * 31
    noise = 0.9 + portable_hash(seed + F.abs(F.hash("series") % 1000)) / 2**32 * 0.2
    grid = designed.select(
        "series", "order_date", (F.col("expected_quantity") * noise).cast("decimal(12,2)").alias("quantity")
    )
    ready = features.finalize_features(features.build_features(grid))
    return features.chronological_split(training.training_frame(ready), "2025-11-15")


def score(model, test):
    return models.regression_metrics(model.transform(test), "m").first()


@pytest.fixture(scope="module")
def forest(split):
    return models.fit_model(split[0], models.random_forest(max_depth=6, min_leaf=5, trees=20))


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 5.0)], "quantity double, prediction double")
    m = models.regression_metrics(df, "x").first()
    assert m.mae == pytest.approx(2 / 3)
    assert m.mse == pytest.approx(4 / 3)
    assert m.rmse == pytest.approx(math.sqrt(4 / 3))
    assert m.r2 == pytest.approx(-1.0)


def test_metrics_agree_with_the_library(split, forest):
    from pyspark.ml.evaluation import RegressionEvaluator

    scored = forest.transform(split[1])
    ours = models.regression_metrics(scored, "x").first()
    for name in ("mae", "mse", "rmse", "r2"):
        theirs = RegressionEvaluator(labelCol="quantity", metricName=name).evaluate(scored)
        assert ours[name] == pytest.approx(theirs)


def test_every_model_beats_the_mean(split):
    train, test = split
    assert train.count() == 12 * (318 - 7) and test.count() == 12 * 47
    light = {
        "linear": models.linear_regression(),
        "forest": models.random_forest(max_depth=6, min_leaf=5, trees=20),
        "boosting": models.gradient_boosting(rounds=15),
    }
    table, fitted = models.compare_models(train, test, light)
    rows = {r.model: r for r in table.collect()}
    assert set(rows) == {"mean_baseline", "naive_lag_baseline", *light}
    assert [r.rmse for r in table.collect()] == sorted(r.rmse for r in rows.values())
    mean = rows["mean_baseline"].rmse
    assert all(rows[name].rmse < mean for name in light)
    assert rows["linear"].r2 > 0.8 and rows["forest"].r2 > 0.8
    assert len(fitted["linear"].stages[-1].coefficients) == 7 + 12


def test_recent_sales_matter_most(spark, forest):
    top = {r.feature: r.importance for r in models.feature_importance(forest, spark).collect()}
    recent = [top.get(f, 0) for f in ("quantity_lag_1", "quantity_rolling_7", "quantity_lag_7")]
    assert sum(recent) > 0.8
    assert len(top) == 15
    assert len(models.feature_names(forest)) == 19


def test_saved_model_predicts_the_same(spark, split, forest):
    path = scratch_path(spark, "model")
    models.save_model(forest, path)
    assert score(models.load_model(path), split[1]) == score(forest, split[1])


def test_choice_never_looks_at_the_test_days(split):
    frame = split[0].unionAll(split[1])
    best, model, metrics = training.choose_model(
        frame,
        "2025-11-15",
        "2025-10-15",
        {
            "linear": models.linear_regression(),
            "stump": models.random_forest(max_depth=1, trees=3),
        },
    )
    assert best == "linear"
    assert metrics.first().rows == 12 * 47


def test_train_store_and_restock(spark, split):
    frame = split[0].unionAll(split[1])
    path = scratch_path(spark, "model")
    table, importance = training.train_and_save(
        frame,
        path,
        keep="forest",
        regressors={"forest": models.random_forest(max_depth=5, min_leaf=5, trees=5)},
    )
    assert {r.model for r in table.collect()} == {"mean_baseline", "naive_lag_baseline", "forest"}
    assert importance.count() == 15
    series = frame.select("series").distinct()
    stock = series.withColumn("stock_available", F.lit(30).cast("decimal(12,2)"))
    erratic = series.withColumn("zero_order_prob", F.lit(0.2))
    report = restock.restock_from_saved(path, frame, stock, erratic).collect()
    assert len(report) == 12
    for r in report:
        assert r.needs_reorder == (r.reorder_point >= 30)
        assert bool(r.review_note) == r.needs_reorder
        wanted = max(0.0, r.predicted_daily_demand * 30 - 30) if r.needs_reorder else 0.0
        assert abs(r.recommended_order_qty - wanted) <= 2.5


def test_default_configurations():
    made = models.default_regressors()
    assert list(made) == [
        "linear_regression",
        "random_forest_default",
        "random_forest_best",
        "gradient_boosting_default",
        "gradient_boosting_best",
    ]
    assert made["random_forest_best"].getMaxDepth() == 6
    assert made["gradient_boosting_best"].getMaxIter() == 200
    assert made["gradient_boosting_best"].getStepSize() == 0.05


def test_training_frame_is_kept(split):
    assert split[0].storageLevel == StorageLevel.NONE
    assert "InMemoryTableScan" in split[0]._jdf.queryExecution().executedPlan().toString()


def test_the_forest_does_not_depend_on_the_input_tasks(spark, split):
    """As read by 2 or by 7 cores: the same rows in the same tasks, so the same trees."""
    forest = models.random_forest(max_depth=4, min_leaf=5, trees=5)
    made = []
    for tasks in (2, 7):
        frame = training.training_frame(split[0].repartition(tasks))
        model = models.fit_model(frame, forest)
        made.append(model.stages[-1].toDebugString.split("\n", 1)[1])
        frame.unpersist()
    assert made[0] == made[1]


def test_the_buffer_of_a_forest_fits_any_heap_and_does_not_change_it(split):
    """Every running task fills one: 1 GB each ran out of memory over the whole calendar."""
    assert all(models.random_forest(depth).getMaxMemoryInMB() <= 256 for depth in (None, 6))
    made = []
    for mb in (1, 1024):
        forest = models.random_forest(max_depth=8, trees=5).setMaxMemoryInMB(mb)
        made.append(models.fit_model(split[0], forest).stages[-1].toDebugString.split("\n", 1)[1])
    assert made[0] == made[1]


def test_checks_of_all_rows_at_once_equal_those_of_both_parts(split, forest):
    rows = split[0].unionAll(split[1])
    at_once = models.comparison_checks(forest.transform(rows), "2025-11-15", "forest").first()
    parts = models.model_checks(forest.transform(split[0]), forest.transform(split[1]), "forest").first()
    assert tuple(at_once) == (parts.model, parts.rows, parts.finite, parts.beats_mean)
    worse = forest.transform(rows).withColumn("prediction", F.lit(1e9))
    assert not models.comparison_checks(worse, "2025-11-15", "m").first().beats_mean


def test_a_deep_forest_is_fitted_in_shares(spark, split):
    """All trees, unlimited, each on its own samples; the prediction is the mean over all of them, stored or not."""
    from pyspark.ml.regression import RandomForestRegressionModel

    train, test = split
    model = models.fit_model(train, models.random_forest(trees=9))
    shares = [m for m in model.stages if isinstance(m, RandomForestRegressionModel)]
    assert sum(m.getNumTrees for m in shares) == 9 and all(m.getNumTrees >= 2 for m in shares)
    assert {m.getMaxDepth() for m in shares} == {models.DEEPEST}
    trees = [t for m in shares for t in m.trees]
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 9
    scored = model.transform(test.orderBy("series", "order_date"))
    assert not [c for c in scored.columns if c.startswith("__share")]
    for r in scored.limit(20).collect():
        assert r.prediction == pytest.approx(sum(t.predict(r.features) for t in trees) / 9)
    weights = models.feature_importance(model, spark, top=None).collect()
    assert sum(w.importance for w in weights) == pytest.approx(1.0) and min(w.importance for w in weights) >= 0
    again = models.fit_model(train, models.random_forest(trees=9)).transform(test)
    assert again.exceptAll(model.transform(test)).count() == 0
