"""From lines to a trained and stored demand model."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storecast.operators.features import (
    chronological_split,
    complete_grid,
    daily_sales,
    dense_features,
    finalize_features,
)
from storecast.operators.models import (
    compare_models,
    default_regressors,
    feature_importance,
    fit_model,
    regression_metrics,
    save_model,
)

# Tasks of a training frame. A forest draws its samples task by task, so the number is
# fixed and does not follow cores or rows: the same rows give the same model anywhere.
# Boosting is hundreds of short jobs and deep forests merge large statistics of every task,
# so a frame of some 100,000 rows takes few; give more for larger ones.
TRAIN_TASKS = 4


def demand_grid(
    items: DataFrame, orders: DataFrame, members: DataFrame, start: str, end: str, series: str
) -> DataFrame:
    """Dense daily quantities of every member of `members`."""
    daily = daily_sales(items, orders, series, start, end)
    return complete_grid(daily, members, start, end, series)


def demand_features(
    items: DataFrame, orders: DataFrame, members: DataFrame, start: str, end: str, series: str
) -> DataFrame:
    """Complete-history feature rows of every member and day."""
    daily = daily_sales(items, orders, series, start, end)
    return finalize_features(dense_features(daily, members, start, end, series))


def training_frame(
    features: DataFrame, series: str = "series", tasks: int = TRAIN_TASKS
) -> DataFrame:
    """Kept rows in a fixed number of tasks and a fixed order: every tree level reads them again.

    The caller unpersists the frame when the models are fitted. Raise `tasks` for more series;
    another number draws other samples.
    """
    spread = features.repartition(tasks, series, "order_date").sortWithinPartitions(series, "order_date")
    return spread.persist(StorageLevel.MEMORY_AND_DISK)


def choose_model(
    features: DataFrame,
    split_date: str,
    valid_from: str,
    regressors: dict | None = None,
    series: str = "series",
) -> tuple[str, PipelineModel, DataFrame]:
    """Pick the regressor with the lowest RMSE on the days from `valid_from` to the
    split, refit it on all training days, and report it on the test days once."""
    regressors = regressors or default_regressors()
    train, test = chronological_split(features, split_date)
    fit_days, valid_days = chronological_split(train, valid_from)
    table, _ = compare_models(fit_days, valid_days, regressors, series)
    # One row per model.
    best = table.where(F.col("model").isin(list(regressors))).orderBy("rmse", "model").first().model
    model = fit_model(train, regressors[best], series)
    return best, model, regression_metrics(model.transform(test), best)


def train_and_save(
    features: DataFrame,
    path: str,
    split_date: str = "2025-11-15",
    keep: str = "random_forest_best",
    regressors: dict | None = None,
    series: str = "series",
) -> tuple[DataFrame, DataFrame]:
    """Fit and compare all regressors and both baselines, and store the one named `keep`.

    Returns the metrics on the test days and the feature importance of the kept
    model, which is a tree model. Both are worked out here, and the training frame
    is let go.
    """
    spark, frame = features.sparkSession, training_frame(features, series)
    train, test = chronological_split(frame, split_date)
    table, fitted = compare_models(train, test, regressors, series)
    save_model(fitted[keep], path)
    # One row per model.
    listed = spark.createDataFrame(table.collect(), table.schema).orderBy("rmse", "model")
    frame.unpersist()
    return listed, feature_importance(fitted[keep], spark, series=series)
