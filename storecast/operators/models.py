"""Regression metrics, baselines and Spark ML demand models."""

from __future__ import annotations

from collections.abc import Mapping
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storecast.operators.features import FEATURES, TARGET
from storecast.session import shared_root

SEED = 42
# Spark ML trees go no deeper than this; it stands for "no limit".
DEEPEST = 30
# A deep forest is fitted as so many smaller ones side by side, of two trees at least: one tree would take no samples.
FOREST_SHARES = 10
SHARE_MB = 64


def regression_metrics(
    scored: DataFrame, model: str, label: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """One row: model, rows, MAE, MSE, RMSE, R2; one aggregation pass.

    R2 is NULL for a constant label.
    """
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    sums = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("spread"),
    )
    return sums.select(
        F.lit(model).alias("model"),
        "rows",
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
    )


def comparison_checks(scored: DataFrame, split_date: str, model: str, label: str = TARGET) -> DataFrame:
    """(model, rows, finite, beats_mean) from all rows scored at once, so that a large model is sent to the tasks once.

    Test rows start at `split_date`: their number, and whether their predictions are finite. On the rows before it, whether
    the error is lower than that of their mean.
    """
    test = F.col("order_date") >= F.lit(split_date).cast("date")
    y, p = F.col(label).cast("double"), F.col("prediction")
    finite = p.isNotNull() & ~F.isnan(p) & (F.abs(p) < 1e300)
    return scored.agg(
        F.count(F.when(test, 1)).alias("rows"),
        F.every(~test | finite).alias("finite"),
        (F.avg(F.when(~test, (y - p) * (y - p))) < F.var_pop(F.when(~test, y))).alias("beats_mean"),
    ).select(F.lit(model).alias("model"), "rows", "finite", "beats_mean")


def model_checks(
    train_scored: DataFrame, test_scored: DataFrame, model: str, label: str = TARGET
) -> DataFrame:
    """One row of what any fitted model must satisfy: model, rows, finite, within_labels, beats_mean, balanced.

    Finite predictions on the test rows; predictions inside the range of the training labels (true of averages, as in a
    forest); a lower error on the training rows than their mean has; training residuals without a mean and without a
    trend along yesterday's quantity (true of least squares).
    """
    y, p = F.col(label).cast("double"), F.col("prediction")
    fitted = train_scored.agg(
        F.min(y).alias("low"),
        F.max(y).alias("high"),
        (F.avg((y - p) * (y - p)) < F.var_pop(y)).alias("beats_mean"),
        (
            (F.abs(F.avg(y - p)) < 0.01 * F.stddev_pop(y))
            & (F.abs(F.coalesce(F.corr(y - p, F.col("quantity_lag_1")), F.lit(0.0))) < 0.01)
        ).alias("balanced"),
    )
    tested = test_scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.every(p.isNotNull() & ~F.isnan(p) & (F.abs(p) < 1e300)).alias("finite"),
        F.min(p).alias("least"),
        F.max(p).alias("most"),
    )
    # One row each.
    both = tested.withColumn("k", F.lit(1)).join(fitted.withColumn("k", F.lit(1)), "k")
    return both.select(
        F.lit(model).alias("model"),
        "rows",
        "finite",
        ((F.col("least") >= F.col("low") - 1e-6) & (F.col("most") <= F.col("high") + 1e-6)).alias("within_labels"),
        "beats_mean",
        "balanced",
    )


def mean_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """`test` with the mean training target as prediction."""
    return test.withColumn("prediction", train.agg(F.avg(TARGET)).scalar())


def naive_lag_baseline(test: DataFrame) -> DataFrame:
    """`test` with yesterday's quantity as prediction."""
    return test.withColumn("prediction", F.col("quantity_lag_1"))


def feature_stages(series: str = "series") -> list:
    """Encode the series (all levels kept, sparse) and assemble the feature vector."""
    return [
        StringIndexer(inputCol=series, outputCol="series_index", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="series_index", outputCol="series_flags", dropLast=False),
        VectorAssembler(inputCols=[*FEATURES, "series_flags"], outputCol="features"),
    ]


def linear_regression() -> LinearRegression:
    """Least squares with intercept, unregularized."""
    return LinearRegression(labelCol=TARGET, regParam=0.0)


def random_forest(
    max_depth: int | None = None, min_leaf: int = 1, trees: int = 100, seed: int = SEED
) -> RandomForestRegressor:
    """Forest over all features per split; `max_depth` None grows to the deepest allowed."""
    return RandomForestRegressor(
        labelCol=TARGET,
        numTrees=trees,
        maxDepth=DEEPEST if max_depth is None else max_depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="all",
        maxBins=256,
        # Deep trees: keep each row's node instead of walking from the root at every level.
        cacheNodeIds=max_depth is None,
        # Of each task at once; the trees are the same, a larger buffer takes fewer passes.
        maxMemoryInMB=256,
        seed=seed,
    )


def gradient_boosting(
    rounds: int = 100, step: float = 0.1, max_depth: int = 3, seed: int = SEED
) -> GBTRegressor:
    return GBTRegressor(
        labelCol=TARGET,
        maxIter=rounds,
        stepSize=step,
        maxDepth=max_depth,
        lossType="squared",
        maxBins=256,
        seed=seed,
    )


def default_regressors() -> dict:
    """The model configurations of the comparison."""
    return {
        "linear_regression": linear_regression(),
        "random_forest_default": random_forest(),
        "random_forest_best": random_forest(max_depth=6, min_leaf=5),
        "gradient_boosting_default": gradient_boosting(),
        "gradient_boosting_best": gradient_boosting(rounds=200, step=0.05),
    }


def fit_model(train: DataFrame, regressor, series: str = "series") -> PipelineModel:
    """The fitted pipeline. Deep forests and boosting go over the rows hundreds of times; with a folder to checkpoint to,
    they cut the lineage of what they keep about each row."""
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(train.sparkSession))
    if isinstance(regressor, RandomForestRegressor) and regressor.getCacheNodeIds() and regressor.getNumTrees() >= 4:
        return _fit_in_shares(train, regressor, series)
    return Pipeline(stages=[*feature_stages(series), regressor]).fit(train)


def _fit_in_shares(train: DataFrame, regressor: RandomForestRegressor, series: str) -> PipelineModel:
    """A deep forest as forests of some of its trees, whose mean it predicts.

    Most nodes of a deep tree hold few rows, and every task sends its whole table of candidate splits for each of them. So
    a share sees all rows in as few tasks as there are to a share, and the shares run side by side. Their samples differ by
    seed; the rows have a fixed order, so that the model does not depend on the machine.
    """
    stages = Pipeline(stages=feature_stages(series)).fit(train)
    tasks = max(1, train.rdd.getNumPartitions() // FOREST_SHARES)
    order = [c for c in (series, "order_date") if c in train.columns]
    rows = stages.transform(train).repartition(tasks, *order).sortWithinPartitions(*order)
    label, out, trees = regressor.getLabelCol(), regressor.getPredictionCol(), regressor.getNumTrees()
    rows = rows.select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    shares = min(FOREST_SHARES, trees // 2)
    sizes = [trees // shares + (i < trees % shares) for i in range(shares)]

    def fit(i: int):
        own = {regressor.numTrees: sizes[i], regressor.seed: regressor.getSeed() + i}
        own |= {regressor.predictionCol: f"__share_{i}", regressor.maxMemoryInMB: SHARE_MB}
        return regressor.copy(own).fit(rows)

    with ThreadPool(shares) as pool:
        fitted = pool.map(inheritable_thread_target(train.sparkSession)(fit), range(shares))
    rows.unpersist()
    parts = ", ".join(f"__share_{i}" for i in range(shares))
    total = " + ".join(f"{n} * __share_{i}" for i, n in enumerate(sizes))
    mean = SQLTransformer(statement=f"SELECT * EXCEPT ({parts}), ({total}) / {trees}.0D AS {out} FROM __THIS__")
    return PipelineModel([*stages.stages, *fitted, mean])


def compare_models(
    train: DataFrame,
    test: DataFrame,
    regressors: Mapping | None = None,
    series: str = "series",
    parallelism: int = 5,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Metrics of both baselines and of every regressor on `test`, and the fitted models.

    The metrics are ordered by RMSE. Give a validation slice as `test` to choose.
    `parallelism` fits run side by side: boosting is many short jobs that leave cores idle.
    """
    regressors = dict(regressors or default_regressors())
    fit = inheritable_thread_target(train.sparkSession)(
        lambda name: fit_model(train, regressors[name], series)
    )
    with ThreadPool(min(parallelism, len(regressors))) as pool:
        fitted = dict(zip(regressors, pool.map(fit, regressors)))
    table = regression_metrics(mean_baseline(train, test), "mean_baseline").unionByName(
        regression_metrics(naive_lag_baseline(test), "naive_lag_baseline")
    )
    for name, model in fitted.items():
        table = table.unionByName(regression_metrics(model.transform(test), name))
    return table.orderBy("rmse", "model"), fitted


def feature_names(model: PipelineModel, series: str = "series") -> list[str]:
    """Names in the order of the assembled vector."""
    return [*FEATURES, *[f"{series}_{label}" for label in model.stages[0].labels]]


def feature_importance(
    model: PipelineModel, spark, top: int | None = 15, series: str = "series"
) -> DataFrame:
    """(feature, importance) of a fitted tree model, the `top` largest or all.

    One number per feature and series comes to the driver, as the model itself does.
    """
    # A forest fitted in shares: their mean by trees.
    forests = [m for m in model.stages if isinstance(m, RandomForestRegressionModel)] or [model.stages[-1]]
    weights = sum(m.featureImportances.toArray() * m.getNumTrees for m in forests) if len(forests) > 1 else None
    weights = forests[0].featureImportances.toArray() if weights is None else weights / weights.sum()
    rows = [(name, float(w)) for name, w in zip(feature_names(model, series), weights)]
    listed = spark.createDataFrame(rows, "feature string, importance double")
    ordered = listed.orderBy(F.desc("importance"), "feature")
    return ordered if top is None else ordered.limit(top)


def save_model(model: PipelineModel, path: str) -> None:
    """Write the pipeline; the feature order is part of it."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
