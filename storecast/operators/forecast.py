"""Recursive multi-day forecasts for all series at once.

Each series is one row that carries its last seven quantities. A horizon step
reads that state, predicts, and pushes the prediction in; the number of steps is
the horizon, the number of rows stays the number of series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.functions import round_half_even
from storecast.operators.compiled import ColumnModel
from storecast.operators.features import FESTIVAL_MONTHS, WEEKEND_DAYS
from storecast.session import shared_root

WEEK = 7
STEPS_TYPE = "array<struct<horizon:int,prediction:double>>"
# Lineage of a longer model-driven horizon is cut this often.
STEPS_PER_CHECKPOINT = 14

# A predictor maps named feature columns of one step to the predicted quantity.
Predictor = Callable[[dict[str, Column]], Column]


def rolling_mean_predictor(features: dict[str, Column]) -> Column:
    return features["quantity_rolling_7"]


def last_value_predictor(features: dict[str, Column]) -> Column:
    return features["quantity_lag_1"]


def recent_state(history: DataFrame, series: str = "series") -> DataFrame:
    """(series, recent, last_day): the last seven quantities, oldest first, and the day
    of the newest; fewer if history is short.

    The rank filter lets Spark keep seven rows per series before the shuffle.
    """
    newest = Window.partitionBy(series).orderBy(F.col("order_date").desc())
    last = (
        history.select(series, "order_date", "quantity")
        .withColumn("age", F.row_number().over(newest))
        .where(F.col("age") <= WEEK)
    )
    row = F.struct("order_date", F.col("quantity").cast("double").alias("quantity"))
    kept = last.groupBy(series).agg(F.sort_array(F.collect_list(row)).alias("kept"))
    return kept.select(
        series,
        F.transform("kept", lambda r: r["quantity"]).alias("recent"),
        F.element_at("kept", -1)["order_date"].alias("last_day"),
    )


def _start_state(
    history: DataFrame, series: str, context: DataFrame | None = None
) -> DataFrame:
    """State with `first_day`, the day after the newest day of any series, and an empty `out`.

    The newest day comes from the state as well, in a subquery that reads the same
    shuffle. Columns of `context`, one row per series, are joined to it.
    """
    state = recent_state(history, series)
    newest = state.agg(F.max("last_day")).scalar()
    started = state.select(
        series,
        "recent",
        F.date_add(newest, 1).alias("first_day"),
        F.expr(f"cast(array() as {STEPS_TYPE})").alias("out"),
    )
    return started if context is None else started.join(context, series, "left")


def _result(state: DataFrame, series: str, steps: Column) -> DataFrame:
    return state.select(series, "first_day", F.inline(steps)).select(
        series,
        F.date_add(F.col("first_day"), F.col("horizon") - 1).alias("order_date"),
        "horizon",
        "prediction",
        round_half_even(F.col("prediction"), 2).alias("predicted_quantity"),
    )


def _lags(recent: Column) -> dict[str, Column]:
    """Lag and rolling features of the day after `recent`, summed oldest first."""
    total = F.aggregate(recent, F.lit(0.0), lambda acc, x: acc + x)
    return {
        "quantity_lag_1": F.element_at(recent, -1),
        "quantity_lag_7": F.element_at(recent, 1),
        "quantity_rolling_7": total / F.size(recent),
    }


def _calendar(day: Column) -> dict[str, Column]:
    weekday, month = F.weekday(day), F.month(day)
    return {
        "day_of_week": weekday,
        "month": month,
        "is_weekend": weekday.isin(*WEEKEND_DAYS).cast("int"),
        "is_festival_season": month.isin(*FESTIVAL_MONTHS).cast("int"),
    }


def _push(recent: Column, value: Column) -> Column:
    longer = F.concat(recent, F.array(value))
    return F.slice(longer, F.greatest(F.size(longer) - (WEEK - 1), F.lit(1)), WEEK)


def forecast_with_columns(
    history: DataFrame,
    predictor: Predictor,
    n_days: int = 7,
    series: str = "series",
    step_digits: int | None = None,
    context: DataFrame | None = None,
) -> DataFrame:
    """(series, order_date, horizon, prediction, predicted_quantity) from a column predictor.

    The recursion is one fold over 1..n_days inside a single projection, so the
    plan does not grow with the horizon. `step_digits` rounds the value that is
    fed back; `predicted_quantity` is the output at two digits. `context` has columns
    that the predictor reads besides the features, one row per series, and NULL where
    a series has none.
    """

    def step(acc: Column, h: Column) -> Column:
        day = F.date_add(F.col("first_day"), h - 1)
        value = predictor({**_lags(acc["recent"]), **_calendar(day)}).cast("double")
        if step_digits is not None:
            value = round_half_even(value, step_digits)
        # A one-element array binds the prediction once for its three uses.
        bound = F.transform(
            F.array(value),
            lambda v: F.struct(
                _push(acc["recent"], v).alias("recent"),
                F.concat(
                    acc["out"], F.array(F.struct(h.alias("horizon"), v.alias("prediction")))
                ).alias("out"),
            ),
        )
        return bound[0]

    start = F.struct("recent", "out")
    days = F.sequence(F.lit(1), F.lit(n_days))
    steps = F.aggregate(days, start, step, lambda acc: acc["out"])
    return _result(_start_state(history, series, context), series, steps)


def forecast_with_model(
    history: DataFrame, model: PipelineModel, n_days: int = 7, series: str = "series"
) -> DataFrame:
    """Same result columns from a fitted pipeline; one batch transform per day ahead."""
    context = history.sparkSession.sparkContext
    state = _start_state(history, series)
    for h in range(1, n_days + 1):
        day = F.date_add(F.col("first_day"), h - 1)
        features = {**_lags(F.col("recent")), **_calendar(day)}
        scored = model.transform(state.withColumns(features))
        step = F.struct(F.lit(h).alias("horizon"), F.col("prediction").alias("prediction"))
        state = scored.select(
            series,
            "first_day",
            _push(F.col("recent"), F.col("prediction")).alias("recent"),
            F.concat("out", F.array(step)).alias("out"),
        )
        if h % STEPS_PER_CHECKPOINT == 0 and h < n_days:
            if context.getCheckpointDir() is None:
                context.setCheckpointDir(shared_root(history.sparkSession))
            state = state.checkpoint()
    return _result(state, series, F.col("out"))


def forecast(
    history: DataFrame,
    predictor: Predictor | PipelineModel,
    n_days: int = 7,
    series: str = "series",
    step_digits: int | None = None,
) -> DataFrame:
    """Forecast with either kind of predictor.

    Linear and tree pipelines are walked as columns, in one projection; others, and forests too large for a plan, by one
    transform per day.
    """
    if isinstance(predictor, PipelineModel):
        if not ColumnModel.fits(predictor):
            return forecast_with_model(history, predictor, n_days, series)
        walked = ColumnModel(predictor, series)
        context = walked.context(history.sparkSession)
        return forecast_with_columns(history, walked, n_days, series, step_digits, context)
    return forecast_with_columns(history, predictor, n_days, series, step_digits)
