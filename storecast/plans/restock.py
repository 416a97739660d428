"""Reorder points, triggers, order quantities and the restocking report."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storecast.functions import clip_low, round_half_even, round_to_multiple
from storecast.operators.forecast import Predictor, forecast
from storecast.operators.models import load_model


def current_stock(inventory: DataFrame, series: str = "series") -> DataFrame:
    return inventory.select(series, F.col("stock_available").cast("double").alias("stock_available"))


def with_names(df: DataFrame, products: DataFrame, series: str = "product_id") -> DataFrame:
    """Add the product name next to the key."""
    named = df.join(products.select(series, "product_name"), series, "left")
    return named.select(series, "product_name", *[c for c in df.columns if c != series])


def reorder_points(
    history: DataFrame,
    predictor: Predictor | PipelineModel,
    lead_time_days: int = 7,
    round_to: int = 5,
    series: str = "series",
    step_digits: int | None = None,
) -> DataFrame:
    """Next-day demand per series, and that demand over the lead time as the reorder point.

    The point uses the unrounded prediction; the demand column shows two digits.
    """
    ahead = forecast(history, predictor, 1, series, step_digits)
    return ahead.select(
        series,
        F.col("predicted_quantity").alias("predicted_daily_demand"),
        round_half_even(
            round_to_multiple(F.col("prediction") * F.lit(float(lead_time_days)), round_to), 2
        ).alias("reorder_point"),
    )


def reorder_triggers(points: DataFrame, stock: DataFrame, series: str = "series") -> DataFrame:
    """Join stock; `needs_reorder` when it is at or below the reorder point."""
    return points.join(stock, series).withColumn(
        "needs_reorder", F.col("stock_available") <= F.col("reorder_point")
    )


def order_quantities(
    triggers: DataFrame, order_coverage_days: int = 30, round_to: int = 5
) -> DataFrame:
    """Add `recommended_order_qty`: the demand to cover minus stock, if triggered, else 0."""
    wanted = F.col("predicted_daily_demand") * F.lit(float(order_coverage_days))
    raw = F.when(F.col("needs_reorder"), wanted - F.col("stock_available")).otherwise(F.lit(0.0))
    quantity = round_half_even(round_to_multiple(clip_low(raw), round_to), 2)
    return triggers.withColumn("recommended_order_qty", quantity)


def erratic_from_parameters(parameters: DataFrame, series: str = "product_id") -> DataFrame:
    """(series, erratic_demand_flag) from a known probability of days without orders."""
    return parameters.select(
        series,
        (F.coalesce("zero_order_prob", F.lit(0.0)) > 0).alias("erratic_demand_flag"),
    )


def erratic_from_history(
    grid: DataFrame, threshold: float = 0.0, series: str = "series"
) -> DataFrame:
    """(series, zero_day_share, erratic_demand_flag) from the share of days without sales."""
    zero = F.sum((F.col("quantity") == 0).cast("long")).cast("double")
    share = zero / F.count(F.lit(1)).cast("double")
    return (
        grid.groupBy(series)
        .agg(share.alias("zero_day_share"))
        .withColumn("erratic_demand_flag", F.col("zero_day_share") > F.lit(threshold))
    )


def erratic_from_daily(
    daily: DataFrame, members: DataFrame, days: int, threshold: float = 0.0, series: str = "series"
) -> DataFrame:
    """The same from daily sales, without the dense grid: days that sell are counted, the rest of `days` are zero."""
    active = daily.where(F.col("quantity") != 0).groupBy(series).agg(F.count(F.lit(1)).alias("active"))
    share = (F.lit(days) - F.coalesce("active", F.lit(0))).cast("double") / F.lit(float(days))
    shares = members.select(series).join(active, series, "left").select(series, share.alias("zero_day_share"))
    return shares.withColumn("erratic_demand_flag", F.col("zero_day_share") > F.lit(threshold))


def inventory_sanity(recommendations: DataFrame) -> DataFrame:
    """Counts of negative predicted demand and negative order quantities."""
    return recommendations.agg(
        F.count(F.when(F.col("predicted_daily_demand") < 0, 1)).alias("negative_demand"),
        F.count(F.when(F.col("recommended_order_qty") < 0, 1)).alias("negative_orders"),
    )


def inventory_report(
    history: DataFrame,
    predictor: Predictor | PipelineModel,
    stock: DataFrame,
    erratic: DataFrame,
    lead_time_days: int = 7,
    order_coverage_days: int = 30,
    round_to: int = 5,
    series: str = "series",
    step_digits: int | None = None,
) -> DataFrame:
    """One row per series with stock: what to order, and whether to review it by hand.

    Rows that need action come first.
    """
    points = reorder_points(history, predictor, lead_time_days, round_to, series, step_digits)
    sized = order_quantities(reorder_triggers(points, stock, series), order_coverage_days, round_to)
    flags = erratic.select(series, "erratic_demand_flag")
    review = F.col("needs_reorder") & F.col("erratic_demand_flag")
    return (
        sized.join(flags, series, "left")
        .withColumn("erratic_demand_flag", F.coalesce("erratic_demand_flag", F.lit(False)))
        .withColumn("status", F.when(F.col("needs_reorder"), "reorder").otherwise("ok"))
        .withColumn("review_note", F.when(review, "erratic demand: review by hand").otherwise(""))
        .orderBy(F.desc("needs_reorder"), series)
    )


def restock_from_saved(
    path: str,
    history: DataFrame,
    inventory: DataFrame,
    parameters: DataFrame,
    lead_time_days: int = 7,
    order_coverage_days: int = 30,
    round_to: int = 5,
    series: str = "series",
) -> DataFrame:
    """The report with a stored model, the stock table and the demand parameters."""
    return inventory_report(
        history,
        load_model(path),
        current_stock(inventory, series),
        erratic_from_parameters(parameters, series),
        lead_time_days,
        order_coverage_days,
        round_to,
        series,
    )
