"""Expected demand, the trend check against it, and exact proportional allocation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.functions import calendar_days, clip_low, pct_change
from storecast.operators.ranking import block_bits, cell, key_block, number_in_cell

CENTS = "decimal(14,0)"
DAYS_PER_YEAR = 365.0
# Groups of at most so many parts are ranked by one window; larger ones by cells.
WINDOW_PARTS = 1024
# Buckets of the remainder of a share, at most so many per group.
REMAINDER_BUCKETS = 2**20


def expected_demand(
    parameters: DataFrame, start: str, end: str, series: str = "series"
) -> DataFrame:
    """Mean daily demand per series and day: (series, order_date, expected_quantity).

    Base demand times the yearly trend, the multiplier of a seasonal month, the
    middle of the noise range and the share of days with orders; never negative.
    """
    spine = parameters.select("*", F.explode(calendar_days(start, end)).alias("order_date"))
    day_no = (F.datediff("order_date", F.lit(start).cast("date")) + 1).cast("double")
    trend = F.lit(1.0) + F.col("trend") * (day_no / F.lit(DAYS_PER_YEAR))
    in_season = F.array_contains("seasonal_months", F.month("order_date"))
    season = F.when(in_season, F.col("seasonal_multiplier")).otherwise(F.lit(1.0))
    noise = (F.col("noise_low") + F.col("noise_high")) / F.lit(2.0)
    active = F.lit(1.0) - F.col("zero_order_prob")
    return spine.select(
        series,
        "order_date",
        clip_low(F.col("base_demand") * trend * season * noise * active).alias("expected_quantity"),
    )


def period_change(
    daily: DataFrame,
    quantity: str,
    base: tuple[str, str],
    compare: tuple[str, str],
    series: str = "series",
) -> DataFrame:
    """(series, pct_change) between two half-open periods of a daily series.

    Summed as decimals, so the result does not depend on the order of rows.
    """

    def total(period: tuple[str, str]) -> Column:
        first, last = (F.lit(day).cast("date") for day in period)
        inside = (F.col("order_date") >= first) & (F.col("order_date") < last)
        exact = F.col(quantity).cast("decimal(24,6)")
        return F.sum(F.when(inside, exact).otherwise(F.lit(0).cast("decimal(24,6)")))

    sums = daily.groupBy(series).agg(total(base).alias("b"), total(compare).alias("c"))
    return sums.select(series, pct_change(F.col("b"), F.col("c")).alias("pct_change"))


def trend_ground_truth(
    expected: DataFrame,
    measured: DataFrame,
    base: tuple[str, str],
    compare: tuple[str, str],
    series: str = "series",
) -> DataFrame:
    """Designed against measured change per series, and whether the directions agree."""
    designed = period_change(expected, "expected_quantity", base, compare, series)
    found = period_change(measured, "quantity", base, compare, series)
    return (
        designed.withColumnRenamed("pct_change", "expected_pct")
        .join(found.withColumnRenamed("pct_change", "measured_pct"), series)
        .withColumn(
            "same_direction", F.signum("expected_pct") == F.signum("measured_pct")
        )
    )


def proportional_allocation(
    totals: DataFrame,
    parts: DataFrame,
    group: Sequence[str],
    key: str,
    mode: str = "last",
) -> tuple[DataFrame, DataFrame]:
    """Split each group's `total` over its parts by `weight`, to the cent.

    `totals` has the group columns and `total`; `parts` has them, an integer `key`
    unique within the group, and `weight`. Both amounts are DECIMAL(12,2). Parts
    of a group add up to its total exactly.

    mode "last": every part is rounded, the part with the highest key takes the
    difference (and may end up non-positive, which `non_positive` shows).
    mode "largest_remainder": parts are cut to the cent and the spare cents go to
    the largest remainders, then the larger weights, then the lower keys.

    Returns (allocated, rejected). Totals that are not positive, without parts, or
    whose weights are negative or add up to zero are rejected with a `reason`.

    Group figures are combined on the map side and joined back. Keys that are structs make
    the steps after a join on the group shuffle anew, which leaves Spark free to split that
    join where one group is very large. Mode "last" needs nothing else. To rank remainders,
    groups of at most WINDOW_PARTS parts take one window, in the shuffle of the join. In larger
    ones, which one job looks for, parts with the same weight get the same share, so the ranking
    runs on (group, weight, key block) cells and rows only look up their cell.
    """
    if mode not in ("last", "largest_remainder"):
        raise ValueError(f"unknown mode: {mode}")
    group = list(group)
    weighed = parts.select(*group, key, "weight").withColumn("w", (F.col("weight") * 100).cast(CENTS))
    sums = weighed.groupBy(*group).agg(
        F.sum("w").cast("decimal(38,0)").alias("w_sum"),
        F.min(F.coalesce("w", F.lit(-1).cast(CENTS))).alias("w_min"),
        F.max(key).alias("group_last"),
        F.count(F.lit(1)).alias("n_parts"),
    )
    priced = totals.select(*group, (F.col("total") * 100).cast(CENTS).alias("t"))
    reason = (
        F.when(F.col("t").isNull() | (F.col("t") <= 0), "total is not positive")
        .when(F.col("w_min").isNull(), "no parts")
        .when(F.col("w_min") < 0, "missing or negative weight")
        .when(F.col("w_sum") <= 0, "weights add up to zero")
    )
    # Totals go left: a total without parts must come out as rejected.
    judged = priced.join(sums, group, "left").withColumn("reason", reason)
    rejected = judged.where(F.col("reason").isNotNull()).select(
        *group, (F.col("t") / 100).cast("decimal(12,2)").alias("total"), "reason"
    )
    valid = judged.where(F.col("reason").isNull()).select(*group, "t", "w_sum", "group_last", "n_parts")
    if mode == "last":
        found = _last_takes_rest(weighed.join(valid, group), group, key)
    else:
        small = F.col("n_parts") <= WINDOW_PARTS
        found = _ranked_remainders(weighed.join(valid.where(small), group), group, key)
        # One number: parts of the largest group.
        most = weighed.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (most or 0) > WINDOW_PARTS:
            large = valid.where(~small)
            held = weighed.join(large.select(*group).distinct(), group, "left_semi")
            found = found.unionByName(_largest_remainders(held, large, group, key))
    allocated = found.select(
        *group, key, "weight", (F.col("cents").cast(CENTS) / 100).cast("decimal(12,2)").alias("allocated")
    )
    return allocated.withColumn("non_positive", F.col("allocated") <= 0), rejected


def _last_takes_rest(shared: DataFrame, group: list[str], key: str) -> DataFrame:
    """Rounded shares; the part with the last key also has what they leave of the total."""
    rounded = shared.withColumn("cents", F.expr("(2 * t * w + w_sum) div (2 * w_sum)"))
    rests = rounded.groupBy(cell(group).alias("g")).agg(
        (F.max("t") - F.sum("cents")).cast("long").alias("rest"), F.max("group_last").alias("last")
    )
    lasts = rests.select("g.*", F.col("last").alias(key), "rest").select(
        cell([*group, key]).alias("part"), "rest"
    )
    rows = rounded.select(*group, key, "weight", "cents", cell([*group, key]).alias("part"))
    return rows.join(lasts, "part", "left").withColumn(
        "cents", F.col("cents") + F.coalesce("rest", F.lit(0))
    )


def _ranked_remainders(shared: DataFrame, group: list[str], key: str) -> DataFrame:
    """Shares cut to the cent; the largest remainders of a group take the spare cents. For groups that a window holds."""
    cut = shared.select(
        *group,
        key,
        "weight",
        "w",
        "t",
        F.expr("(t * w) div w_sum").alias("cents"),
        F.expr("(t * w) % w_sum").alias("remainder"),
    )
    whole = Window.partitionBy(*group)
    first = whole.orderBy(F.desc("remainder"), F.desc("w"), key)
    spare = (F.max("t").over(whole) - F.sum("cents").over(whole)).cast("long")
    added = F.when(F.row_number().over(first) <= spare, F.lit(1)).otherwise(F.lit(0))
    return cut.select(*group, key, "weight", (F.col("cents") + added).alias("cents"))


def _largest_remainders(weighed: DataFrame, valid: DataFrame, group: list[str], key: str) -> DataFrame:
    """Shares cut to the cent; the first parts of a cell take one cent more, as many as `_spare_cents` says."""
    block = key_block(key, dict(weighed.dtypes)[key], block_bits(weighed, key))
    blocked = weighed.withColumn("block", block)
    cells = blocked.groupBy(*group, "weight", "w", "block").agg(F.count(F.lit(1)).alias("n"))
    lookup = _spare_cents(cells.join(valid, group), group)
    rows = blocked.select(*group, key, "weight", _cell_of(group).alias("cell"))
    rows = rows.withColumn("position", number_in_cell("cell", [key]))
    added = F.when(F.col("position") <= F.col("extra"), F.lit(1)).otherwise(F.lit(0))
    return rows.join(lookup, "cell").select(*group, key, "weight", (F.col("cents") + added).alias("cents"))


def _cell_of(group: list[str]) -> Column:
    return cell([*group, "weight", "block"])


def _undivided() -> Column:
    """What the shares of a group leave of its total, in cents."""
    return (F.max("t") - F.sum(F.col("cents") * F.col("n"))).cast("long")


def _spare_cents(shared: DataFrame, group: list[str]) -> DataFrame:
    """(cell, cents, extra): shares cut to the cent, and how many parts of the cell, lowest
    keys first, take one cent more.

    Cells are ranked by remainder in two steps, by bucket of the remainder and inside
    a bucket, so no window holds all cells of a group.
    """
    cut = shared.select(
        "*",
        F.expr("(t * w) div w_sum").alias("cents"),
        F.expr("(t * w) % w_sum").alias("remainder"),
    )
    bucketed = cut.withColumn(
        "bucket", F.expr(f"(remainder * {REMAINDER_BUCKETS}) div w_sum")
    ).withColumn("b", cell([*group, "bucket"]))
    spares = cut.groupBy(cell(group).alias("g")).agg(_undivided().alias("spare"))
    earlier = (
        Window.partitionBy("g")
        .orderBy(F.desc("bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    buckets = (
        bucketed.groupBy("b")
        .agg(F.sum("n").alias("bucket_n"))
        .select("b", "b.*", "bucket_n")
        .withColumn("g", cell(group))
        .withColumn("taken", F.coalesce(F.sum("bucket_n").over(earlier), F.lit(0).cast("long")))
        .join(spares, "g")
        .select("b", (F.col("spare") - F.col("taken")).alias("left"))
    )
    inside = (
        Window.partitionBy("b")
        .orderBy(F.desc("remainder"), F.desc("w"), "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("n").over(inside), F.lit(0).cast("long"))
    ranked = bucketed.withColumn("before", before).join(buckets, "b")
    extra = F.least(F.greatest(F.col("left") - F.col("before"), F.lit(0)), F.col("n"))
    return ranked.select(_cell_of(group).alias("cell"), "cents", extra.alias("extra"))
