"""Dense daily series, calendar and lag features, chronological split.

After the daily sum a series has one row per calendar day, whatever its sales,
so the per-series windows below sort at most as many rows as the calendar has days.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from storecast.functions import calendar_days

FEATURES = [
    "day_of_week",
    "month",
    "is_weekend",
    "is_festival_season",
    "quantity_lag_1",
    "quantity_lag_7",
    "quantity_rolling_7",
]
TARGET = "quantity"
HISTORY = ["quantity_lag_1", "quantity_lag_7", "quantity_rolling_7"]

# Days after a sale on which lags and rolling mean still see it.
REACH = 7

# Lines, or daily sales, that a task holds where they are dealt out by count.
ROWS_PER_TASK = 1 << 20

# Monday is 0, so 5 and 6 are the weekend; October and November.
WEEKEND_DAYS = (5, 6)
FESTIVAL_MONTHS = (10, 11)


def _dated(orders: DataFrame, start: str | None, end: str | None) -> DataFrame:
    dated = orders.select("order_id", "order_date")
    if start is not None:
        dated = dated.where(F.col("order_date") >= F.lit(start).cast("date"))
    if end is not None:
        dated = dated.where(F.col("order_date") <= F.lit(end).cast("date"))
    return dated


def daily_sales(
    items: DataFrame,
    orders: DataFrame,
    series: str = "product_id",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Exact quantity per series and day, optionally only days from `start` to `end`."""
    return (
        items.select("order_id", series, "quantity")
        .join(_dated(orders, start, end), "order_id")
        .groupBy(series, "order_date")
        .agg(F.sum("quantity").alias("quantity"))
    )


def sales_by_series(
    items: DataFrame,
    orders: DataFrame,
    series: str = "product_id",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """`daily_sales` for very many series, dealt out by series for the windows that follow.

    The lines are counted first, and a task gets some ROWS_PER_TASK of them however many there are: its memory does not
    grow and nothing is spilled. Most lines are the only ones of their series and day, so they are not summed before the
    shuffle; a series with very many lines is spread by its days. Orders are looked up, the lines are not sorted.
    """
    tasks = max(items.sparkSession.sparkContext.defaultParallelism, math.ceil(items.count() / ROWS_PER_TASK))
    dated = _dated(orders, start, end).hint("shuffle_hash")
    lines = items.select("order_id", series, "quantity").join(dated, "order_id").select(series, "order_date", "quantity")
    daily = lines.repartition(tasks, series, "order_date").groupBy(series, "order_date")
    return daily.agg(F.sum("quantity").alias("quantity")).repartition(tasks, series)


def complete_grid(
    daily: DataFrame, members: DataFrame, start: str, end: str, series: str = "series"
) -> DataFrame:
    """Every member of `members` on every day; days without sales are zero.

    Sales of other series or outside the calendar are left out.
    """
    spine = members.select(series, F.explode(calendar_days(start, end)).alias("order_date"))
    return spine.join(daily, [series, "order_date"], "left").select(
        series,
        "order_date",
        F.coalesce("quantity", F.lit(0).cast("decimal(12,2)")).alias("quantity"),
    )


def calendar_features(df: DataFrame, date: str = "order_date") -> DataFrame:
    day, month = F.weekday(date), F.month(date)
    return df.select(
        "*",
        day.alias("day_of_week"),
        month.alias("month"),
        day.isin(*WEEKEND_DAYS).cast("int").alias("is_weekend"),
        month.isin(*FESTIVAL_MONTHS).cast("int").alias("is_festival_season"),
    )


def lag_features(df: DataFrame, series: str = "series") -> DataFrame:
    """Quantity one and seven rows back, and the mean of the seven rows before this one.

    The mean is NULL until seven earlier rows exist. All three share one window sort.
    """
    by_day = Window.partitionBy(series).orderBy("order_date")
    week = by_day.rowsBetween(-7, -1)
    seen = F.count("quantity").over(week)
    mean = F.sum("quantity").over(week).cast("double") / F.lit(7.0)
    return df.select(
        "*",
        F.lag("quantity", 1).over(by_day).cast("double").alias("quantity_lag_1"),
        F.lag("quantity", 7).over(by_day).cast("double").alias("quantity_lag_7"),
        F.when(seen == 7, mean).alias("quantity_rolling_7"),
    )


def build_features(grid: DataFrame, series: str = "series") -> DataFrame:
    """Calendar and lag features; the quantity leaves as double."""
    return calendar_features(lag_features(grid, series)).withColumn(
        "quantity", F.col("quantity").cast("double")
    )


def days_in_reach(
    sales: DataFrame, start: str, end: str, series: str = "series", reach: int | None = REACH
) -> DataFrame:
    """Of the dense grid, only the days that a sale can matter to, with their history: it and the `reach` days after.

    `sales` has one row per series and day, none outside the calendar. Each fills the days up to the next one with zeros,
    `reach` at most; with `reach` None all of them, and the first also those before it. On all other days of the calendar
    quantity, lags and means are zero.

    Windows run over the sales: lags and means of the week behind a sale follow from the sales of the week before it. Days
    are listed afterwards, so none of them is sorted or shuffled. One shuffle by series, which `sales` may bring along.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    by_day = Window.partitionBy(series).orderBy("__day")
    # Decimals are counted in their smallest unit, as integers: sums are exact, and a sum out of range is an error.
    kind = sales.schema["quantity"].dataType
    unit = float(10**kind.scale) if isinstance(kind, DecimalType) else 1.0
    amount = F.coalesce("quantity", F.lit(0).cast("decimal(12,2)"))
    amount = (amount * F.lit(int(unit))).cast("bigint") if unit > 1 else amount.cast("double")

    def total(begin: int, until: int):
        return F.coalesce(F.sum("__amount").over(by_day.rangeBetween(begin, until)), F.lit(0))

    ahead = [F.date_sub(F.coalesce(F.lead("order_date").over(by_day), F.date_add(last, 1)), 1), last]
    ahead += [] if reach is None else [F.date_add("order_date", reach)]
    opens = F.lag("__day").over(by_day).isNull() if reach is None else F.lit(False)
    numbered = sales.select(
        series, "order_date", "quantity", F.datediff("order_date", first).alias("__day"), amount.alias("__amount")
    )
    seen = numbered.select(
        "*",
        F.when(opens, -F.col("__day")).otherwise(F.lit(0)).alias("__from"),
        F.datediff(F.least(*ahead), "order_date").alias("__to"),
        # Quantity 7, 6, ... 1 days before the sale, and of all seven.
        *[total(-k, -k).alias(f"__back_{k}") for k in range(REACH, 0, -1)],
        total(-REACH, -1).alias("__week"),
    )
    days = [*[F.col(f"__back_{k}") for k in range(REACH, 0, -1)], F.col("__amount")]
    sums = days[-1:]
    for day in reversed(days[1:-1]):
        sums.insert(0, day + sums[0])
    listed = seen.select(
        series,
        "order_date",
        "quantity",
        "__day",
        "__amount",
        "__back_1",
        # By days after the sale, 0 to 7; nothing is held beyond.
        F.array(*days).alias("__lags_7"),
        F.array(F.col("__week"), *sums).alias("__sums"),
        F.explode(F.sequence("__from", "__to")).alias("__ahead"),
    )
    after = F.col("__ahead")

    def history(column: str, complete_from: int, held, divisor: float = 1.0):
        value = F.coalesce(held.cast("double") / F.lit(unit), F.lit(0.0)) / F.lit(divisor)
        return F.when(F.col("__day") + after >= complete_from, value).alias(column)

    return listed.select(
        series,
        F.date_add("order_date", after).alias("order_date"),
        F.when(after == 0, F.col("quantity")).otherwise(F.lit(0).cast("decimal(12,2)")).alias("quantity"),
        history("quantity_lag_1", 1, F.when(after == 0, F.col("__back_1")).when(after == 1, F.col("__amount"))),
        history("quantity_lag_7", 7, F.when(after >= 0, F.get("__lags_7", after))),
        history("quantity_rolling_7", 7, F.when(after >= 0, F.get("__sums", after)), 7.0),
    )


def _inside(daily: DataFrame, start: str, end: str) -> DataFrame:
    return daily.where(F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def sparse_lag_features(
    daily: DataFrame, start: str, end: str, series: str = "series"
) -> DataFrame:
    """`lag_features` of the dense grid, for its days in reach of a sale and without the grid.

    As in the dense grid, lags that would lie before the first day of the calendar are NULL. Rows of `daily` outside the
    calendar are left out. The rows grow with the sales, not with series times days.
    """
    return days_in_reach(_inside(daily, start, end), start, end, series)


def dense_features(
    daily: DataFrame, members: DataFrame, start: str, end: str, series: str = "series"
) -> DataFrame:
    """`build_features` of `complete_grid`: the same rows, every member on every day, without sorting the grid.

    A member's sales, or a zero on the first day for one that has none, fill all days of the calendar. Members that are
    listed several times have every day as often, and their history counts these rows; they take the grid itself.
    """
    counted = members.groupBy(series).agg(F.count(F.lit(1)).alias("__copies"))
    once = counted.where(F.col("__copies") == 1).select(series)
    zero = F.lit(0).cast("decimal(12,2)")
    sales = once.join(_inside(daily, start, end), series, "left").select(
        series,
        F.coalesce("order_date", F.lit(start).cast("date")).alias("order_date"),
        F.coalesce("quantity", zero).alias("quantity"),
    )
    filled = calendar_features(days_in_reach(sales, start, end, series, reach=None))
    filled = filled.withColumn("quantity", F.col("quantity").cast("double"))
    copies = counted.where(F.col("__copies") > 1).select(
        series, F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int"))).alias("__copy")
    )
    return filled.unionByName(build_features(complete_grid(daily, copies, start, end, series), series))


def sparse_features(daily: DataFrame, start: str, end: str, series: str = "series") -> DataFrame:
    """`build_features` for the days in reach of a sale; the quantity leaves as double."""
    lagged = sparse_lag_features(daily, start, end, series)
    return calendar_features(lagged).withColumn("quantity", F.col("quantity").cast("double"))


def densified(
    sparse: DataFrame, members: DataFrame, start: str, end: str, series: str = "series"
) -> DataFrame:
    """The rows that `build_features` has for every member on the days from `start` to `end`.

    `sparse` holds those in reach, complete ones; what is missing is zero. For a few days, such as test days, or for few
    series: the result is members times days.
    """
    # The few listed days of a member are gathered where they are, and the others filled in behind the join: neither the
    # days of all members nor those listed are shuffled.
    days = F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    row = F.struct("order_date", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in (TARGET, *HISTORY)])
    kept = sparse.where(days).groupBy(series).agg(F.collect_list(row).alias("__kept"))
    joined = members.select(series).join(kept, series, "left")
    listed = F.coalesce("__kept", F.array())
    others = F.array_except(calendar_days(start, end), F.transform(listed, lambda k: k["order_date"]))
    every = F.concat(listed, F.transform(others, _zeros))
    return calendar_features(joined.select(series, F.inline(every)))


def _zeros(day: Column) -> Column:
    return F.struct(day.alias("order_date"), *[F.lit(0.0).alias(c) for c in (TARGET, *HISTORY)])


def finalize_features(features: DataFrame) -> DataFrame:
    """Only rows with a complete history."""
    return features.dropna(subset=HISTORY)


def dropped_history(features: DataFrame) -> DataFrame:
    """(rows_before, rows_after, rows_dropped) of `finalize_features`, in one pass."""
    complete = F.lit(True)
    for column in HISTORY:
        complete = complete & F.col(column).isNotNull()
    return features.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count(F.when(complete, 1)).alias("rows_after")
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def finalized(features: DataFrame) -> DataFrame:
    """The rows of `finalize_features`, each with the counts of `dropped_history`; if none is left, the counts alone."""
    names = ["rows_before", "rows_after", "rows_dropped"]
    counts = dropped_history(features).select(F.struct(*names)).scalar()
    told = [counts[c].alias(c) for c in names]
    none_left = features.sparkSession.range(1).select(*told).where(F.col("rows_after") == 0)
    return finalize_features(features).select("*", *told).unionByName(none_left, allowMissingColumns=True)


def with_split(df: DataFrame, split_date: str) -> DataFrame:
    before = F.col("order_date") < F.lit(split_date).cast("date")
    return df.withColumn("split", F.when(before, "train").otherwise("test"))


def chronological_split(df: DataFrame, split_date: str = "2025-11-15") -> tuple[DataFrame, DataFrame]:
    """(train, test): rows before the date, and rows from it on."""
    day = F.lit(split_date).cast("date")
    return df.where(F.col("order_date") < day), df.where(F.col("order_date") >= day)


def leakage_checks(
    train: DataFrame,
    test: DataFrame,
    series: str = "series",
    features: Sequence[str] = FEATURES,
    tolerance: float = 0.001,
    sparse: bool = False,
) -> DataFrame:
    """(check_name, rows_checked, violations) for three ways the future can leak in.

    Date ranges that touch; a lag that is not the quantity of the day before (all
    series, by a join independent of the lag window); the target as a feature. In
    `sparse` frames a day that is not listed, but lies in the training days, has
    quantity zero.
    """
    first_test_day = test.agg(F.min("order_date")).scalar()
    # Of the columns at hand, those used as features: none may be the target or equal it in every row.
    used = [c for c in features if c in train.columns]
    copies = [F.every(F.col(c).eqNullSafe(F.col(TARGET))).cast("long") for c in used]
    none = F.lit(0).cast("long")
    whole = train.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.max("order_date").alias("last_day"),
        F.coalesce(sum(copies, F.lit(0)), F.lit(0)).cast("long").alias("copies"),
    )
    overlap = F.coalesce((F.col("last_day") >= first_test_day).cast("long"), none)
    of_whole = [("date_overlap", overlap), ("target_in_features", F.col("copies"))]
    rows_of_whole = whole.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("check_name"), "rows_checked", found.alias("violations"))
                    for name, found in of_whole
                ]
            )
        )
    )
    day_before = train.select(
        series, F.date_add("order_date", 1).alias("order_date"), F.col(TARGET).alias("actual")
    )
    actual, rows = F.col("actual"), train.select(series, "order_date", "quantity_lag_1")
    if sparse:
        # What is not found counts as zero, so zeros need not be looked up. The sales fit into a table per task.
        day_before = day_before.where(F.col("actual") != 0).hint("shuffle_hash")
        actual = F.coalesce(actual, F.lit(0.0))
    wrong = F.abs(F.col("quantity_lag_1") - actual) > F.lit(tolerance)
    counts = [F.count(F.lit(1)).alias("n"), F.count(F.when(wrong, 1)).alias("wrong")]
    joined = rows.join(day_before, [series, "order_date"], "left" if sparse else "inner")
    sums = [F.sum("n"), F.sum("wrong")]
    if sparse:
        # One row per day; the first has no day before it.
        lags = joined.where(F.col("order_date").isNotNull()).groupBy("order_date").agg(*counts)
        sums = [total - F.min_by(c, "order_date") for total, c in zip(sums, ("n", "wrong"))]
    else:
        lags = joined.agg(*counts)
    lags = lags.agg(*[F.coalesce(total, none).alias(c) for total, c in zip(sums, ("rows_checked", "violations"))])
    lags = lags.select(F.lit("lag_1_is_previous_day").alias("check_name"), "rows_checked", "violations")
    return rows_of_whole.unionByName(lags)


def one_hot(df: DataFrame, column: str, prefix: str, levels: Sequence) -> DataFrame:
    """One 0/1 column per level given, in that order. For reading; see `one_hot_long` for any number of levels."""
    flags = [
        F.coalesce((F.col(column) == F.lit(level)).cast("int"), F.lit(0)).alias(f"{prefix}_{level}")
        for level in levels
    ]
    return df.select("*", *flags)


def one_hot_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, level, flag): the ones of the encoding, a row each; what is not listed is zero."""
    return df.where(F.col(column).isNotNull()).select(
        key, F.col(column).alias("level"), F.lit(1).alias("flag")
    )
