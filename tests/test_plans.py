"""Shape of the physical plans: pushdown, pruning, no hidden single-task steps, skew."""

import re

import pytest
from pyspark.sql import functions as F

from checks.queries import REGISTRY
from storecast.operators import allocate, features, forecast, ranking
from storecast.plans import reports
from storecast.sources.retail import BASE_PERIOD, COMPARE_PERIOD
from tests.conftest import SMALL

# Retail queries whose plan has a Python worker.
WITH_PYTHON: set[str] = set()
# Fitting a model or writing files when called; their plans are checked elsewhere.
EAGER = {
    "linear_regression",
    "random_forest",
    "gradient_boosting",
    "model_comparison",
    "feature_importance",
    "model_roundtrip",
    "forecast_7d",
    "load_retail",
    "scan_csv",
    "csv_roundtrip",
    "scan_text_csv",
    "append_orders",
    "append_batch_twice",
    "incremental_dedup",
    "random_forest_metrics",
    "gradient_boosting_metrics",
}
# Ranks reports that are short by nature, and counts per task: windows over a few rows.
SHORT_WINDOWS = {"full_report"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_single_task_steps(spark, name):
    plan = plan_of(REGISTRY[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in WITH_PYTHON:
        assert not re.search(r"Python|MapInArrow|MapInPandas|FlatMapGroups", plan)
    # One partition only for results of a few rows: each such exchange must bring partial aggregates or limited rows.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and name not in SHORT_WINDOWS:
            below = " ".join(lines[i + 1 : i + 3])
            assert re.search(r"partial_|keys=\[\]|Limit", below), below


def test_windows_are_partitioned(spark):
    """An unpartitioned window would sort its whole input in one task."""
    for name in sorted(set(REGISTRY) - EAGER - SHORT_WINDOWS):
        logical = REGISTRY[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        for line in logical.splitlines():
            if re.match(r"^[\s:+-]*Window \[", line):
                # Window [functions], [partition], [order]: an order alone shows ASC or DESC.
                specs = re.findall(r"\], \[([^\[\]]*)\]", line)
                assert specs and not re.search(r"#\d+L? (ASC|DESC)", specs[0]), line


def test_dates_are_pushed_to_the_scan(retail):
    plan = plan_of(
        reports.low_stock_risk(
            retail.items, retail.orders, retail.products, retail.stock, ("1997-12-01", "1998-01-01")
        )
    )
    # On the stored timestamp, without a cast, so that row groups can be skipped.
    assert re.search(r"DataFilters: \[.*\(o_orderdate#\d+ >= 1997-12-01 00:00:00\)", plan)
    assert re.search(r"\(o_orderdate#\d+ < 1998-01-01 00:00:00\)", plan)
    assert "GreaterThanOrEqual(o_orderdate,1997-12-01" in plan


def test_scans_read_only_what_is_used(retail):
    plan = plan_of(reports.best_sellers(retail.items, retail.products))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_lags_share_one_sort(retail):
    grid = features.complete_grid(
        retail.items.join(retail.products, "product_id")
        .join(retail.orders, "order_id")
        .groupBy("series", "order_date")
        .agg(F.sum("quantity").alias("quantity")),
        retail.series,
        "1997-01-01",
        "1997-12-31",
    )
    plan = plan_of(features.lag_features(grid))
    assert len(re.findall(r"\+- Window \[|: +Window \[|^Window \[", plan)) == 1


def test_customer_totals_aggregate_before_the_customer_join(retail):
    plan = plan_of(reports.top_customers(retail.items, retail.orders, retail.customers))
    assert "TakeOrderedAndProject" in plan
    # Lines are shuffled as one partial sum per order, not row by row.
    assert re.search(r"Exchange hashpartitioning\(order_id.*\n.*HashAggregate\(keys=\[order_id", plan)


def test_last_week_is_cut_before_the_shuffle(spark):
    history = spark.read.parquet(f"{SMALL}/events.parquet").select(
        F.col("event_type").alias("series"),
        F.col("ts").cast("date").alias("order_date"),
        F.col("value").alias("quantity"),
    )
    plan = plan_of(forecast.recent_state(history))
    assert re.search(r"Exchange hashpartitioning\(series.*\n.*WindowGroupLimit .*Partial", plan)


def hot_items(spark):
    """60,000 lines; a third of them belong to order 1."""
    hot = F.col("id") % 3 == 0
    scattered = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    return spark.range(0, 60_000, 1, 12).select(
        F.when(hot, 1).otherwise(F.col("id") % 2000).cast("bigint").alias("order_id"),
        (scattered % 5000).alias("product_id"),
        (scattered / 100).cast("decimal(12,2)").alias("quantity"),
        F.lit("2.00").cast("decimal(12,2)").alias("unit_price_at_order"),
    )


def orders_of(spark):
    return spark.range(2000).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 100).alias("customer_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("order_date"),
    )


def test_hot_order_is_split(spark, shuffled):
    items = hot_items(spark)
    daily = features.daily_sales(items, orders_of(spark))
    sold = sum(r.quantity for r in daily.collect())
    assert sold == items.agg(F.sum("quantity")).first()[0]
    assert "skew=true" in plan_of(daily)


def test_hot_order_is_split_where_sales_are_dealt_out(spark, shuffled):
    items = hot_items(spark)
    daily = features.sales_by_series(items, orders_of(spark))
    sold = sum(r.quantity for r in daily.collect())
    assert sold == items.agg(F.sum("quantity")).first()[0]
    assert "skew=true" in plan_of(daily)


def test_hot_order_reaches_the_join_as_one_row(spark, shuffled):
    per_order = reports.order_sales(hot_items(spark), orders_of(spark))
    rows = per_order.collect()
    assert len(rows) == 2000
    assert "skew=true" not in plan_of(per_order)


@pytest.mark.parametrize("mode", ["last", "largest_remainder"])
@pytest.mark.parametrize("spread", [1, 65536])
def test_hot_group_allocation_adds_up(spark, shuffled, mode, spread):
    """Dense keys and sparse ones, all of equal weight, so that all remainders are equal."""
    parts = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(2).alias("g"),
        (F.col("id") * spread).alias("k"),
        F.lit("1.00").cast("decimal(12,2)").alias("weight"),
    )
    totals = spark.createDataFrame([(1, 1000), (2, 1000)], "g int, total int").select(
        "g", F.col("total").cast("decimal(12,2)").alias("total")
    )
    allocated, _ = allocate.proportional_allocation(totals, parts, ["g"], "k", mode)
    assert allocated.count() == 60_000
    sums = {r.g: float(r[1]) for r in allocated.groupBy("g").agg(F.sum("allocated")).collect()}
    assert sums == {1: 1000.0, 2: 1000.0}


@pytest.mark.parametrize("step", [1, 64, 65536])
def test_blocks_hold_many_keys_and_are_many(spark, step):
    keys = spark.range(300_000).select((F.col("id") * step).alias("k"))
    bits = ranking.block_bits(keys, "k")
    blocks = keys.groupBy(ranking.key_block("k", bits=bits).alias("b")).count().collect()
    assert 2 <= len(blocks) <= 8 and max(r["count"] for r in blocks) <= 2 * 65536



def test_text_keys_with_one_prefix_fall_into_many_blocks(spark):
    """`ORD-000001` and so on: the first characters alone would make one block of all."""
    keys = spark.range(200_000).select(F.format_string("ORD-%06d", "id").alias("k"))
    width = ranking.block_bits(keys, "k")
    blocks = keys.groupBy(ranking.key_block("k", "string", width).alias("b")).count().collect()
    assert len(blocks) >= 4 and max(r["count"] for r in blocks) <= 1 << ranking.BLOCK_BITS
    assert ranking.block_bits(keys.limit(0), "k") == ranking.BLOCK_CHARACTERS
    one = spark.createDataFrame([("same",), ("same",), (None,)], "k string")
    assert one.groupBy(ranking.key_block("k", "string", ranking.block_bits(one, "k"))).count().count() == 2

def test_lines_per_order_are_shuffled_once(retail, shuffled):
    """Aggregate, join and distinct count share one partitioning of the lines."""
    plan = plan_of(reports.revenue_trends(retail.items, retail.orders))
    assert "SortMergeJoin" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", plan)) == 2
    by_region = plan_of(
        reports.region_performance(retail.items, retail.orders, retail.customers)
    )
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", by_region)) == 2


def test_full_report_reads_lines_once(spark, retail):
    """One scan and one join of the lines; the report itself reads stored sums only."""
    args = (BASE_PERIOD, COMPARE_PERIOD, retail.calendar.recent)
    sums = plan_of(reports.report_sums(retail.items, retail.orders, *args))
    assert sums.count("lineitem.parquet") == 1 and sums.count("Expand") == 1
    report = reports.full_report(
        retail.items, retail.orders, retail.products, retail.categories, retail.customers, retail.stock, *args
    )
    assert "lineitem" not in plan_of(report) and "orders.parquet" not in plan_of(report)


def test_literal_rows_go_to_every_task(spark):
    """Twelve months as a key would deal all orders out to twelve tasks."""
    from checks.queries import REGISTRY

    plan = plan_of(REGISTRY["literal_rows"](spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning(month" not in plan
