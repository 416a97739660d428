"""One query per operator over the given parquet tables.

Dates leave as ISO text and nullable ids as text, so that both engines print them alike.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from storecast import schema
from storecast.functions import portable_hash
from storecast.operators import allocate, baskets, features, forecast, linear, models, quality, sampling
from storecast.plans import load, reports, restock, train
from storecast.session import scratch_path
from storecast.sources import files
from storecast.sources.retail import BASE_PERIOD, COMPARE_PERIOD, DESIGN_YEAR, RetailSource

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

STEP_DIGITS = 6
HORIZON = 7


def query(fn: Callable[[RetailSource], DataFrame]) -> Callable[[RetailSource], DataFrame]:
    """Register `fn` under its name as a (spark, folder) query."""
    REGISTRY[fn.__name__] = lambda spark, path: fn(RetailSource(spark, path))
    return fn


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# -- reports ---------------------------------------------------------------


@query
def total_orders(r):
    return files.run_query(
        r.spark, "SELECT count(*) AS total_orders FROM {orders}", orders=r.orders
    )


@query
def line_revenue(r):
    return as_double(
        reports.line_revenue(r.items), "quantity", "unit_price_at_order", "revenue"
    )


@query
def best_sellers(r):
    return reports.best_sellers(r.items, r.products)


@query
def category_performance(r):
    return reports.category_performance(r.items, r.products, r.categories)


@query
def revenue_trends(r):
    return reports.revenue_trends(r.items, r.orders)


@query
def trend_analysis(r):
    return reports.trend_analysis(r.items, r.orders, r.products, BASE_PERIOD, COMPARE_PERIOD)


@query
def low_stock_risk(r):
    return reports.low_stock_risk(r.items, r.orders, r.products, r.stock, r.calendar.recent)


@query
def low_stock_top5(r):
    return low_stock_risk(r).limit(5)


@query
def region_performance(r):
    return reports.region_performance(r.items, r.orders, r.customers)


@query
def top_customers(r):
    return reports.top_customers(r.items, r.orders, r.customers)


@query
def full_report(r):
    return reports.full_report(
        r.items,
        r.orders,
        r.products,
        r.categories,
        r.customers,
        r.stock,
        BASE_PERIOD,
        COMPARE_PERIOD,
        r.calendar.recent,
    )


@query
def revenue_reconciliation(r):
    return reports.revenue_reconciliation(r.items, r.orders, r.products, r.categories)


# -- sources, quality, load ------------------------------------------------


def _raw_orders(r):
    return r.raw_orders.select("order_id", "customer_id", "order_date")


@query
def table_info(r):
    return files.table_info(_raw_orders(r))


@query
def scan_csv(r):
    """Raw orders written as CSV, scanned with the declared schema."""
    path = scratch_path(r.spark, "scan_csv")
    files.write_csv(_raw_orders(r), path)
    return as_text(files.scan_csv(r.spark, path, schema.RAW_ORDERS), "customer_id")


@query
def csv_roundtrip(r):
    """Raw lines written as CSV and read back with types."""
    path = scratch_path(r.spark, "csv_roundtrip")
    files.write_csv(r.raw_items, path)
    return as_double(
        files.scan_csv(r.spark, path, schema.RAW_ORDER_ITEMS), "quantity", "unit_price_at_order"
    )


@query
def profile_orders(r):
    return quality.profile_orders(_raw_orders(r))


@query
def profile_order_items(r):
    return quality.profile_order_items(r.raw_items, r.product_lookup)


@query
def profile_summary(r):
    return quality.profile_summary(_raw_orders(r), r.raw_items, r.product_lookup)


@query
def clean_customer_ids(r):
    return quality.fill_missing_customers(r.raw_orders)


@query
def dedup_orders(r):
    return as_text(quality.dedup_orders(r.raw_orders), "customer_id")


@query
def dedup_order_items(r):
    first = quality.dedup_order_items(r.raw_lines).drop("pos")
    return as_double(first, "quantity", "unit_price_at_order")


@query
def fix_dates(r):
    return as_text(quality.fix_dates(r.raw_orders), "order_date", "customer_id")


@query
def price_sanity(r):
    return as_double(
        quality.price_sanity(r.raw_items, r.product_lookup),
        "quantity",
        "unit_price_at_order",
        "expected_price",
    )


@query
def validate_cleaned(r):
    return quality.validate_cleaned(
        load.clean_orders(r.raw_orders),
        quality.dedup_order_items(r.raw_lines).drop("pos"),
        r.product_lookup,
    )


@query
def orphan_items(r):
    return quality.count_orphans(r.raw_items, r.orders, "order_id")


@query
def orphan_products(r):
    return quality.count_orphans(r.raw_items, r.product_lookup, "product_name")


@query
def fk_quarantine(r):
    """Every line with the reason it is rejected for, if any; one pass serves both sides."""
    flagged = quality.flag_references(
        r.raw_items,
        {"order_id": (r.orders, "order_id"), "product_name": (r.product_lookup, "product_name")},
        unique=True,
    )
    return as_double(flagged, "quantity", "unit_price_at_order").fillna("", "reject_reason")


@query
def constraint_report(r):
    return quality.constraint_report(
        {
            "customers": r.customers,
            "orders": load.clean_orders(r.raw_orders),
            "order_items": load.clean_order_items(r.raw_lines, r.product_lookup),
        }
    )


@query
def resolve_product_ids(r):
    resolved = load.resolve_product_ids(r.raw_items, r.product_lookup)
    return as_text(as_double(resolved, "quantity", "unit_price_at_order"), "product_id")


@query
def customers_with_sentinel(r):
    return r.customers


def _catalog(r):
    return r.products.withColumnRenamed("category_id", "category")


@query
def products_enriched(r):
    enriched = load.products_enriched(_catalog(r), r.raw_categories, r.raw_suppliers)
    return as_text(as_double(enriched, "unit_price"), "supplier_id")


@query
def clean_orders(r):
    return as_text(load.clean_orders(r.raw_orders), "order_date")


@query
def clean_order_items(r):
    cleaned = load.clean_order_items(r.raw_lines, r.product_lookup)
    return as_text(as_double(cleaned, "quantity", "unit_price_at_order"), "product_id")


@query
def load_retail(r):
    """Clean and load the seven tables: every row written, as text, and why it was rejected, if so."""
    catalog = r.product_lookup.join(_catalog(r).select("product_id", "category"), "product_id")
    restocked = F.lit(str(r.calendar.end)).cast("date")
    path = load.load_retail(
        r.spark,
        scratch_path(r.spark, "load_retail"),
        {
            "categories": r.raw_categories,
            "suppliers": r.raw_suppliers.withColumn("contact_info", F.lit("none")),
            "customers": r.named_customers,
            "products": catalog,
            "inventory": r.stock.withColumn("last_restocked_date", restocked),
            "orders": r.raw_orders,
            "order_items": r.raw_lines,
        },
    )
    out = None
    for name, rule in schema.RULES.items():
        for side in ("accepted", "rejected"):
            df = load.loaded_table(r.spark, path, name, side)
            reason = F.col("reject_reason") if side == "rejected" else F.lit("")
            columns = sorted(c for c in df.columns if c != "reject_reason")
            cells = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
            rows = df.select(
                F.lit(name).alias("table_name"),
                F.col(rule.key).cast("string").alias("row_key"),
                F.concat_ws("|", *cells).alias("content"),
                reason.alias("reject_reason"),
            )
            out = rows if out is None else out.unionAll(rows)
    return out


@query
def scan_text_csv(r):
    """Raw lines written as CSV and scanned with every column as text."""
    path = scratch_path(r.spark, "scan_text_csv")
    files.write_csv(r.raw_items, path)
    return files.scan_csv(r.spark, path)


# A short list of months, as a user would type it.
QUARTERS = [(m, (m - 1) // 3 + 1) for m in range(1, 13)]


@query
def literal_rows(r):
    """A literal list joined to the orders: orders per quarter."""
    months = files.rows_to_frame(
        r.spark,
        [{"month": m, "quarter": q} for m, q in QUARTERS],
        StructType([StructField("month", IntegerType()), StructField("quarter", IntegerType())]),
    )
    dated = r.orders.select(F.month("order_date").alias("month"))
    # Twelve rows go to every task: twelve keys would make twelve tasks of all orders.
    return dated.join(F.broadcast(months), "month").groupBy("quarter").agg(F.count(F.lit(1)).alias("orders"))


@query
def append_orders(r):
    """Orders appended to a table in two parts, read back per customer."""
    name = f"orders_{uuid.uuid4().hex}"
    early = F.col("order_id") % 2 == 0
    for part in (r.orders.where(early), r.orders.where(~early)):
        files.append_table(part, name)
    return r.spark.table(name).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.max("order_date").cast("string").alias("last_order")
    )


@query
def append_batch_twice(r):
    """Orders appended in two batches, one of them sent twice, the first time with other rows; read back by batch."""
    path = scratch_path(r.spark, "batches")
    early = F.col("order_id") % 2 == 0
    columns = r.orders.select("order_id", "customer_id", "order_date")
    files.append_batch(columns.where(~early).limit(10), path, "odd")
    files.append_batch(columns.where(early), path, "even")
    files.append_batch(columns.where(~early), path, "odd")
    back = files.read_batches(r.spark, path, columns.schema)
    return back.groupBy("batch").agg(
        F.count(F.lit(1)).alias("orders"),
        F.countDistinct("order_id").alias("different"),
        F.max("order_date").cast("string").alias("last_order"),
    )


@query
def incremental_dedup(r):
    """Raw orders in two batches: copies of the second are looked up among the keys of the first."""
    known = f"known_{uuid.uuid4().hex}"
    late = (F.col("order_id") % 3 == 0) | (F.col("pos") != F.col("order_id"))
    first = quality.first_copies(r.raw_orders.where(~late), known, "order_id", ["pos"], 16)
    second = quality.first_copies(r.raw_orders.where(late), known, "order_id", ["pos"], 16)
    both = first.withColumn("batch", F.lit(1)).unionByName(second.withColumn("batch", F.lit(2)))
    return as_text(both, "customer_id")


@query
def copied_rows(r):
    """Full-row copies among the raw orders, and among the lines as they were exported."""
    orders = quality.copied_rows(_raw_orders(r)).select(F.lit("orders").alias("table_name"), "duplicate_rows")
    lines = quality.copied_rows(r.raw_items)
    return orders.unionAll(lines.select(F.lit("order_items"), "duplicate_rows"))


@query
def date_range(r):
    """First and last day and number of orders, from the footers of a written table."""
    path = scratch_path(r.spark, "dated")
    r.orders.select("order_id", "order_date").write.parquet(path)
    found = files.footer_aggregate(r.spark, path, "order_date")
    return found.select(
        F.col("least").cast("string").alias("first_day"), F.col("greatest").cast("string").alias("last_day"), "n"
    )


# -- features --------------------------------------------------------------


def _series_items(r):
    return r.items.join(r.products.select("product_id", "series"), "product_id")


def _grid(r):
    """All days per brand, the series that models are fitted on."""
    return train.demand_grid(
        _series_items(r), r.orders, r.series, *map(str, r.calendar[:2]), "series"
    )


def _features(r):
    return features.finalize_features(features.build_features(_grid(r)))


def _product_features(r, days: int | None = None):
    """All days per product, or the last `days` days: sales before them cannot matter to a state of a week."""
    first, last = r.calendar
    first = first if days is None else max(first, last - dt.timedelta(days=days - 1))
    return train.demand_features(
        r.items, r.orders, r.products.select("product_id"), str(first), str(last), "product_id"
    )


def _daily(r):
    return features.sales_by_series(r.items, r.orders)


def _sparse_lags(r):
    return features.sparse_lag_features(_daily(r), *map(str, r.calendar[:2]), "product_id")


def _sparse_features(r):
    return features.sparse_features(_daily(r), *map(str, r.calendar[:2]), "product_id")


def _whole_features(r):
    """Features of every product on every day."""
    members = r.products.select("product_id")
    return features.dense_features(_daily(r), members, *map(str, r.calendar[:2]), "product_id")


def _named(r, df):
    return restock.with_names(df, r.products, "product_id")


@query
def daily_sales(r):
    daily = features.daily_sales(r.items, r.orders)
    return as_text(as_double(daily, "quantity"), "order_date")


@query
def complete_grid(r):
    return as_text(as_double(_grid(r), "quantity"), "order_date")


@query
def calendar_features(r):
    dated = r.orders.select("order_id", "order_date")
    return as_text(features.calendar_features(dated), "order_date")


@query
def lag_features(r):
    """Of every product, on the days that a sale can matter to."""
    lagged = _sparse_lags(r).drop("quantity_rolling_7")
    return as_text(as_double(lagged, "quantity"), "order_date")


@query
def rolling_features(r):
    rolled = _sparse_lags(r).drop("quantity_lag_1", "quantity_lag_7")
    return as_text(as_double(rolled, "quantity"), "order_date")


@query
def build_features(r):
    return as_text(_whole_features(r), "order_date")


@query
def dense_features(r):
    """Features of every brand on every day."""
    return as_text(features.build_features(_grid(r)), "order_date")


@query
def finalize_features(r):
    """The rows with a whole history, of every product and day, and how many there were before and are left."""
    return as_text(features.finalized(_whole_features(r)), "order_date")


@query
def chronological_split(r):
    ready = features.finalize_features(_whole_features(r))
    labelled = features.with_split(ready, r.calendar.split)
    return as_text(labelled.select("product_id", "order_date", "quantity", "split"), "order_date")


@query
def leakage_checks(r):
    ready = features.finalize_features(_sparse_features(r))
    parts = features.chronological_split(ready, r.calendar.split)
    return features.leakage_checks(*parts, "product_id", sparse=True)


@query
def product_grid(r):
    """The dense rows of every product over the test days, filled in from the days in reach of a sale."""
    split, last = r.calendar.split, str(r.calendar.end)
    near = features.chronological_split(features.finalize_features(_sparse_features(r)), split)[1]
    dense = features.densified(near, r.products.select("product_id"), split, last, "product_id")
    return as_text(dense, "order_date")


@query
def product_features(r):
    """Lag features of every product over every day, summed per product."""
    found = _product_features(r)
    return found.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("quantity").alias("quantity"),
        F.sum("quantity_lag_1").alias("lag_1"),
        F.sum("quantity_lag_7").alias("lag_7"),
        F.round(F.sum("quantity_rolling_7"), 6).alias("rolling_7"),
        F.sum("is_weekend").alias("weekend_days"),
    )


@query
def one_hot_products(r):
    """One flag per product and brand: the long form, whatever the number of levels."""
    return features.one_hot_long(r.products.select("product_id", "series"), "product_id", "series")


# -- metrics ---------------------------------------------------------------


def _split(r):
    return features.chronological_split(_features(r), r.calendar.split)


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({c: F.round(c, 6) for c in ("mae", "mse", "rmse", "r2")})


@query
def mean_baseline(r):
    train_rows, test_rows = _split(r)
    return _rounded(
        models.regression_metrics(models.mean_baseline(train_rows, test_rows), "mean_baseline")
    )


@query
def naive_lag_baseline(r):
    _, test_rows = _split(r)
    return _rounded(
        models.regression_metrics(models.naive_lag_baseline(test_rows), "naive_lag_baseline")
    )


@query
def regression_metrics(r):
    _, test_rows = _split(r)
    scored = test_rows.withColumn("prediction", F.col("quantity_rolling_7"))
    return _rounded(models.regression_metrics(scored, "rolling_mean"))


# -- forecast and restocking -----------------------------------------------


# Two weeks hold the last seven days and the seven before each of them.
STATE_DAYS = 14


@query
def recent_state(r):
    state = forecast.recent_state(_product_features(r, STATE_DAYS), "product_id")
    return state.select(
        "product_id",
        F.size("recent").alias("kept"),
        *[F.element_at("recent", i).alias(f"q{i}") for i in range(1, 8)],
    )


@query
def forecast_7d_rolling(r):
    """The value fed back is rounded to six digits here, so that SQL can follow it."""
    ahead = forecast.forecast(
        _product_features(r, STATE_DAYS),
        forecast.rolling_mean_predictor,
        HORIZON,
        "product_id",
        STEP_DIGITS,
    )
    return as_text(_named(r, ahead), "order_date")


def _points(r):
    return restock.reorder_points(
        _product_features(r, STATE_DAYS),
        forecast.rolling_mean_predictor,
        series="product_id",
        step_digits=STEP_DIGITS,
    )


def _triggers(r):
    stock = restock.current_stock(r.shelf_stock, "product_id")
    return restock.reorder_triggers(_points(r), stock, "product_id")


@query
def reorder_points(r):
    return _points(r)


@query
def reorder_triggers(r):
    return _triggers(r)


@query
def order_quantities(r):
    return restock.order_quantities(_triggers(r))


# A product is erratic here when it sells on fewer than one day in eighty.
ERRATIC_SHARE = 0.9875


def _erratic(r):
    first, last = r.calendar
    daily = features.daily_sales(r.items, r.orders)
    return restock.erratic_from_daily(
        daily, r.products, (last - first).days + 1, ERRATIC_SHARE, "product_id"
    )


@query
def erratic_flag(r):
    return _erratic(r)


@query
def inventory_report(r):
    report = restock.inventory_report(
        _product_features(r, STATE_DAYS),
        forecast.rolling_mean_predictor,
        restock.current_stock(r.shelf_stock, "product_id"),
        _erratic(r),
        series="product_id",
        step_digits=STEP_DIGITS,
    )
    return _named(r, report)


@query
def inventory_sanity(r):
    return restock.inventory_sanity(restock.order_quantities(_triggers(r)))


# -- demand design, allocation, baskets, samples -----------------------------


def _parameters(r):
    """Demand parameters per series, derived from its parts."""
    number = F.col("parts") % 7
    seasonal = F.when(number < 3, F.array(F.lit(10), F.lit(11))).otherwise(
        F.array().cast("array<int>")
    )
    return (
        r.scan("part")
        .groupBy(F.col("p_brand").alias("series"))
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("p_size").alias("size"))
        .select(
            "series",
            (F.col("size").cast("double") / 100.0).alias("base_demand"),
            ((number - 3).cast("double") / 10.0).alias("trend"),
            seasonal.alias("seasonal_months"),
            F.lit(3.5).alias("seasonal_multiplier"),
            F.lit(0.9).alias("noise_low"),
            F.lit(1.1).alias("noise_high"),
            ((F.col("parts") % 5).cast("double") / 20.0).alias("zero_order_prob"),
        )
    )


def _expected(r):
    return allocate.expected_demand(_parameters(r), *DESIGN_YEAR)


@query
def expected_demand(r):
    rounded = _expected(r).withColumn(
        "expected_quantity", F.round(F.col("expected_quantity"), 6)
    )
    return as_text(rounded, "order_date")


@query
def trend_ground_truth(r):
    return allocate.trend_ground_truth(_expected(r), _grid(r), BASE_PERIOD, COMPARE_PERIOD)


def _allocation(r, mode: str) -> tuple[DataFrame, DataFrame]:
    """Order totals over the products of the order, by quantity; every 97th total is invalid."""
    totals = r.scan("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(0))
        .otherwise(F.col("o_totalprice"))
        .cast(schema.MONEY)
        .alias("total"),
    )
    parts = r.items.groupBy("order_id", "product_id").agg(
        F.sum("quantity").cast(schema.MONEY).alias("weight")
    )
    return allocate.proportional_allocation(totals, parts, ["order_id"], "product_id", mode)


@query
def proportional_allocation(r):
    return as_double(_allocation(r, "last")[0], "weight", "allocated")


@query
def proportional_allocation_remainder(r):
    return as_double(_allocation(r, "largest_remainder")[0], "weight", "allocated")


@query
def allocation_rejects(r):
    return as_double(_allocation(r, "last")[1], "total")


PORTION_ORDER = ["order_id", "line_no", "quantity", "unit_price_at_order"]


def _baskets(r):
    """Baskets of products, per day."""
    portions = r.items.join(r.orders.select("order_id", "order_date"), "order_id")
    return baskets.assemble_baskets(portions, ["order_date"], "product_id", PORTION_ORDER)


@query
def assemble_baskets(r):
    packed = _baskets(r).select(
        "order_date", "product_id", *PORTION_ORDER, "basket_no", "basket_line"
    )
    return as_text(as_double(packed, "quantity", "unit_price_at_order"), "order_date")


@query
def flatten_orders(r):
    nested = baskets.nest_orders(_baskets(r), ["order_date"], ["product_id", "quantity"])
    _, lines = baskets.flatten_orders(nested, ["order_date"])
    return as_double(lines, "quantity")


SAMPLE_FRACTION = 0.03


@query
def exact_sample(r):
    key = F.col("order_id")
    sampled = sampling.exact_sample(r.orders, SAMPLE_FRACTION, "order_id", portable_hash(key))
    return as_text(sampled, "order_date")


@query
def append_copies(r):
    key = F.col("order_id")
    copied = sampling.append_copies(r.orders, 0.02, "order_id", portable_hash(key))
    return copied.groupBy("order_id").agg(F.count(F.lit(1)).alias("copies"))


# -- models ----------------------------------------------------------------


def _model_frame(r):
    return train.training_frame(_features(r))


def _model_split(r):
    return features.chronological_split(_model_frame(r), r.calendar.split)


def _checked(r, name, regressor, *columns):
    train_rows, test_rows = _model_split(r)
    model = models.fit_model(train_rows, regressor)
    checks = models.model_checks(model.transform(train_rows), model.transform(test_rows), name)
    return checks.select("model", "rows", "finite", "beats_mean", *columns)


def _linear(r):
    """Least squares over every product and training day, with an intercept per product."""
    first, split = r.calendar.start + dt.timedelta(days=features.REACH), r.calendar.split
    before = str(dt.date.fromisoformat(split) - dt.timedelta(days=1))
    sparse = features.finalize_features(_sparse_features(r))
    train_rows, test_rows = features.chronological_split(sparse, split)
    members = r.products.select("product_id")
    fit = linear.fit_within_sparse(train_rows, members, str(first), before, "product_id")
    return fit, features.densified(test_rows, members, split, str(r.calendar.end), "product_id")


@query
def linear_regression(r):
    """Errors on the test days of every product."""
    fit, test_rows = _linear(r)
    return _rounded(models.regression_metrics(fit.scored(test_rows), "linear_regression"))


@query
def linear_coefficients(r):
    return _linear(r)[0].table().withColumn("coefficient", F.round("coefficient", 6))


@query
def linear_effects(r):
    """The intercept of every product."""
    return _linear(r)[0].effects.select("product_id", F.round("effect", 6).alias("effect"))


@query
def forecast_linear(r):
    """A week ahead of every product by the linear fit; the value fed back is rounded as in `forecast_7d_rolling`."""
    fit, _ = _linear(r)
    ahead = forecast.forecast_with_columns(
        _product_features(r, STATE_DAYS), fit, HORIZON, "product_id", STEP_DIGITS, fit.effects
    )
    return as_text(ahead, "order_date")


@query
def random_forest(r):
    forest = models.random_forest(max_depth=6, min_leaf=5)
    return _checked(r, "random_forest_best", forest, "within_labels")


@query
def gradient_boosting(r):
    return _checked(r, "gradient_boosting_default", models.gradient_boosting())


@query
def random_forest_metrics(r):
    """Errors of the tuned forest on the test days."""
    train_rows, test_rows = _model_split(r)
    forest = models.fit_model(train_rows, models.random_forest(max_depth=6, min_leaf=5))
    return _rounded(models.regression_metrics(forest.transform(test_rows), "random_forest_best"))


@query
def gradient_boosting_metrics(r):
    train_rows, test_rows = _model_split(r)
    boosted = models.fit_model(train_rows, models.gradient_boosting())
    return _rounded(models.regression_metrics(boosted.transform(test_rows), "gradient_boosting_default"))


@query
def model_comparison(r):
    """Both baselines with their exact errors on the test days; every fitted model with whether it beats the mean.

    That is asked of the training days, where it must hold; on test days of nearly random sales it need not.
    """
    rows, split = _model_frame(r), r.calendar.split
    parts = features.chronological_split(rows, split)
    table, fitted = models.compare_models(*parts, models.default_regressors())
    exact = table.where(F.col("model").isin("mean_baseline", "naive_lag_baseline"))
    none = F.lit(None)
    out = exact.select(
        "model", "rows", *[F.round(c, 6).alias(c) for c in ("mae", "rmse")], none.cast("boolean").alias("beats_mean")
    )
    for name, model in fitted.items():
        checks = models.comparison_checks(model.transform(rows), split, name)
        out = out.unionAll(
            checks.select("model", "rows", none.cast("double"), none.cast("double"), F.col("beats_mean") & F.col("finite"))
        )
    return out


def _forest(r):
    train_rows, test_rows = _model_split(r)
    forest = models.default_regressors()["random_forest_best"]
    return models.fit_model(train_rows, forest), train_rows, test_rows


@query
def feature_importance(r):
    """All features, none negative, and their sum."""
    found = models.feature_importance(_forest(r)[0], r.spark, top=None)
    listed = found.select("feature", (F.col("importance") >= 0).alias("valid"))
    total = found.agg(F.round(F.sum("importance"), 6).alias("s"))
    return listed.unionAll(total.select(F.lit("sum"), F.col("s") == 1.0))


@query
def model_roundtrip(r):
    """Predictions of a model before saving and after loading, side by side."""
    model, _, test_rows = _forest(r)
    path = scratch_path(r.spark, "model")
    models.save_model(model, path)
    loaded = models.load_model(path)
    before = model.transform(test_rows).select("series", "order_date", "prediction")
    after = loaded.transform(test_rows).select(
        "series", "order_date", F.col("prediction").alias("again")
    )
    return before.join(after, ["series", "order_date"]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.abs(F.col("prediction") - F.col("again"))).alias("largest_difference"),
    )


@query
def forecast_7d(r):
    """A forest's forecast: days and series exactly, predictions inside the range of the training labels."""
    model, train_rows, _ = _forest(r)
    low, high = train_rows.agg(F.min("quantity"), F.max("quantity")).first()
    recent = _features(r).where(F.col("order_date") > F.lit(str(r.calendar.end - dt.timedelta(days=7))).cast("date"))
    ahead = forecast.forecast(recent, model, HORIZON)
    inside = F.col("prediction").between(low - 1e-6, high + 1e-6)
    return as_text(ahead.select("series", "order_date", "horizon", inside.alias("in_range")), "order_date")
