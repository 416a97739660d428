"""Sales and stock reports.

Lines are aggregated on their own key before any join, so that the joins see at
most one row per order or product whatever the number of lines behind a key.
Revenue is summed in exact decimals and becomes a double only in the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.functions import pct_change, round_half_even
from storecast.operators.ranking import numbered
from storecast.schema import UNKNOWN_CUSTOMER
from storecast.session import scratch_path


def revenue_of_line() -> Column:
    return F.col("quantity") * F.col("unit_price_at_order")


def _double(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast("double").alias(alias or name)


def line_revenue(items: DataFrame) -> DataFrame:
    """Every line with quantity x price at order time."""
    return items.select("*", revenue_of_line().alias("revenue"))


def product_sales(items: DataFrame) -> DataFrame:
    """Exact quantity and revenue per product."""
    return items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum(revenue_of_line()).alias("total_revenue"),
    )


def order_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order with lines: its customer, date and exact revenue.

    The aggregate leaves lines partitioned on the order id, which the join reuses.
    """
    revenue = items.groupBy("order_id").agg(F.sum(revenue_of_line()).alias("revenue"))
    return revenue.join(orders, "order_id")


def _best_sellers(sales: DataFrame, products: DataFrame) -> DataFrame:
    return sales.join(products.select("product_id", "product_name"), "product_id").select(
        "product_id", "product_name", _double("total_quantity_sold"), _double("total_revenue")
    )


def best_sellers(items: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and revenue per product, highest revenue first."""
    return _best_sellers(product_sales(items), products).orderBy(
        F.desc("total_revenue"), "product_id"
    )


def _category_performance(
    sales: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    return (
        sales.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("category_id")
        .agg(
            F.sum("total_quantity_sold").alias("total_quantity_sold"),
            F.sum("total_revenue").alias("total_revenue"),
        )
        .join(categories, "category_id")
        .select(
            "category_id",
            "category_name",
            _double("total_quantity_sold"),
            _double("total_revenue"),
        )
    )


def category_performance(
    items: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Quantity and revenue per category, highest revenue first."""
    return _category_performance(product_sales(items), products, categories).orderBy(
        F.desc("total_revenue"), "category_id"
    )


def _monthly(per_order: DataFrame) -> DataFrame:
    return (
        per_order.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.countDistinct("order_id").alias("total_orders"),
        )
        .select("month", _double("total_revenue"), "total_orders")
    )


def revenue_trends(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue and distinct orders per calendar month."""
    return _monthly(order_sales(items, orders)).orderBy("month")


def _within(start: str | None, end: str | None) -> Column:
    """start <= order_date < end; None leaves a side open."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("order_date") >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (F.col("order_date") < F.lit(end).cast("date"))
    return inside


def _period_quantity(period: tuple[str | None, str | None]) -> Column:
    zero = F.lit(0).cast("decimal(12,2)")
    return F.sum(F.when(_within(*period), F.col("quantity")).otherwise(zero))


def trend_analysis(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    base: tuple[str | None, str | None] = (None, "2025-04-01"),
    compare: tuple[str | None, str | None] = ("2025-10-01", None),
) -> DataFrame:
    """Quantity per product in two periods and the change in percent, rises first.

    The defaults fit a one-year calendar; give both ends of both periods otherwise.
    Lines outside both periods only tell which products were ever sold with a known order:
    such a product shows zeros and no change. Orders of the two periods are filtered at the
    scan, so the wide part of the lines meets two quarters, not all years.
    """
    inside = orders.where(_within(*base) | _within(*compare)).select("order_id", "order_date")
    zero = F.lit(0).cast("decimal(12,2)")
    sold = (
        items.select("order_id", "product_id", "quantity")
        .join(inside, "order_id")
        .groupBy("product_id")
        .agg(
            _period_quantity(base).alias("q1"),
            _period_quantity(compare).alias("q4"),
        )
    )
    pairs = items.select("product_id", "order_id")
    ever = pairs.join(orders.select("order_id"), "order_id", "left_semi").select("product_id").distinct()
    return (
        ever.join(products.select("product_id", "product_name"), "product_id")
        .join(sold, "product_id", "left")
        .withColumns({"q1_quantity": F.coalesce("q1", zero), "q4_quantity": F.coalesce("q4", zero)})
        .select(
            "product_id",
            "product_name",
            _double("q1_quantity"),
            _double("q4_quantity"),
            pct_change(F.col("q1_quantity"), F.col("q4_quantity")).alias("pct_change"),
        )
        .orderBy(F.col("pct_change").desc_nulls_last(), "product_id")
    )


def low_stock_risk(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    stock: DataFrame,
    recent: tuple[str | None, str | None] = ("2025-12-01", None),
    divisor: int = 30,
) -> DataFrame:
    """Days of stock left at the recent daily demand, fewest first.

    Only products sold in the period appear. `divisor` is the day count the
    period's quantity is spread over; the default stays 30 for a 31-day month.
    """
    demand = (
        items.select("order_id", "product_id", "quantity")
        .join(orders.where(_within(*recent)).select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("sold"))
    )
    daily = F.col("sold").cast("double") / F.lit(float(divisor))
    days_left = F.try_divide(F.col("stock_available").cast("double"), daily)
    return (
        demand.join(products.select("product_id", "product_name"), "product_id")
        .join(stock.select("product_id", "stock_available"), "product_id")
        .select(
            "product_id",
            "product_name",
            _double("stock_available"),
            daily.alias("avg_daily_demand_recent"),
            round_half_even(days_left, 1).alias("days_of_stock_remaining"),
        )
        .orderBy(F.col("days_of_stock_remaining").asc_nulls_last(), "product_id")
    )


def customer_sales(per_order: DataFrame) -> DataFrame:
    """Orders and exact revenue per known customer.

    Runs before the customer join, so a customer with very many orders is one row there.
    """
    return (
        per_order.where(F.col("customer_id") != UNKNOWN_CUSTOMER)
        .groupBy("customer_id")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.sum("revenue").alias("revenue"),
        )
    )


def _region_performance(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        per_customer.join(customers.select("customer_id", "region"), "customer_id")
        .groupBy("region")
        .agg(F.sum("total_orders").alias("total_orders"), F.sum("revenue").alias("total_revenue"))
        .select("region", "total_orders", _double("total_revenue"))
    )


def region_performance(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct orders and revenue per region, without the unknown customer.

    An order has one customer, so distinct orders add up over customers.
    """
    known = orders.where(F.col("customer_id") != UNKNOWN_CUSTOMER)
    return _region_performance(customer_sales(order_sales(items, known)), customers).orderBy(
        F.desc("total_revenue"), "region"
    )


def _top_customers(per_customer: DataFrame, customers: DataFrame, n: int) -> DataFrame:
    return (
        per_customer.join(customers, "customer_id")
        .orderBy(F.desc("revenue"), "customer_id")
        .limit(n)
        .select("customer_id", "name", "region", _double("revenue", "total_spend"))
    )


def top_customers(
    items: DataFrame, orders: DataFrame, customers: DataFrame, n: int = 10
) -> DataFrame:
    """The `n` known customers with the highest spend."""
    known = orders.where(F.col("customer_id") != UNKNOWN_CUSTOMER)
    return _top_customers(customer_sales(order_sales(items, known)), customers, n)


def _long(df: DataFrame, section: str, label: str, name: str, metrics: list[str]) -> DataFrame:
    """Unpivot a ranked report to (section, rank, label, name, metric, value)."""
    values = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ]
    )
    return df.select(
        F.lit(section).alias("section"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col(label).cast("string").alias("label"),
        F.col(name).cast("string").alias("name"),
        F.inline(values),
    )


def _few_ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Positions in a report that is short by nature: categories, months, regions, top rows."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def report_sums(
    items: DataFrame,
    orders: DataFrame,
    base: tuple[str | None, str | None],
    compare: tuple[str | None, str | None],
    recent: tuple[str | None, str | None],
) -> DataFrame:
    """Exact sums of every line of a known order, by product, by month and by known customer (`kind`), in one pass.

    Lines join their orders once. Grouping sets sum them per product and per order, with a map-side combine; an order has
    one month and one customer, so its row counts as one order in each of them, and no distinct count is needed.
    """
    zero = F.lit(0).cast("decimal(12,2)")
    lines = items.select("order_id", "product_id", "quantity", revenue_of_line().alias("revenue")).join(
        orders.select("order_id", "order_date", "customer_id"), "order_id"
    )
    of_order = ["order_id", "order_date", "customer_id"]
    keys = ["product_id", *of_order]
    grains = lines.groupingSets([[F.col("product_id")], [F.col(c) for c in of_order]], *keys).agg(
        F.grouping("product_id").alias("by_order"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("revenue").alias("total_revenue"),
        _period_quantity(base).alias("q1_quantity"),
        _period_quantity(compare).alias("q4_quantity"),
        F.sum(F.when(_within(*recent), F.col("quantity")).otherwise(zero)).alias("sold"),
        F.count(F.when(_within(*recent), F.lit(1))).alias("recent_lines"),
    )
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def place(kind, product=number, month=text, customer=number):
        return F.struct(
            F.lit(kind).alias("kind"),
            product.cast("bigint").alias("product_id"),
            month.alias("month"),
            customer.cast("bigint").alias("customer_id"),
        )

    in_month = place("month", month=F.date_format("order_date", "yyyy-MM"))
    of_customer = place("customer", customer=F.col("customer_id"))
    known = F.col("customer_id") != UNKNOWN_CUSTOMER
    places = F.when(F.col("by_order") == 0, F.array(place("product", product=F.col("product_id"))))
    places = places.when(known, F.array(in_month, of_customer)).otherwise(F.array(in_month))
    measures = [c for c in grains.columns if c not in (*keys, "by_order")]
    return (
        grains.select(F.explode(places).alias("p"), "by_order", *measures)
        .groupBy("p.kind", "p.product_id", "p.month", "p.customer_id")
        .agg(*[F.sum(c).alias(c) for c in measures], F.sum(F.col("by_order").cast("bigint")).alias("total_orders"))
    )


def full_report(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    customers: DataFrame,
    stock: DataFrame,
    base: tuple[str | None, str | None] = (None, "2025-04-01"),
    compare: tuple[str | None, str | None] = ("2025-10-01", None),
    recent: tuple[str | None, str | None] = ("2025-12-01", None),
    low_stock_rows: int = 5,
    top_rows: int = 10,
) -> DataFrame:
    """All seven reports in one long frame: section, rank, label, name, metric, value.

    rank is the position in the section's own order; name is that of the product, category,
    month, region or customer (with its region).

    Lines are read and joined once. Two grouping sets sum them per product and per order, the orders count per month and
    per customer, and what the sections start from is stored: one row per product, month and customer.
    """
    sums = report_sums(items, orders, base, compare, recent)
    path = scratch_path(items.sparkSession, "report-sums")
    sums.write.partitionBy("kind").parquet(path)
    read = items.sparkSession.read.schema(sums.schema).parquet(path)
    per_product, per_month, by_customer = (
        read.where(F.col("kind") == kind) for kind in ("product", "month", "customer")
    )
    trend = per_product.select(
        "product_id",
        "q1_quantity",
        "q4_quantity",
        pct_change(F.col("q1_quantity"), F.col("q4_quantity")).alias("pct_change"),
    )
    daily = F.col("sold").cast("double") / F.lit(30.0)
    low_stock = (
        per_product.where("recent_lines > 0")
        .select("product_id", "sold")
        .join(products.select("product_id", "product_name"), "product_id")
        .join(stock.select("product_id", "stock_available"), "product_id")
        .select(
            "product_id",
            "product_name",
            "stock_available",
            daily.alias("avg_daily_demand_recent"),
            round_half_even(
                F.try_divide(F.col("stock_available").cast("double"), daily), 1
            ).alias("days_of_stock_remaining"),
        )
        .orderBy(F.col("days_of_stock_remaining").asc_nulls_last(), "product_id")
        .limit(low_stock_rows)
    )
    monthly = per_month.select("month", _double("total_revenue"), "total_orders")
    per_customer = by_customer.select("customer_id", "total_orders", F.col("total_revenue").alias("revenue"))
    totals = ["total_quantity_sold", "total_revenue"]
    listed = products.select("product_id", "product_name")
    # Both long rankings take one sort. A change is rounded to one digit, so it fits the decimal.
    kinds = dict(per_product.dtypes)
    ranked = numbered(
        per_product.select(
            "product_id",
            *totals,
            F.col("total_revenue").cast("decimal(38,4)").alias("place"),
            F.lit("best_sellers").alias("section"),
            *[F.lit(None).cast("double").alias(c) for c in ("q1_quantity", "q4_quantity", "pct_change")],
        )
        .unionByName(
            trend.select(
                "product_id",
                *[F.lit(None).cast(kinds[c]).alias(c) for c in totals],
                F.col("pct_change").cast("decimal(38,4)").alias("place"),
                F.lit("trend_analysis").alias("section"),
                *[F.col(c).cast("double").alias(c) for c in ("q1_quantity", "q4_quantity", "pct_change")],
            )
        )
        .join(listed, "product_id"),
        [F.col("place").desc_nulls_last(), F.asc("product_id")],
        within="section",
    )
    best = ranked.where("section = 'best_sellers'")
    changes = ranked.where("section = 'trend_analysis'")
    by_category = _category_performance(per_product, products, categories)
    top = _top_customers(per_customer, customers, top_rows)
    top = top.withColumn("named", F.concat_ws(", ", "name", "region"))
    sections = [
        _long(best, "best_sellers", "product_id", "product_name", totals),
        _long(
            _few_ranked(by_category, F.desc("total_revenue"), F.asc("category_id")),
            "category_performance",
            "category_name",
            "category_name",
            totals,
        ),
        _long(
            _few_ranked(monthly, F.asc("month")),
            "revenue_trends",
            "month",
            "month",
            ["total_revenue", "total_orders"],
        ),
        _long(
            changes,
            "trend_analysis",
            "product_id",
            "product_name",
            ["q1_quantity", "q4_quantity", "pct_change"],
        ),
        _long(
            _few_ranked(low_stock, F.col("days_of_stock_remaining").asc_nulls_last(), F.asc("product_id")),
            "low_stock_risk",
            "product_id",
            "product_name",
            ["stock_available", "avg_daily_demand_recent", "days_of_stock_remaining"],
        ),
        _long(
            _few_ranked(
                _region_performance(per_customer, customers), F.desc("total_revenue"), F.asc("region")
            ),
            "region_performance",
            "region",
            "region",
            ["total_orders", "total_revenue"],
        ),
        _long(
            _few_ranked(top, F.desc("total_spend"), F.asc("customer_id")),
            "top_customers",
            "customer_id",
            "named",
            ["total_spend"],
        ),
    ]
    report = sections[0]
    for section in sections[1:]:
        report = report.unionByName(section)
    return report


def revenue_reconciliation(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    tolerance: float = 1.0,
) -> DataFrame:
    """Do product, category and month totals agree, and is every product total positive?"""

    def total(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("side"), F.col("total_revenue").alias("amount"))

    sales = product_sales(items)
    by_product = sales.join(products.select("product_id", "category_id"), "product_id")
    by_category = (
        by_product.groupBy("category_id")
        .agg(F.sum("total_revenue").alias("total_revenue"))
        .join(categories, "category_id")
    )
    by_month = order_sales(items, orders).groupBy(F.trunc("order_date", "month")).agg(
        F.sum("revenue").alias("total_revenue")
    )

    def amount(side: str) -> Column:
        return F.sum(F.when(F.col("side") == side, F.col("amount")))

    sides = total("product", by_product).unionAll(total("category", by_category))
    sums = sides.unionAll(total("month", by_month)).agg(
        amount("product").alias("p"),
        amount("category").alias("c"),
        amount("month").alias("m"),
        F.min(F.when(F.col("side") == "product", F.col("amount"))).alias("low"),
    )
    limit = F.lit(str(tolerance)).cast("decimal(12,4)")
    return sums.select(
        _double("p", "product_total"),
        _double("c", "category_total"),
        _double("m", "month_total"),
        ((F.abs(F.col("p") - F.col("c")) < limit) & (F.abs(F.col("p") - F.col("m")) < limit)).alias(
            "totals_match"
        ),
        (F.col("low") > 0).alias("all_positive"),
    )
