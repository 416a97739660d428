import datetime as dt
from decimal import Decimal as D

import pytest

from storecast.plans import reports


@pytest.fixture(scope="module")
def shop(spark):
    """Three products (one never sold), two categories, three customers and the unknown one."""
    make = spark.createDataFrame
    day = dt.date
    return {
        "products": make(
            [(1, "rice", 1), (2, "salt", 2), (3, "none", 2)],
            "product_id bigint, product_name string, category_id bigint",
        ),
        "categories": make([(1, "grain"), (2, "spice")], "category_id bigint, category_name string"),
        "customers": make(
            [(1, "Ann", "north"), (2, "Bo", "south"), (3, "Cy", "north"), (-1, "Unknown Customer", "Unknown")],
            "customer_id bigint, name string, region string",
        ),
        "orders": make(
            [
                (1, 1, day(2025, 1, 10)),
                (2, 2, day(2025, 12, 5)),
                (3, -1, day(2025, 12, 6)),
                (4, 1, day(2025, 12, 7)),
            ],
            "order_id bigint, customer_id bigint, order_date date",
        ),
        "items": make(
            [
                (1, 1, D("2.50"), D("10.00")),
                (1, 2, D("1.00"), D("4.00")),
                (2, 1, D("3.00"), D("10.00")),
                (3, 1, D("6.00"), D("9.99")),
                (4, 2, D("3.00"), D("4.00")),
                (4, 2, D("3.00"), D("4.00")),
            ],
            "order_id bigint, product_id bigint, quantity decimal(12,2), unit_price_at_order decimal(12,2)",
        ),
        "stock": make(
            [(1, D(30)), (2, D(2)), (3, D(5))], "product_id bigint, stock_available decimal(12,2)"
        ),
    }


def table(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_best_sellers(shop):
    got = reports.best_sellers(shop["items"], shop["products"])
    assert table(got, "product_name", "total_quantity_sold", "total_revenue") == [
        ("rice", 11.5, 114.94),
        ("salt", 7.0, 28.0),
    ]


def test_categories(shop):
    got = reports.category_performance(shop["items"], shop["products"], shop["categories"])
    assert table(got, "category_name", "total_revenue") == [("grain", 114.94), ("spice", 28.0)]


def test_months_include_the_unknown_customer(shop):
    got = reports.revenue_trends(shop["items"], shop["orders"])
    assert table(got, "month", "total_revenue", "total_orders") == [
        ("2025-01", 29.0, 1),
        ("2025-12", 113.94, 3),
    ]


def test_regions_and_customers_exclude_it(shop):
    regions = reports.region_performance(shop["items"], shop["orders"], shop["customers"])
    assert table(regions, "region", "total_orders", "total_revenue") == [
        ("north", 2, 53.0),
        ("south", 1, 30.0),
    ]
    top = reports.top_customers(shop["items"], shop["orders"], shop["customers"])
    assert table(top, "name", "total_spend") == [("Ann", 53.0), ("Bo", 30.0)]
    first = reports.top_customers(shop["items"], shop["orders"], shop["customers"], n=1)
    assert table(first, "name") == [("Ann",)]


def test_trend(shop):
    got = reports.trend_analysis(shop["items"], shop["orders"], shop["products"])
    assert table(got, "product_name", "q1_quantity", "q4_quantity", "pct_change") == [
        ("salt", 1.0, 6.0, 500.0),
        ("rice", 2.5, 9.0, 260.0),
    ]
    undefined = reports.trend_analysis(
        shop["items"],
        shop["orders"],
        shop["products"],
        base=("2025-02-01", "2025-03-01"),
        compare=("2025-12-01", None),
    )
    assert table(undefined, "product_id", "pct_change") == [(1, None), (2, None)]


def test_low_stock(shop):
    got = reports.low_stock_risk(
        shop["items"], shop["orders"], shop["products"], shop["stock"]
    )
    assert table(got, "product_name", "avg_daily_demand_recent", "days_of_stock_remaining") == [
        ("salt", 0.2, 10.0),
        ("rice", 0.3, 100.0),
    ]


def test_reconciliation(shop):
    row = reports.revenue_reconciliation(
        shop["items"], shop["orders"], shop["products"], shop["categories"]
    ).first()
    assert row.product_total == row.category_total == row.month_total == 142.94
    assert row.totals_match and row.all_positive


def test_full_report_repeats_the_single_reports(shop):
    got = reports.full_report(
        shop["items"],
        shop["orders"],
        shop["products"],
        shop["categories"],
        shop["customers"],
        shop["stock"],
        low_stock_rows=1,
    )
    values = {(r.section, r.label, r.metric): r.value for r in got.collect()}
    assert values["best_sellers", "1", "total_revenue"] == 114.94
    assert values["category_performance", "spice", "total_quantity_sold"] == 7.0
    assert values["revenue_trends", "2025-12", "total_orders"] == 3.0
    assert values["trend_analysis", "2", "pct_change"] == 500.0
    assert values["low_stock_risk", "2", "days_of_stock_remaining"] == 10.0
    assert ("low_stock_risk", "1", "days_of_stock_remaining") not in values
    assert values["region_performance", "north", "total_orders"] == 2.0
    assert values["top_customers", "1", "total_spend"] == 53.0


def test_totals_over_given_data(retail):
    sold = retail.items.select("product_id").distinct().count()
    best = reports.best_sellers(retail.items, retail.products)
    assert best.count() == sold
    assert best.where("total_revenue <= 0").count() == 0
    categories = reports.category_performance(retail.items, retail.products, retail.categories)
    assert categories.count() == retail.categories.count()
    row = reports.revenue_reconciliation(
        retail.items, retail.orders, retail.products, retail.categories
    ).first()
    assert row.totals_match and row.all_positive
