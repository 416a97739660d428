"""Retail tables over a folder of star-schema parquet files."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.schema import MONEY, UNKNOWN_CUSTOMER

# Periods that the trend report compares.
BASE_PERIOD = ("1997-01-01", "1997-04-01")
COMPARE_PERIOD = ("1997-10-01", "1998-01-01")
# A year that demand is designed for.
DESIGN_YEAR = ("1997-01-01", "1997-12-31")
# Days kept for testing, and days that count as recent, up to the last order.
TEST_DAYS = 47
RECENT_DAYS = 30


class Calendar(NamedTuple):
    """First and last day with orders; all other dates count back from the last."""

    start: dt.date
    end: dt.date

    @property
    def split(self) -> str:
        """First test day."""
        return str(self.end - dt.timedelta(days=TEST_DAYS - 1))

    @property
    def recent(self) -> tuple[str, str]:
        """The last days, as [from, to)."""
        return str(self.end - dt.timedelta(days=RECENT_DAYS - 1)), str(self.end + dt.timedelta(days=1))


def append_unknown_customer(customers: DataFrame) -> DataFrame:
    """Add the row that orders without a customer point to."""
    # The row's id and texts.
    extra = customers.sparkSession.createDataFrame(
        [(UNKNOWN_CUSTOMER, "Unknown Customer", "Unknown")],
        "customer_id bigint, name string, region string",
    )
    return customers.unionByName(extra)


@dataclass(frozen=True)
class RetailSource:
    """Lazy frames with the column names the operators expect."""

    spark: SparkSession
    path: str

    def scan(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        # Every 33rd order has no customer, so that the sentinel rules matter.
        return self.scan("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.when(F.col("o_orderkey") % 33 == 0, F.lit(UNKNOWN_CUSTOMER).cast("long"))
            .otherwise(F.col("o_custkey"))
            .alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )

    @cached_property
    def calendar(self) -> Calendar:
        days = self.orders.agg(F.min("order_date"), F.max("order_date")).first()
        return Calendar(*days)

    @cached_property
    def items(self) -> DataFrame:
        return self.scan("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast(MONEY).alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("unit_price_at_order"),
        )

    @cached_property
    def named_customers(self) -> DataFrame:
        return (
            self.scan("customer")
            .join(self.scan("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.scan("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("name"),
                F.col("r_name").alias("region"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return append_unknown_customer(self.named_customers)

    @cached_property
    def products(self) -> DataFrame:
        return self.scan("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_id"),
            F.col("p_brand").alias("series"),
            F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        name = F.col("p_type")
        return self.scan("part").select(
            name.alias("category_id"), name.alias("category_name")
        ).distinct()

    @cached_property
    def stock(self) -> DataFrame:
        return self.scan("part").select(
            F.col("p_partkey").alias("product_id"),
            (F.col("p_size") * (10 + F.col("p_partkey") % 12)).cast(MONEY).alias("stock_available"),
        )

    @cached_property
    def shelf_stock(self) -> DataFrame:
        """Stock on the shelf per product: every fifth has run out."""
        key = F.col("p_partkey")
        left = F.when(key % 5 == 0, F.lit(0)).otherwise(F.col("p_size") * (key % 7))
        return self.scan("part").select(
            key.alias("product_id"), left.cast(MONEY).alias("stock_available")
        )

    @cached_property
    def series(self) -> DataFrame:
        """Demand series: one per brand."""
        return self.scan("part").select(F.col("p_brand").alias("series")).distinct()

    @cached_property
    def raw_orders(self) -> DataFrame:
        """Uncleaned orders: blank customers, two date layouts, broken dates, copies.

        `pos` is the position in the file.
        """
        src = self.scan("orders")
        key, iso = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
        customer = F.when(key % 33 == 0, F.lit(None).cast("long")).otherwise(F.col("o_custkey"))
        day_first = F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy")
        written = F.when(key % 997 == 0, "bad").when(key % 67 == 0, day_first).otherwise(iso)
        originals = src.select(
            key.alias("pos"),
            key.alias("order_id"),
            customer.alias("customer_id"),
            written.alias("order_date"),
        )
        copies = src.where(key % 50 == 0).select(
            (key + F.lit(10000000000)).alias("pos"),
            key.alias("order_id"),
            customer.alias("customer_id"),
            iso.alias("order_date"),
        )
        return originals.unionAll(copies)

    @cached_property
    def product_lookup(self) -> DataFrame:
        """Unique product text, its id and its catalog price."""
        return self.scan("part").select(
            F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("product_name"),
            F.col("p_partkey").alias("product_id"),
            F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        )

    @cached_property
    def raw_lines(self) -> DataFrame:
        """Uncleaned lines: copies, unknown orders and products, changed prices.

        `pos` is the position in the file. Some copies follow their line and have lost the
        quantity, others come before it with another price.
        """
        order, line = F.col("l_orderkey"), F.col("l_linenumber")
        one = F.lit("1.00").cast("decimal(3,2)")
        factor = (
            F.when((order + line) % 101 == 0, F.lit("2.00").cast("decimal(3,2)"))
            .when((order + line) % 25 == 0, F.lit("1.15").cast("decimal(3,2)"))
            .otherwise(one)
        )
        # Order, line, product and quantity name a line; order and line alone do not.
        line_id = ((order * 10 + line) * 10000000 + F.col("l_partkey")) * 100 + F.col("l_quantity").cast("long")
        originals = (
            self.scan("lineitem")
            .join(self.scan("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                line_id.alias("pos"),
                line_id.alias("order_item_id"),
                F.when(order % 307 == 0, -order).otherwise(order).alias("order_id"),
                F.when(order % 499 == 0, "Unknown Item")
                .otherwise(F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")))
                .alias("product_name"),
                F.col("l_quantity").cast(MONEY).alias("quantity"),
                (F.col("p_retailprice").cast(MONEY) * factor)
                .cast(MONEY)
                .alias("unit_price_at_order"),
            )
        )
        later = originals.where(F.col("order_id") % 50 == 0).withColumns(
            {
                "pos": F.col("pos") + F.lit(4000000000000000000),
                "quantity": F.lit(None).cast(MONEY),
            }
        )
        earlier = originals.where(F.col("order_id") % 70 == 0).withColumns(
            {
                "pos": F.col("pos") - F.lit(4000000000000000000),
                "unit_price_at_order": (F.col("unit_price_at_order") + 1).cast(MONEY),
            }
        )
        return originals.unionAll(later).unionAll(earlier)

    @cached_property
    def raw_items(self) -> DataFrame:
        return self.raw_lines.drop("pos")

    @cached_property
    def raw_categories(self) -> DataFrame:
        """Categories with a numeric id: the lowest product id of each."""
        return (
            self.scan("part")
            .groupBy(F.col("p_type").alias("category_name"))
            .agg(F.min("p_partkey").alias("category_id"))
        )

    @cached_property
    def raw_suppliers(self) -> DataFrame:
        """Suppliers with the category they serve."""
        return (
            self.scan("supplier")
            .join(self.scan("part"), F.col("s_suppkey") == F.col("p_partkey"))
            .select(
                F.col("s_suppkey").alias("supplier_id"),
                F.col("s_name").alias("name"),
                F.col("p_type").alias("category"),
            )
        )
