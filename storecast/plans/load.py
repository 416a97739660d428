"""Clean raw exports and load the seven tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storecast.operators.quality import (
    dedup_order_items,
    dedup_orders,
    fill_missing_customers,
    fix_dates,
    flag_references,
)
from storecast.schema import RULES, TableRules
from storecast.sources.retail import append_unknown_customer


def unique_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: the largest, so that a join on it never multiplies rows."""
    return df.groupBy(key).agg(F.max(value).alias(value))


def resolve_product_ids(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Lines with `product_id` in place of the product text; NULL when unknown."""
    lookup = unique_lookup(catalog, "product_name", "product_id")
    return items.join(lookup, "product_name", "left").select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price_at_order"
    )


def products_enriched(
    products: DataFrame, categories: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Products with the ids of their category and of the supplier serving it.

    Of several suppliers for one category the highest id is taken.
    """
    by_category = unique_lookup(
        categories.withColumnRenamed("category_name", "category"), "category", "category_id"
    )
    by_supplier = unique_lookup(suppliers, "category", "supplier_id")
    return (
        products.join(by_category, "category", "left")
        .join(by_supplier, "category", "left")
        .select("product_id", "product_name", "category_id", "supplier_id", "unit_price")
    )


def clean_orders(raw_orders: DataFrame, position: str = "pos") -> DataFrame:
    cleaned = dedup_orders(fill_missing_customers(raw_orders), position)
    return fix_dates(cleaned).select("order_id", "customer_id", "order_date")


def clean_order_items(raw_items: DataFrame, catalog: DataFrame, position: str = "pos") -> DataFrame:
    return resolve_product_ids(dedup_order_items(raw_items, position), catalog)


class ConstraintViolation(ValueError):
    """The accepted rows break a declared rule; nothing was published."""


def _with_reason(df: DataFrame, rule: TableRules, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Add `reject_reason`: the first column that is missing though required, or has no parent row; else NULL."""
    missing = F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in rule.required if c in df.columns],
        F.lit(None).cast("string"),
    )
    references = {
        column: (parents[parent], parent_column)
        for column, (parent, parent_column) in rule.references.items()
        if column in df.columns and parent in parents
    }
    flagged = flag_references(df, references, unique=True)
    reason = F.coalesce(missing, F.when(F.col("reject_reason").isNotNull(), F.concat(F.lit("unknown "), "reject_reason")))
    return flagged.withColumn("reject_reason", reason)


#: Tables whose cleaning leaves one row per key; all references are unique keys, so joining them keeps it that way.
DEDUPLICATED = {"orders", "order_items"}
TABLES_AT_ONCE = 4
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _written(judged: DataFrame, rule: TableRules, path: str) -> dict[str, int]:
    """Write judged rows once, accepted and rejected side by side, and return what was counted on the way.

    accepted, rejected, and null_<column> for each required column among accepted rows. The counts come from the tasks
    that write, so a task that runs again does not count twice.
    """
    spark, kept = judged.sparkSession, F.col("reject_reason").isNull()
    required = [c for c in rule.required if c in judged.columns]
    sided = judged.withColumn("side", F.when(kept, "accepted").otherwise("rejected"))
    seen = Observation()
    counted = sided.observe(
        seen,
        F.count(F.when(kept, 1)).alias("accepted"),
        F.count(F.when(~kept, 1)).alias("rejected"),
        *[F.count(F.when(kept & F.col(c).isNull(), 1)).alias(f"null_{c}") for c in required],
    )
    counted.write.partitionBy("side").parquet(path)
    found = seen.get
    for side in ("accepted", "rejected"):
        if not found[side]:  # an empty side still has a schema
            spark.createDataFrame([], judged.schema).write.parquet(f"{path}/side={side}")
    return found


def _parents(rule: TableRules) -> set[str]:
    return {parent for parent, _ in rule.references.values()}


def _broken_keys(df: DataFrame, key: str) -> int:
    """Rows beyond the first of each key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]


def load_retail(
    spark: SparkSession,
    root: str,
    raw: Mapping[str, DataFrame],
    position: str = "pos",
    rules: Mapping[str, TableRules] = RULES,
    enforce: bool = True,
) -> str:
    """Full refresh: clean `raw`, write accepted and rejected rows to a new path, check every rule, return the path.

    `raw` holds categories, suppliers, customers, products, inventory, orders and
    order_items as exported. Rows that lack a required value or an accepted parent go
    to `<table>/side=rejected` with the reason, parents first, so lines of a rejected
    order are rejected too. Each table is cleaned, judged and written once, in one job,
    which also counts. With `enforce`, a rule that accepted rows still break raises,
    and the caller goes on with the path it had: missing values by those counts, and
    repeated keys, which are looked for where cleaning does not remove them. References
    hold, as rows without a parent are rejected.

    Orders are written in order-date ranges and stock in quantity ranges, so that
    file statistics serve the filters on them; the second key splits a busy day.
    """
    catalog = raw["products"].select("product_name", "product_id")
    tables = {
        "categories": raw["categories"],
        "suppliers": raw["suppliers"].drop("category"),
        "customers": append_unknown_customer(raw["customers"]),
        "products": products_enriched(raw["products"], raw["categories"], raw["suppliers"]),
        "inventory": raw["inventory"],
        "orders": clean_orders(raw["orders"], position),
        "order_items": clean_order_items(raw["order_items"], catalog, position),
    }
    layout = {"inventory": ("stock_available", "product_id"), "orders": ("order_date", "order_id")}
    path = f"{root}/load-{uuid.uuid4().hex}"
    loaded: dict[str, DataFrame] = {}

    def load(name: str) -> tuple[DataFrame, list[str]]:
        judged = _with_reason(tables[name], rules[name], loaded)
        if name in layout:
            judged = judged.repartitionByRange(*layout[name])
        found = _written(judged, rules[name], f"{path}/{name}")
        rows = spark.read.schema(judged.schema).parquet(f"{path}/{name}/side=accepted").drop("reject_reason")
        broken = [f"{name}: {n} rows with {c}" for c, n in found.items() if c.startswith("null_") and n]
        if enforce and name not in DEDUPLICATED and (n := _broken_keys(rows, rules[name].key)):
            broken.append(f"{name}: {n} rows break primary_key {rules[name].key}")
        return rows, broken

    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, "2")  # a file open for each side, in place of a sort by side
    try:
        with ThreadPool(TABLES_AT_ONCE) as pool:
            # Tables whose parents are loaded go side by side; most are small.
            while waiting := [n for n in tables if n not in loaded]:
                ready = [n for n in waiting if _parents(rules[n]).isdisjoint(waiting)]
                if not ready:
                    raise ValueError(f"tables refer to each other: {waiting}")
                done = pool.map(inheritable_thread_target(spark)(load), ready)
                loaded |= {n: rows for n, (rows, _) in zip(ready, done)}
                broken = [line for _, lines in done for line in lines]
                if enforce and broken:
                    raise ConstraintViolation("; ".join(broken))
    finally:
        spark.conf.set(_WRITERS, before)
    return path


def loaded_table(spark: SparkSession, path: str, table: str, side: str = "accepted") -> DataFrame:
    """A table of a load, its accepted or its rejected rows."""
    rows = spark.read.parquet(f"{path}/{table}/side={side}")
    return rows.drop("reject_reason") if side == "accepted" else rows
