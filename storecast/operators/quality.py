"""Profiling, cleaning, validation and quarantine of raw order data.

Counting operators group before they join or compare, so a key (or a copied row)
that fills a large part of the input reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.functions import parse_iso, repair_date, share_pct
from storecast.schema import RULES, UNKNOWN_CUSTOMER, TableRules
from storecast.session import stored
from storecast.sources.files import append_table


#: Buckets of a table of known keys; every batch is dealt out into as many parts.
KEY_BUCKETS = 64
#: Hashes of 16 bytes that may be sent to every task: 16 MB.
BROADCAST_HASHES = 1 << 20


def _total(n: Column) -> Column:
    return F.coalesce(F.sum(n), F.lit(0)).cast("long")


def _weighted(condition: Column) -> Column:
    """Rows (counted in `n`) that meet a condition."""
    return _total(F.when(condition, F.col("n")))


def _distinct_rows(df: DataFrame) -> DataFrame:
    """Each distinct row once, with its count `n`. Nulls compare equal."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def _null_counts(columns: Sequence[str]) -> list[Column]:
    return [_weighted(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def profile_orders(orders: DataFrame) -> DataFrame:
    """One row: size, nulls per column, copied rows, missing customers, date layout.

    One scan and one shuffle: every figure is a weighted sum over the distinct rows.
    """
    malformed = parse_iso(F.col("order_date")).isNull()
    counts = _distinct_rows(orders).agg(
        _total(F.col("n")).alias("row_count"),
        *_null_counts(orders.columns),
        _total(F.col("n") - 1).alias("duplicate_rows"),
        _weighted(malformed).alias("malformed_dates"),
    )
    return counts.select(
        "*",
        share_pct(F.col("null_customer_id"), F.col("row_count")).alias("missing_customer_pct"),
        (F.col("row_count") - F.col("malformed_dates")).alias("valid_dates"),
        share_pct(F.col("malformed_dates"), F.col("row_count")).alias("malformed_date_pct"),
    )


def profile_order_items(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row: size, nulls per column, copied rows, prices that differ from the catalog.

    `catalog` has unique `product_name` and `unit_price`. A product it does not
    hold, or a missing price, counts as an anomaly.
    """
    priced = _distinct_rows(items).join(
        catalog.select("product_name", F.col("unit_price").alias("expected_price")),
        "product_name",
        "left",
    )
    differs = F.coalesce(F.col("unit_price_at_order") != F.col("expected_price"), F.lit(True))
    counts = priced.agg(
        _total(F.col("n")).alias("row_count"),
        *_null_counts(items.columns),
        _total(F.col("n") - 1).alias("duplicate_rows"),
        _weighted(differs).alias("price_anomalies"),
    )
    return counts.select(
        "*", share_pct(F.col("price_anomalies"), F.col("row_count")).alias("price_anomaly_pct")
    )


def profile_summary(orders: DataFrame, items: DataFrame, catalog: DataFrame) -> DataFrame:
    """The seven headline counters as (metric, value)."""

    def counters(profile: DataFrame, names: Mapping[str, str]) -> DataFrame:
        rows = F.array(
            *[
                F.struct(F.lit(name).alias("metric"), F.col(column).alias("value"))
                for name, column in names.items()
            ]
        )
        return profile.select(F.inline(rows))

    of_orders = counters(
        profile_orders(orders),
        {
            "orders": "row_count",
            "missing_customer_ids": "null_customer_id",
            "duplicate_orders": "duplicate_rows",
            "malformed_dates": "malformed_dates",
        },
    )
    of_items = counters(
        profile_order_items(items, catalog),
        {
            "order_items": "row_count",
            "duplicate_order_items": "duplicate_rows",
            "price_anomalies": "price_anomalies",
        },
    )
    return of_orders.unionByName(of_items)


def fill_missing_customers(orders: DataFrame) -> DataFrame:
    """Orders without a customer go to the unknown customer."""
    filled = F.coalesce(F.col("customer_id").cast("long"), F.lit(UNKNOWN_CUSTOMER).cast("long"))
    return orders.withColumn("customer_id", filled)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by `order`, then by the remaining columns. NULL comes last everywhere.

    A minimum over rows, not a ranking: it combines on the map side, so a key
    with very many copies never meets in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    ordered = [c for c in order if c not in key] + rest
    if not ordered:
        return df.select(*key).distinct()
    place = F.struct(*[x for c in ordered for x in (F.col(c).isNull(), F.col(c))])
    row = F.struct(*[F.col(c) for c in ordered])
    picked = df.groupBy(*key).agg(F.min_by(row, place).alias("first"))
    return picked.select(
        *[F.col(c) if c in key else F.col(f"first.{c}").alias(c) for c in df.columns]
    )


def dedup_orders(orders: DataFrame, position: str = "pos") -> DataFrame:
    """First copy of each order in file order."""
    return keep_first(orders, ["order_id"], [position])


def dedup_order_items(items: DataFrame, position: str = "pos") -> DataFrame:
    """First copy of each line in file order."""
    return keep_first(items, ["order_item_id"], [position])


def first_copies(
    batch: DataFrame, known: str, key: str, order: Sequence[str], buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Of a new batch, the first copy of each key that no earlier batch had; its keys join the known ones.

    `known` names a table of the keys loaded so far, bucketed and sorted by key; it is made by the first batch. Only the
    batch is shuffled, into as many parts as the table has buckets: the history, which grows, is read in place, bucket
    beside part. A NULL key is a key like any other. The result is stored before the keys are appended, so a batch that
    fails before that may simply be sent again; one that failed after it has no new keys left and returns nothing.
    """
    spark = batch.sparkSession
    first = keep_first(batch, [key], order)
    if spark.catalog.tableExists(known):
        first = _unknown(first, spark.table(known), key, buckets)
    kept = stored(first, "first-copies")
    append_table(kept.select(key), known, key, buckets)
    return kept


def _unknown(first: DataFrame, known: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows whose key is not known. The hint keeps Spark from shuffling the history to a number of its own."""
    history = known.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull())
    dealt = first.repartition(buckets, key)
    unseen = dealt.join(history.hint("merge"), F.col(key) == F.col("__key"), "left_anti")
    if known.where(F.col(key).isNull()).isEmpty():
        return unseen
    return unseen.where(F.col(key).isNotNull())


def copied_rows(df: DataFrame, hashes: Sequence[Column] | None = None) -> DataFrame:
    """(duplicate_rows): rows beyond the first of each set of equal rows. Nulls compare equal.

    Rows are counted by 128 bits of hash, so only hashes travel, and combine on the map side. Full rows are fetched only
    for hashes that occur twice, and compared: rows that merely share a hash are not copies. Up to BROADCAST_HASHES such
    hashes are sent to all tasks, so that no other row is moved; beyond, rows are joined by hash.

    Two scans in place of one shuffle of all rows, which pays for wide rows; the profiles, over narrow ones, take the
    shuffle, as it serves their other figures too.
    """
    own = [F.xxhash64(F.lit(i), *[F.col(c) for c in df.columns]) for i in (1, 2)] if hashes is None else list(hashes)
    names = [f"__h{i}" for i in range(len(own))]
    hashed = df.select("*", *[h.alias(n) for h, n in zip(own, names)])
    counts = hashed.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    twice = stored(counts.where(F.col("__n") > 1).drop("__n"), "repeated-hashes")
    few = twice.count() <= BROADCAST_HASHES
    met = hashed.join(F.broadcast(twice) if few else twice, names, "left_semi").select(*df.columns)
    return _distinct_rows(met).agg(_total(F.col("n") - 1).alias("duplicate_rows"))


def fix_dates(orders: DataFrame) -> DataFrame:
    """Text dates in either accepted layout become dates; others become NULL."""
    return orders.withColumn("order_date", repair_date(F.col("order_date")))


def price_sanity(items: DataFrame, catalog: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Lines priced more than `threshold` (a share) away from the catalog.

    Reports only. Unknown products are not flagged; against a catalog price of
    zero any other price is.
    """
    expected = F.col("expected_price").cast("double")
    gap = F.abs(F.col("unit_price_at_order").cast("double") - expected)
    flagged = F.when(expected == 0, gap > 0).otherwise(gap / expected > F.lit(threshold))
    return (
        items.join(
            catalog.select("product_name", F.col("unit_price").alias("expected_price")),
            "product_name",
        )
        .where(flagged)
        .select(*items.columns, "expected_price")
    )


def count_orphans(
    child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None
) -> DataFrame:
    """Rows of `child` whose `column` has no match in `parent`; NULL has none.

    `(violations)`, one row. Only distinct values are joined.
    """
    parents = parent.select(F.col(parent_column or column).alias("value"))
    values = child.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return values.join(parents, "value", "left_anti").agg(_total(F.col("n")).alias("violations"))


def _key_counts(df: DataFrame, key: str) -> DataFrame:
    """(nulls, duplicates) of a table: null cells, and rows beyond the first of each key."""
    nulls = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("nulls"))
    return per_key.agg(
        _total(F.col("nulls")).alias("nulls"), _total(F.col("n") - 1).alias("duplicates")
    )


def validate_cleaned(orders: DataFrame, items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Five checks plus `all`: (check_name, violations, passed)."""

    def check(df: DataFrame, name: str, column: str) -> DataFrame:
        return df.select(F.lit(name).alias("check_name"), F.col(column).alias("violations"))

    def both(df: DataFrame, duplicates: str) -> DataFrame:
        return df.select(
            F.inline(
                F.array(
                    F.struct(
                        F.lit("missing_values").alias("check_name"),
                        F.col("nulls").alias("violations"),
                    ),
                    F.struct(
                        F.lit(duplicates).alias("check_name"),
                        F.col("duplicates").alias("violations"),
                    ),
                )
            )
        )

    found = (
        both(_key_counts(orders, "order_id"), "duplicate_order_ids")
        .unionAll(both(_key_counts(items, "order_item_id"), "duplicate_order_item_ids"))
        .unionAll(
            check(
                count_orphans(items, orders, "order_id"),
                "order_id_references",
                "violations",
            )
        )
        .unionAll(
            check(
                count_orphans(items, catalog, "product_name"),
                "product_names",
                "violations",
            )
        )
    )
    # Six rows at most from here on.
    return (
        found.rollup("check_name")
        .agg(F.sum("violations").alias("violations"))
        .select(
            F.coalesce("check_name", F.lit("all")).alias("check_name"),
            "violations",
            (F.col("violations") == 0).alias("passed"),
        )
    )


def all_passed(checks: DataFrame) -> bool:
    return checks.agg(F.every("passed")).first()[0]


def flag_references(
    df: DataFrame, references: Mapping[str, tuple[DataFrame, str]], unique: bool = False
) -> DataFrame:
    """Add `reject_reason`: the first column without a parent row, or NULL.

    `references` maps a column to (parent frame, parent column). Parents are
    deduplicated, so no input row is ever multiplied, unless `unique` says that the
    columns are keys.
    """
    flagged, reason = df, F.lit(None).cast("string")
    for i, (column, (parent, parent_column)) in enumerate(references.items()):
        known = f"__known{i}"
        parents = parent.select(F.col(parent_column).alias(column))
        parents = parents if unique else parents.distinct()
        flagged = flagged.join(parents.withColumn(known, F.lit(True)), column, "left")
        reason = F.coalesce(reason, F.when(F.col(known).isNull(), F.lit(column)))
    return flagged.select(*df.columns, reason.alias("reject_reason"))


def fk_quarantine(
    df: DataFrame, references: Mapping[str, tuple[DataFrame, str]], unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted rows, rejected rows with `reject_reason`)."""
    flagged = flag_references(df, references, unique)
    accepted = flagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, flagged.where(F.col("reject_reason").isNotNull())


def constraint_report(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules] = RULES
) -> DataFrame:
    """Not-null, primary-key and foreign-key violations of the tables given.

    (table_name, rule, column_name, violations). Columns, parents and tables that
    are absent are left out.
    """
    parts = []
    for table, df in tables.items():
        rule = rules[table]
        required = [c for c in rule.required if c in df.columns]
        checks = [("not_null", c, f"__null_{c}") for c in required]
        checks.append(("primary_key", rule.key, "__duplicates"))
        per_key = df.groupBy(rule.key).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(F.col(c).isNull().cast("long")).alias(f"__null_{c}") for c in required],
        )
        counted = per_key.agg(
            _total(F.col("n") - 1).alias("__duplicates"),
            *[_total(F.col(f"__null_{c}")).alias(f"__null_{c}") for c in required],
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(kind).alias("rule"),
                    F.lit(column).alias("column_name"),
                    F.col(counter).alias("violations"),
                )
                for kind, column, counter in checks
            ]
        )
        parts.append(counted.select(F.inline(rows)))
        for column, (parent, parent_column) in rule.references.items():
            if column in df.columns and parent in tables:
                orphans = count_orphans(df, tables[parent], column, parent_column)
                parts.append(
                    orphans.select(
                        F.lit(table).alias("table_name"),
                        F.lit("foreign_key").alias("rule"),
                        F.lit(column).alias("column_name"),
                        "violations",
                    )
                )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
