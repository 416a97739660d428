from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from storecast import schema
from storecast.operators import quality


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(
        [("rice", 1, D(10)), ("salt", 2, D(4)), ("free", 3, D(0))],
        "product_name string, product_id bigint, unit_price decimal(12,2)",
    )


def lines(spark, *data):
    return spark.createDataFrame(
        [(i, o, n, D(1), None if p is None else D(str(p))) for i, o, n, p in data],
        schema.RAW_ORDER_ITEMS,
    )


def test_first_copy_by_position(spark):
    df = spark.createDataFrame([(1, 2, 11), (1, 1, 10), (2, 3, 9)], "id int, pos int, price int")
    kept = quality.keep_first(df, ["id"], ["pos"])
    assert rows(kept.select("id", "price")) == [(1, 10), (2, 9)]
    assert kept.columns == df.columns


def test_an_emptier_later_copy_loses(spark):
    df = spark.createDataFrame(
        [(1, 1, "Milk", 2.0), (1, 2, None, None), (2, None, "Tea", 1.0), (2, 9, "Rum", None)],
        "id int, pos int, name string, q double",
    )
    assert rows(quality.keep_first(df, ["id"], ["pos"])) == [(1, 1, "Milk", 2.0), (2, 9, "Rum", None)]
    assert rows(quality.keep_first(df.drop("pos").where("id = 1"), ["id"], [])) == [(1, "Milk", 2.0)]


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a")], "id int, pos int, v string")
    assert rows(quality.keep_first(df, ["id"], ["pos"])) == [(None, 1, "a")]


def test_missing_customers(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, "y")], schema.RAW_ORDERS)
    assert rows(quality.fill_missing_customers(df)) == [(1, -1, "x"), (2, 5, "y")]


def test_profile_of_orders(spark):
    df = spark.createDataFrame(
        [
            (1, None, "2025-01-05"),
            (1, None, "2025-01-05"),
            (2, 7, "05/01/2025"),
            (3, 7, "2025-1-6"),
        ],
        schema.RAW_ORDERS,
    )
    p = quality.profile_orders(df).first()
    assert (p.row_count, p.null_order_id, p.null_customer_id, p.duplicate_rows) == (4, 0, 2, 1)
    assert (p.malformed_dates, p.valid_dates) == (1, 3)
    assert (p.missing_customer_pct, p.malformed_date_pct) == (50.0, 25.0)


def test_profile_of_no_rows(spark):
    p = quality.profile_orders(spark.createDataFrame([], schema.RAW_ORDERS)).first()
    assert (p.row_count, p.duplicate_rows, p.missing_customer_pct) == (0, 0, None)


def test_price_anomalies_count_unknowns(spark, catalog):
    items = lines(
        spark, (1, 1, "rice", 10), (2, 1, "rice", 11), (3, 1, "what", 10), (4, 1, None, None)
    )
    p = quality.profile_order_items(items, catalog).first()
    assert (p.row_count, p.price_anomalies, p.null_product_name) == (4, 3, 1)


def test_price_sanity_is_strict(spark, catalog):
    prices = [15, 15.01, 5, 4.99]
    items = lines(
        spark,
        *[(i, 1, "rice", p) for i, p in enumerate(prices)],
        (8, 1, "what", 7),
        (9, 1, "free", 0),
        (10, 1, "free", 1),
        (11, 1, "rice", None),
    )
    flagged = quality.price_sanity(items, catalog)
    assert [r.order_item_id for r in flagged.orderBy("order_item_id").collect()] == [1, 3, 10]


def test_null_keys_are_orphans(spark):
    child = spark.createDataFrame([(9,), (None,), (1,), (1,)], "order_id int")
    parent = spark.createDataFrame([(1,), (2,)], "order_id int")
    assert quality.count_orphans(child, parent, "order_id").first().violations == 2


def test_validation_passes_and_fails(spark, catalog):
    orders = spark.createDataFrame([(1, 5, "2025-01-01")], schema.RAW_ORDERS)
    good = quality.validate_cleaned(orders, lines(spark, (1, 1, "rice", 10)), catalog)
    assert quality.all_passed(good)
    assert good.count() == 6
    bad = quality.validate_cleaned(
        orders.unionAll(orders),
        lines(spark, (1, 1, "rice", 10), (1, 4, "what", None)),
        catalog,
    )
    assert rows(bad) == [
        ("all", 5, False),
        ("duplicate_order_ids", 1, False),
        ("duplicate_order_item_ids", 1, False),
        ("missing_values", 1, False),
        ("order_id_references", 1, False),
        ("product_names", 1, False),
    ]
    assert not quality.all_passed(bad)


def test_quarantine_keeps_every_row_once(spark, catalog):
    items = lines(spark, (1, 1, "rice", 10), (2, 9, "rice", 10), (3, 1, "what", 1), (4, None, "rice", 1))
    # A parent listed twice must not double the lines.
    parents = spark.createDataFrame([(1,), (1,)], "order_id bigint")
    accepted, rejected = quality.fk_quarantine(
        items, {"order_id": (parents, "order_id"), "product_name": (catalog, "product_name")}
    )
    assert [r.order_item_id for r in accepted.collect()] == [1]
    assert rows(rejected.select("order_item_id", "reject_reason")) == [
        (2, "order_id"),
        (3, "product_name"),
        (4, "order_id"),
    ]


def test_constraints(spark):
    tables = {
        "categories": spark.createDataFrame([(1, "a"), (1, None)], schema.CATEGORIES),
        "products": spark.createDataFrame([(1, "p", 999, 1, D(100))], schema.PRODUCTS),
    }
    found = {
        (r.table_name, r.rule, r.column_name): r.violations
        for r in quality.constraint_report(tables).collect()
        if r.violations
    }
    assert found == {
        ("categories", "not_null", "category_name"): 1,
        ("categories", "primary_key", "category_id"): 1,
        ("products", "foreign_key", "category_id"): 1,
    }


def test_summary(spark, catalog):
    orders = spark.createDataFrame([(1, None, "x"), (1, None, "x")], schema.RAW_ORDERS)
    got = dict(
        rows(quality.profile_summary(orders, lines(spark, (1, 1, "rice", 9)), catalog))
    )
    assert got == {
        "orders": 2,
        "order_items": 1,
        "missing_customer_ids": 2,
        "duplicate_orders": 1,
        "duplicate_order_items": 0,
        "malformed_dates": 2,
        "price_anomalies": 1,
    }


def test_dates_are_fixed_in_place(spark):
    df = spark.createDataFrame([(1, 1, "bad"), (2, 1, "31/12/2025")], schema.RAW_ORDERS)
    fixed = quality.fix_dates(df)
    assert dict(fixed.dtypes)["order_date"] == "date"
    assert [str(r.order_date) for r in fixed.orderBy("order_id").collect()] == [
        "None",
        "2025-12-31",
    ]
    assert fixed.where(F.col("order_date").isNull()).count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_share_a_hash_are_no_copies(spark):
    """A forced collision: all rows have one hash, and only equal ones count."""
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, None), (None, None), (None, None)], "k int, v string")
    forced = [F.lit(7), F.lit(7)]
    assert quality.copied_rows(df, forced).first()[0] == quality.copied_rows(df).first()[0] == 3
    assert quality.copied_rows(df.limit(0)).first()[0] == 0
    assert quality.copied_rows(df.where("k = 2")).first()[0] == 0


@pytest.mark.parametrize("few", [1 << 20, 0])
def test_copies_beyond_what_may_be_sent_are_joined(spark, monkeypatch, shuffled, few):
    monkeypatch.setattr(quality, "BROADCAST_HASHES", few)
    df = spark.range(2000).select((F.col("id") % 700).alias("k"), F.lit("x").alias("v"))
    found = quality.copied_rows(df)
    assert found.first()[0] == 1300
    assert ("BroadcastHashJoin" in plan_of(found)) == bool(few)


def test_no_whole_row_is_shuffled_to_find_copies(spark):
    """Only rows whose hash occurs twice go through the exchange on all columns."""
    df = spark.range(5000).unionAll(spark.range(10)).select("id", F.concat(F.lit("text"), "id").alias("v"))
    found = quality.copied_rows(df)
    assert found.first()[0] == 10
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(id" in plan
    assert plan.index("BroadcastHashJoin") > plan.index("hashpartitioning(id")  # below it: joined first


def known_table():
    import uuid

    return f"known_{uuid.uuid4().hex}"


def test_batches_keep_the_first_copy_of_all(spark):
    known = known_table()
    batches = [
        [(1, 1, "a"), (1, 2, "b"), (2, 3, "c")],
        [(2, 4, "late"), (3, 6, "e"), (3, 5, "d")],
        [(None, 7, "n"), (1, 8, "late")],
        [(None, 9, "late"), (4, 10, "f")],
    ]
    got = []
    for rows_ in batches:
        df = spark.createDataFrame(rows_, "id bigint, pos int, v string")
        got += [tuple(r) for r in quality.first_copies(df, known, "id", ["pos"], 4).collect()]
    assert sorted(got, key=lambda r: r[1]) == [(1, 1, "a"), (2, 3, "c"), (3, 5, "d"), (None, 7, "n"), (4, 10, "f")]
    again = spark.createDataFrame(batches[0], "id bigint, pos int, v string")
    assert quality.first_copies(again, known, "id", ["pos"], 4).count() == 0


def test_the_history_is_not_shuffled(spark):
    known = known_table()
    quality.first_copies(spark.range(3000), known, "id", [], 8)
    batch = spark.range(2900, 3100)
    plan = quality._unknown(batch, spark.table(known), "id", 8)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("FileScan")  # above the batch only
    assert quality.first_copies(batch, known, "id", [], 8).count() == 100
