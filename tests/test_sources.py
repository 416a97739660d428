import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from storecast import schema
from storecast.plans import load
from storecast.session import scratch_path
from storecast.sources import files
from storecast.sources.retail import append_unknown_customer


def test_csv_roundtrip_keeps_nulls_and_types(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, None, "2025-01-05"), (2, 7, "5/1/2025")], schema.RAW_ORDERS)
    assert files.write_csv(df, path)
    back = files.scan_csv(spark, path, schema.RAW_ORDERS)
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    text = files.scan_csv(spark, path)
    assert {kind for _, kind in text.dtypes} == {"string"}


def test_wrong_header_is_not_read_by_position(spark):
    path = scratch_path(spark, "csv")
    files.write_csv(spark.range(3).select(F.col("id").alias("other"), "id", "id"), path)
    with pytest.raises(Exception, match="(?i)header|column"):
        files.scan_csv(spark, path, schema.RAW_ORDERS).collect()


def test_no_rows_write_nothing(spark):
    path = scratch_path(spark, "csv")
    assert not files.write_csv(spark.createDataFrame([], schema.RAW_ORDERS), path)
    with pytest.raises(Exception):
        files.scan_csv(spark, path).collect()


def test_sql_over_frames_with_arguments(spark):
    df = spark.range(10)
    got = files.run_query(spark, "SELECT count(*) n FROM {t} WHERE id >= :low", {"low": 4}, t=df)
    assert got.first().n == 6


def test_literal_rows(spark):
    df = files.rows_to_frame(spark, [{"category_id": 1, "category_name": "a"}], schema.CATEGORIES)
    assert df.schema == schema.CATEGORIES and df.count() == 1


def test_table_info(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], schema.RAW_ORDERS)
    got = [tuple(r) for r in files.table_info(df).orderBy("position").collect()]
    assert got == [
        (0, "order_id", "bigint", 2, 2),
        (1, "customer_id", "bigint", 0, 2),
        (2, "order_date", "string", 1, 2),
    ]


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = spark.range(1000).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("v"))
    right = spark.range(1000).select(F.col("id").alias("order_id"), (F.col("id") % 5).alias("w"))
    files.append_table(left, "bucketed_items", "order_id", 4)
    files.append_table(right, "bucketed_orders", "order_id", 4)
    files.append_table(right.where("order_id < 10"), "bucketed_orders", "order_id", 4)
    joined = (
        spark.table("bucketed_items").hint("merge").join(spark.table("bucketed_orders"), "order_id")
    )
    assert joined.count() == 1010
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


RAW_LINES = (
    "pos bigint, order_item_id bigint, order_id bigint, product_name string,"
    " quantity decimal(12,2), unit_price_at_order decimal(12,2)"
)


def raw_tables(spark):
    make = spark.createDataFrame
    return {
        "categories": make([(1, "grain"), (2, "spice")], schema.CATEGORIES),
        "suppliers": make(
            [(5, "S5", "c", "grain"), (6, "S6", "c", "spice"), (7, "S7", "c", "spice")],
            "supplier_id bigint, name string, contact_info string, category string",
        ),
        "customers": make([(1, "Ann", "north")], schema.CUSTOMERS),
        "products": make(
            [(1, "rice", "grain", D(10)), (2, "salt", "spice", D(4))],
            "product_id bigint, product_name string, category string, unit_price decimal(12,2)",
        ),
        "inventory": make([(1, D(5), dt.date(2025, 12, 30))], schema.INVENTORY),
        "orders": make(
            [(2, 1, 1, "2025-01-06"), (1, 1, None, "05/01/2025"), (3, 2, 1, "2025-01-07")],
            "pos bigint, order_id bigint, customer_id bigint, order_date string",
        ),
        "order_items": make(
            [(1, 1, 1, "rice", D(1), D(10)), (2, 1, 1, "rice", D(1), D(10)), (3, 2, 2, "salt", D(2), D(4))],
            RAW_LINES,
        ),
    }


def loaded(spark, path, side="accepted"):
    return {name: load.loaded_table(spark, path, name, side) for name in schema.RULES}


def test_load_writes_clean_tables(spark):
    root = scratch_path(spark, "store")
    first = load.load_retail(spark, root, raw_tables(spark))
    tables = loaded(spark, first)
    orders = sorted((r.order_id, r.customer_id, str(r.order_date)) for r in tables["orders"].collect())
    assert orders == [(1, -1, "2025-01-05"), (2, 1, "2025-01-07")]
    products = sorted((r.product_id, r.category_id, r.supplier_id) for r in tables["products"].collect())
    assert products == [(1, 1, 5), (2, 2, 7)]
    assert "category" not in tables["suppliers"].columns
    assert tables["order_items"].count() == 2
    assert tables["customers"].where("customer_id = -1").count() == 1
    assert all(df.count() == 0 for df in loaded(spark, first, "rejected").values())

    second = load.load_retail(spark, root, raw_tables(spark))
    assert second != first
    assert load.loaded_table(spark, second, "orders").count() == 2


def test_broken_rows_are_set_aside_with_a_reason(spark):
    raw = raw_tables(spark)
    raw["orders"] = raw["orders"].unionByName(
        spark.createDataFrame([(9, 5, 1, "bad"), (10, 6, 44, "2025-01-09")], raw["orders"].schema)
    )
    raw["order_items"] = spark.createDataFrame(
        [
            (1, 1, 1, "what", D(1), D(10)),
            (2, 2, 77, "salt", D(2), D(4)),
            (3, 3, 5, "salt", D(2), D(4)),
            (4, 4, 2, "salt", None, D(4)),
            (5, 5, 2, "salt", D(2), D(4)),
        ],
        RAW_LINES,
    )
    path = load.load_retail(spark, scratch_path(spark, "store"), raw)
    rejected = loaded(spark, path, "rejected")
    assert {(r.order_id, r.reject_reason) for r in rejected["orders"].collect()} == {
        (5, "missing order_date"),
        (6, "unknown customer_id"),
    }
    assert {(r.order_item_id, r.reject_reason) for r in rejected["order_items"].collect()} == {
        (1, "missing product_id"),
        (2, "unknown order_id"),
        (3, "unknown order_id"),  # its order was rejected
        (4, "missing quantity"),
    }
    assert [r.order_item_id for r in loaded(spark, path)["order_items"].collect()] == [5]


def test_a_repeated_key_stops_the_load(spark):
    raw = raw_tables(spark)
    raw["inventory"] = raw["inventory"].unionByName(raw["inventory"])
    with pytest.raises(load.ConstraintViolation, match="primary_key"):
        load.load_retail(spark, scratch_path(spark, "store"), raw)


def test_unknown_customer_row(spark):
    customers = append_unknown_customer(spark.createDataFrame([(1, "A", "n")], schema.CUSTOMERS))
    assert sorted(r.customer_id for r in customers.collect()) == [-1, 1]


def test_a_load_writes_each_table_once_and_counts_on_the_way(spark, monkeypatch):
    seen, written = {}, load._written

    def spy(judged, rule, path):
        seen[path.rsplit("/", 1)[1]] = written(judged, rule, path)
        return seen[path.rsplit("/", 1)[1]]

    monkeypatch.setattr(load, "_written", spy)
    raw = raw_tables(spark)
    raw["orders"] = raw["orders"].unionByName(
        spark.createDataFrame([(9, 5, 1, "bad"), (10, 6, 44, "2025-01-09")], raw["orders"].schema)
    )
    path = load.load_retail(spark, scratch_path(spark, "store"), raw)
    assert set(seen) == set(schema.RULES)
    for name, found in seen.items():
        for side in ("accepted", "rejected"):
            assert load.loaded_table(spark, path, name, side).count() == found[side]
        assert not any(n for c, n in found.items() if c.startswith("null_"))
    assert seen["orders"]["rejected"] == 2
    assert spark.conf.get(load._WRITERS) == "0"


def test_a_missing_value_that_no_reason_names_stops_the_load(spark, monkeypatch):
    monkeypatch.setattr(load, "_with_reason", lambda df, rule, parents: df.withColumn("reject_reason", F.lit(None).cast("string")))
    raw = raw_tables(spark)
    raw["categories"] = raw["categories"].withColumn("category_name", F.lit(None).cast("string"))
    with pytest.raises(load.ConstraintViolation, match="null_category_name"):
        load.load_retail(spark, scratch_path(spark, "store"), raw)


def test_a_batch_sent_twice_leaves_one_copy(spark):
    path = scratch_path(spark, "batches")
    rows = spark.createDataFrame([(1, "old"), (2, "b")], "id int, batch string")
    files.append_batch(rows, path, "2025-01-01")
    files.append_batch(rows.limit(1), path, "2025-01-02")
    files.append_batch(rows.select("id"), path, "2025-01-01")
    files.append_batch(rows.select("id"), path, "2025-01-01")
    files.append_batch(rows.limit(0), path, "2025-01-02")
    back = files.read_batches(spark, path, rows.select("id").schema)
    assert sorted(map(tuple, back.collect())) == [(1, "2025-01-01"), (1, "2025-01-02"), (2, "2025-01-01")]


def test_ranges_come_from_footers(spark):
    path = scratch_path(spark, "dated")
    days = spark.range(100).select(F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    days.repartition(3).write.parquet(path)
    assert files.column_range(spark, path, "d") == (dt.date(2025, 1, 1), dt.date(2025, 4, 10), 100)
    plan = files.footer_aggregate(spark, path, "d")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(d), MAX(d), COUNT(*)]" in plan
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert "parquet" in before and spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_ranges_without_statistics_read_the_column(spark):
    path = scratch_path(spark, "text")
    spark.createDataFrame([("b",), (None,), ("a",)], "s string").write.parquet(path)
    assert files.column_range(spark, path, "s") == ("a", "b", 3)
