"""File scans and sinks, SQL over named frames, and versioned table sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line. Without a schema every column is text; types are never inferred."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", False).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> bool:
    """Write CSV parts with a header each; an empty frame writes nothing.

    Returns whether anything was written. The emptiness test reads one row.
    """
    if df.isEmpty():
        return False
    df.write.option("header", True).csv(path)
    return True


def rows_to_frame(
    spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType
) -> DataFrame:
    """Literal rows (small dimension lists) as a frame with a declared schema."""
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def run_query(
    spark: SparkSession, text: str, args: dict[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run SQL text; `{name}` in it stands for the frame passed as `name`."""
    return spark.sql(text, args=args, **frames)


def append_table(
    df: DataFrame, table: str, bucket_by: str | None = None, buckets: int | None = None
) -> None:
    """Append to a catalog table, optionally bucketed and sorted on a join key.

    Two tables bucketed alike on the same key join without a shuffle.
    """
    writer = df.write.mode("append").format("parquet")
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)


def append_batch(df: DataFrame, path: str, batch: str, column: str = "batch") -> None:
    """Append a batch to a folder so that sending it again replaces it: twice leaves one copy.

    Rows lie in a partition of the batch's name, and only that partition is overwritten, when the write commits. An own
    column of that name is replaced. An empty batch sent again leaves what was there, as it names no partition.
    """
    named = df.withColumn(column, F.lit(batch))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, column: str = "batch") -> DataFrame:
    """All batches of a folder; their names come as text, in `column`."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(column, T.StringType())])).parquet(path)


def column_range(spark: SparkSession, path: str, column: str) -> tuple[Any, Any, int]:
    """(least, greatest, rows) of a Parquet folder, from the statistics in the files' footers: no data page is read.

    Spark answers such aggregates from footers only in its newer reader, which is switched on for this read. Where a
    type has no usable statistics, or a file lacks them, the same query reads the column instead.
    """
    found = footer_aggregate(spark, path, column).first()
    return found["least"], found["greatest"], found["n"]


def footer_aggregate(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The aggregate behind `column_range`; planned at once, while the settings hold."""
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.read.parquet(path)
        out = rows.agg(
            F.min(column).alias("least"), F.max(column).alias("greatest"), F.count(F.lit(1)).alias("n")
        )
        out._jdf.queryExecution().executedPlan()  # planned now
        return out
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def table_info(df: DataFrame) -> DataFrame:
    """Per column: position, type, non-null count, and the row count; one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"__n{i}") for i, c in enumerate(df.columns)],
    )
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col(f"__n{i}").alias("non_null"),
                F.col("__rows").alias("row_count"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select(F.inline(described))
