"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.session import scratch_path

#: Stands for a missing id where ids are compared; sorts before all others.
NO_ID = -(2**63)
#: Rows of an Arrow batch. Texts of 100 KB make 100 MB of it at most.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here, lost executors cost nothing.

    The shuffles that led to it are dropped at once, as nothing reads them again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a stored frame that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def mapped(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """`df.mapInArrow(run, schema)` in batches that stay small when texts are long.

    Batches are counted in rows, so the session's setting is lowered if it is above BATCH_ROWS. A task gives back the
    memory it no longer needs, since Spark keeps its Python worker for later tasks.
    """
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return this process's free memory to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def id_or_none(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID))


#: Leading characters by which rows of one id are ordered, before a hash of the text.
ORDER_CHARS = 64


def told_apart(rows: DataFrame, key: Column, text: str, name: str) -> DataFrame | None:
    """`rows` with a number of their own (`name`) that grows with `key`; None if keys are unique as they are.

    Rows of one key are numbered by the first characters of their text, then by its hash; equal rows in any order. They
    are sorted over all tasks by all of that, so a key that holds a third of the rows, or one row that is repeated as
    often, is spread like any others. The numbered rows are stored, as a number must not change when a task is repeated.
    """
    if rows.groupBy(key.alias("k")).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return None
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    place = tied.orderBy(key, F.substring(text, 1, ORDER_CHARS), F.xxhash64(text), "_tie").drop("_tie")
    return stored(place.withColumn(name, F.monotonically_increasing_id()), "told-apart")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column without nulls, end to end, and where each row starts (one more than rows)."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]
