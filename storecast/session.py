"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this package is written for. All of them are
# size-driven at run time: joins broadcast only below the threshold, shuffle
# partitions are coalesced or split from measured bytes.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


# Shuffle partitions to a GB of input: 128 MB each. Adaptive execution merges what is too many.
PARTITIONS_PER_GB = 8


def build_session(
    app: str = "storecast", master: str | None = None, input_gb: float | None = None, **extra: str
) -> SparkSession:
    """Session with the package settings; `extra` uses two underscores for a dot.

    Give `input_gb` for large inputs: Spark's default of 200 shuffle partitions would hold GBs each.
    """
    if input_gb is not None:
        partitions = max(200, round(input_gb * PARTITIONS_PER_GB))
        extra = {"spark__sql__shuffle__partitions": str(partitions), **extra}
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="storecast-")
        spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back, so that it is worked out once and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
