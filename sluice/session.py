"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", name: str = "sluice", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        # Small test data: let every core have a part of it. Clusters keep Spark's default.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder for one job, in the shared folder that the cluster names.

    The shared folder is ``spark.checkpoint.dir``, or the session's warehouse where that is unset. All folders of an
    application lie in one folder with its id. Results that are read lazily may still need them, so whoever runs the
    application calls ``drop_scratch`` at its end.
    """
    return f"{_shared(spark)}/{label}-{uuid.uuid4().hex}"


def _shared(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has put into the shared folder, after its last result is read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_shared(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows that a task adds up by key, and bytes of Parquet files that hold about as many.
TASK_ROWS, TASK_BYTES = 500_000, 8 << 20
PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def shuffled_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside shuffle into as many parts as that many rows need, or more where the session says so."""
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(max(int(before), -(-rows // TASK_ROWS))))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def apart(stored: DataFrame, *keys: str) -> DataFrame:
    """Rows of files, dealt out by the keys that they will be grouped by where they are too many for the session's number
    of shuffle partitions."""
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = -(-size // TASK_BYTES)
    return stored.repartition(parts, *keys) if parts > int(stored.sparkSession.conf.get(PARTITIONS)) else stored


def through_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table and read it back, which cuts its lineage.

    Lost executors cost a re-read of the table and no re-run of what made it.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    schema = df.schema
    return df.sparkSession.read.schema(schema).parquet(path)
