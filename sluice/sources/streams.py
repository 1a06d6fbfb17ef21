"""Stream sources and the parsing of their records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.time import parse_time
from sluice.schema import KPI_EVENT, KPIS, WIRE_EVENT


def topic(
    spark: SparkSession, servers: str, name: str, from_start: bool = False, records_per_batch: int | None = None
) -> DataFrame:
    """A Kafka topic, from its oldest record or from now on; needs Spark's Kafka package.

    ``records_per_batch`` bounds a micro-batch, as a consumer that polls a few records does.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", name)
        .option("startingOffsets", "earliest" if from_start else "latest")
    )
    if records_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", records_per_batch)
    return reader.load().select(F.col("value").cast("string"), F.col("timestamp").alias("arrival"))


def folder(
    spark: SparkSession, path: str, since: datetime | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A folder that receives files of JSON lines; a record arrives when its file does.

    ``since`` leaves out what had arrived before, as a consumer does that starts from now on.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.text(path).select("value", F.col("_metadata.file_modification_time").alias("arrival"))
    return rows if since is None else rows.filter(F.col("arrival") >= F.lit(since))


def typed_folder(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder that receives Parquet files of typed KPI events."""
    reader = spark.readStream.schema(KPI_EVENT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def parse_events(raw: DataFrame, arrival: Column | str = "arrival", *carried: str) -> DataFrame:
    """JSON records as typed KPI events, plus the raw text of those that cannot be read in ``bad_record``."""
    schema = T.StructType([*WIRE_EVENT, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    e = F.col("e")
    return raw.withColumn("e", F.from_json("value", schema, options)).select(
        *carried,
        parse_time(e["event-time"]).alias("event_time"),
        F.col(arrival).alias("ingest_time") if isinstance(arrival, str) else arrival.alias("ingest_time"),
        e["region"].alias("region"),
        e["state"].alias("state"),
        e["store-id"].alias("store_id"),
        *[e[k.replace("_", "-")].alias(k) for k in KPIS],
        F.when(e["_corrupt"].isNotNull() | parse_time(e["event-time"]).isNull(), F.col("value")).alias("bad_record"),
    )
