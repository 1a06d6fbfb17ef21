"""Sharding by a two-pass external shuffle.

First pass: a seeded hash scatters the records uniformly into buckets that fit into memory, and writes them. Second pass:
each bucket is put in order of another seeded hash, shuffled (Fisher-Yates) and written. Buckets one after another are
one random order of all records; its places go to the shards in turn, so shards differ by one record at most, and the
place in the shard is the number of the turn. All is DataFrame functions.

A record's bucket depends on the seed, its key and its place in the input, so that even a key that all records share
spreads. Buckets are ``BUCKET_BYTES`` on average; the only table that all buckets go to has one short row per bucket.
The first pass is a stored table, so the second reads the same buckets however often a task is run.

Edge cases: null keys and texts are records like others, a null text of size 1. Equal records are as many records. A
record larger than a bucket makes its bucket larger. Without records there are no files. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.session import scratch_folder

SHARDS = 16
BUCKET_BYTES = 16 << 20
SEED = 1
LAW = "rows"


def size_of(text: Column) -> Column:
    """UTF-8 bytes and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write(docs: DataFrame, folder: str, shards: int = SHARDS, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write shards as Parquet folders ``shard=0`` and on, and give the stored table: key, text, ``slot``, ``shard``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    total = rows.agg(F.sum(size_of(F.col("text"))).alias("bytes")).first()["bytes"] or 0
    buckets = int(total // bucket_bytes) + 1
    scattered = _scatter(rows, buckets, seed, scratch_folder(spark, "scatter"))

    # As many rows as buckets.
    begin = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = scattered.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", F.coalesce(F.sum("n").over(begin), F.lit(0)).alias("first"))
    in_order = F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed + 1), "key", "text").alias("turn"), "key", "text")))
    mixed = scattered.repartition(buckets, "bucket").groupBy("bucket").agg(F.shuffle(in_order, seed + 2).alias("records"))
    placed = mixed.join(first, "bucket").select("first", F.posexplode("records").alias("pos", "record"))
    place = F.col("first") + F.col("pos")
    out = placed.select(F.col("record.key").alias(key), F.col("record.text").alias(text), F.floor(place / shards).alias("slot"), F.pmod(place, F.lit(shards)).cast("int").alias("shard"))
    out.write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    return spark.read.schema(out.schema).parquet(folder)


def _scatter(rows: DataFrame, buckets: int, seed: int, path: str) -> DataFrame:
    bucket = F.pmod(F.xxhash64(F.lit(seed), "key", F.monotonically_increasing_id()), F.lit(buckets)).cast("int")
    out = rows.select(bucket.alias("bucket"), "key", "text")
    out.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: where every document lies, from the written shards."""
    spark: SparkSession = docs.sparkSession
    stored = write(docs, scratch_folder(spark, "shards"))
    check = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return stored.select("doc_id", size_of(F.col("text")).alias("size"), check.alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
