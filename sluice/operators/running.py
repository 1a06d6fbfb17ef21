"""Running totals per key that hold up when one key has most of the rows.

A window partitioned by the key would put a hot key into one task. Here the rows
are range-partitioned by key *and* order, so a hot key spreads over as many
partitions as its share of the data. Each partition adds up on its own, and what
a key had reached in the partitions before is added as an offset. Only a key that
crosses a partition border needs an offset, so there are at most as many offset
rows as borders: that table is safe to broadcast whatever the data size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_folder, through_table


def ordered_chunks(df: DataFrame, key: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows in global (key, order) order over partitions of like size, numbered by ``chunk``.

    Without a number of partitions, AQE joins neighbours that are small.
    """
    count = [partitions] if partitions else []
    return (
        df.repartitionByRange(*count, key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("chunk", F.spark_partition_id())
    )


def running_total(
    df: DataFrame, key: str, order: list[str], value: str, name: str, partitions: int | None = None
) -> DataFrame:
    """``df`` plus the running total of ``value`` (a bigint) per ``key`` in ``order``, as ``name``.

    ``order`` must be unique within a key.
    """
    chunks = ordered_chunks(df, key, order, partitions)
    schema = T.StructType([*chunks.schema, T.StructField(name, T.LongType())])
    local = chunks.mapInArrow(_add_running(key, value), schema)
    # The chunk numbers come from sampled borders, so they are fixed in a table before use.
    stored = through_table(local, scratch_folder(df.sparkSession, "running"))

    # One row per chunk, so the window over all of them is small.
    spans = stored.groupBy("chunk").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    spans = spans.withColumn("crosses", F.col("first") == F.lag("last").over(Window.orderBy("chunk")))
    crossing = spans.filter("crosses").select(F.col("first").alias(key)).distinct()
    reached = (
        stored.join(F.broadcast(crossing), key, "left_semi")
        .groupBy(key, "chunk")
        .agg(F.sum(value).alias("total"))
    )
    before = Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = reached.select(key, "chunk", F.sum("total").over(before).alias("offset"))
    return (
        stored.join(F.broadcast(offsets), [key, "chunk"], "left")
        .withColumn(name, F.col(name) + F.coalesce("offset", F.lit(0)))
        .drop("chunk", "offset")
    )


def _add_running(key: str, value: str):
    """Running sum over sorted batches; the only state is the last key and its sum so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, so_far = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            total = np.cumsum(batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64))
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            base = np.where(starts > 0, total[starts - 1], 0)
            if keys[0] == last_key:
                base[0] -= so_far
            total -= np.repeat(base, np.diff(np.append(starts, len(keys))))
            last_key, so_far = keys[-1], int(total[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total)], names=[*batch.schema.names, "running"]
            )

    return run
