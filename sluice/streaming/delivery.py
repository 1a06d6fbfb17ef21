"""Where streams end: tables, JSON output, raw archive, intake with dead letters and quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sluice.functions.numbers import json_float, json_int
from sluice.operators.intake import accepted, classify, dead_letters, decode, load_stats, quarantined
from sluice.sources.records import rollup_record


def start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    """Starts a query; without an interval it takes what there is and ends."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def to_table(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends rows to a Parquet table. The file sink's own log makes this exactly-once."""
    return start(stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint, every)


def json_rows(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text. Decimals become integers, or floats if they have a fraction."""
    fields = []
    for name, kind in rows.dtypes:
        if kind.startswith("decimal"):
            # to_json leaves nulls out, so of the two forms only the one that applies is written.
            number = F.struct(json_int(F.col(name)).alias("i"), json_float(F.col(name)).alias("f"))
            fields += [number["i"].alias(name), number["f"].alias(name)]
        else:
            fields.append(F.col(name))
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))


def rollup_json(rows: DataFrame) -> DataFrame:
    """Rollup rows as JSON texts that ``decode`` reads once they are in base64."""
    return rows.select(F.to_json(rollup_record()).alias("value"))


def to_json_files(rows: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Rows as JSON lines; the same ``value`` column would go to a Kafka sink."""
    writer = json_rows(rows).writeStream.outputMode("append").format("text").option("path", path)
    return start(writer, checkpoint, every)


def archive(raw: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Raw records as they came, uncompressed, flushed every minute."""
    writer = raw.writeStream.outputMode("append").format("json").option("compression", "none").option("path", path)
    return start(writer, checkpoint, every)


def intake_batch(
    items_path: str, dead_path: str, stats_path: str, quarantine_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores a batch of rollup records in base64 JSON.

    Records without a place in the store go to the quarantine as they came, with the reason; by default it lies beside
    the dead letters.

    Each batch overwrites its own folder, so a batch that is delivered again
    after a failure replaces its rows instead of adding to them.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        items = classify(decode(batch.select("data")), "data").persist()
        try:
            for rows, path in (
                (accepted(items).drop("data"), items_path),
                (dead_letters(items).drop("data"), dead_path),
                (quarantined(items).select("reason", "data"), quarantine_path or f"{dead_path}_quarantine"),
                (load_stats(items), stats_path),
            ):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            items.unpersist()

    return store


def to_intake(
    records: DataFrame,
    items_path: str,
    dead_path: str,
    stats_path: str,
    checkpoint: str,
    every: str | None = None,
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Decodes, classifies and stores rollup records; no record stops the stream."""
    writer = records.writeStream.foreachBatch(intake_batch(items_path, dead_path, stats_path, quarantine_path))
    return start(writer, checkpoint, every)
