"""Records as they go over the wire; ``parse_events`` and ``decode`` read them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.schema import KPI_SUMS, KPIS

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def event_record() -> Column:
    """An event as producers send it. The field names are fixed values."""
    return F.struct(
        F.date_format("event_time", ISO_MICROS).alias("event-time"),
        "state",
        "region",
        F.col("store_id").alias("store-id"),
        *[F.col(k).alias(k.replace("_", "-")) for k in KPIS],
    )


def rollup_record(measures: Sequence[str] = tuple(KPI_SUMS)) -> Column:
    """A rollup row as the delivery function receives it. The field names are fixed values."""
    return F.struct(
        "type",
        "region",
        "state",
        F.col("store_id").alias("store-id"),
        *[F.col(m).alias(f"KPI_{i}_SUM") for i, m in enumerate(measures, 1)],
        F.col("n_rec").alias("N_REC"),
        F.date_format("event_time", ISO_MICROS).alias("EVENT_TIME"),
        F.date_format("ingest_time", ISO_MICROS).alias("INGEST_TIME"),
    )


def in_envelope(record: Column) -> Column:
    """A record as base64 of its JSON."""
    return F.base64(F.to_json(record).cast("binary"))
