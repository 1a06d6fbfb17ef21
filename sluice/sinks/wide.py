"""Inserts of plain and of wide KPI records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: item attribute <- record field ---
WIDE_NAMES = {
    "kpi_1": "kpi_2",
    "kpi_2": "kpi_3",
    "TicketMedio": "kpi_4",
    "FatBruto": "kpi_5",
    "kpi_6": "kpi_6",
    "kpi_7": "kpi_7",
    "QtdAtendimentos": "kpi_8",
    "ValorTotal": "kpi_9",
}


def _wide(records: DataFrame, sk: Column, carried: tuple[str, ...]) -> DataFrame:
    return records.select(
        *carried,
        F.col("kpi_1").cast("string").alias("pk"),
        sk.alias("sk"),
        *[F.col(field).alias(name) for name, field in WIDE_NAMES.items()],
    )


def month_records(records: DataFrame, *carried: str) -> DataFrame:
    """Items of month records; the record's first KPI is the key."""
    return _wide(records, F.concat_ws("#", F.lit("PT10M"), "month"), carried)


def minute_records(records: DataFrame, *carried: str) -> DataFrame:
    return _wide(records, F.concat_ws("#", F.lit("m"), "minute"), carried)


def append(records: DataFrame, path: str) -> None:
    """Plain insert."""
    records.write.mode("append").parquet(path)
