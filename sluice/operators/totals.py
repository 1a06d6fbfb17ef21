"""Totals for the dashboard and for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.numbers import thousands
from sluice.functions.time import DAY_KEY
from sluice.operators.scan import newest_per_arrival, newest_per_key, on_day
from sluice.schema import DASHBOARD_KPIS, STORE_KPIS


def dashboard_totals(store: DataFrame, n: int = 200) -> DataFrame:
    """Per key and period: sums of four KPIs over the newest ``n`` rows, as numbers and as text."""
    summed = (
        newest_per_key(store, n)
        .groupBy("pk", "period")
        .agg(*[F.sum(k).alias(f"{k}_sum") for k in DASHBOARD_KPIS])
    )
    return summed.withColumns({f"{k}_text": thousands(F.col(f"{k}_sum")) for k in DASHBOARD_KPIS})


def day_and_month(store: DataFrame, day: str) -> DataFrame:
    """KPI sums per key: ten-minute rows of the day plus hourly rows of the other days."""
    picked = store.filter(
        ((F.col("period") == "PT10M") & on_day(day)) | ((F.col("period") == "PT1H") & ~on_day(day))
    )
    return picked.groupBy("pk").agg(*[F.sum(k).alias(k) for k in DASHBOARD_KPIS])


def day_and_month_overlapping(store: DataFrame, day: str) -> DataFrame:
    """As above, but with the hourly rows of all days and one row per arrival bucket.

    This counts the day twice and leaves late rows out; kept for equal numbers.
    """
    # The period is part of what one row is kept for, so both kinds go through one aggregation.
    picked = store.filter(((F.col("period") == "PT10M") & on_day(day)) | (F.col("period") == "PT1H"))
    return newest_per_arrival(picked, DASHBOARD_KPIS).groupBy("pk").agg(*[F.sum(k).alias(k) for k in DASHBOARD_KPIS])


def per_day(rows: DataFrame) -> DataFrame:
    """Sums of every KPI per key and arrival day; a missing KPI counts as 0."""
    kpis = [c for c in rows.columns if c.startswith("kpi")]
    summed = rows.groupBy("pk", F.col("ingest_time").cast("date").alias("day")).agg(
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kpis]
    )
    return summed.withColumn("day", F.date_format("day", DAY_KEY))


def per_day_dynamic(rows: DataFrame, attributes: str) -> DataFrame:
    """Same for KPIs that are held in a map column; one row per key, day and KPI."""
    return (
        rows.select("pk", F.col("ingest_time").cast("date").alias("day"), F.explode(attributes).alias("kpi", "v"))
        .filter(F.col("kpi").startswith("kpi"))
        .groupBy("pk", "day", "kpi")
        .agg(F.coalesce(F.sum("v"), F.lit(0)).alias("value"))
        .withColumn("day", F.date_format("day", DAY_KEY))
    )


def region_totals(rows: DataFrame) -> DataFrame:
    """Sums of four KPIs and the number of rows per region."""
    return rows.groupBy("region").agg(
        *[F.sum(STORE_KPIS[i]).alias(f"{STORE_KPIS[i]}_sum") for i in (3, 0, 1, 4)],
        F.count("*").alias("recs"),
    )
