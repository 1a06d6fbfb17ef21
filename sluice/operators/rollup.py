"""KPI rollups over two clocks: arrival time and event time, both cut to the same width.

A late event is never dropped. It falls into its old event bucket and into the
current arrival bucket, which gives one more partial row; readers add them up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.keys import partition_key, sort_key
from sluice.functions.time import border, period_seconds, step_seconds
from sluice.schema import GRAINS, KPI_SUMS, KPIS, NO_STATE, NO_STORE, PERIODS, STORE_KPIS

DIMENSIONS = GRAINS["STORE"]

#: Columns of a rollup row; jobs also carry ``grain`` and ``period``, the parts of ``type``.
ROLLUP = ["type", "region", "state", "store_id", *KPI_SUMS, "n_rec", "ingest_time", "event_time"]


def sums(columns: list[str] = KPIS, count: Column | None = None) -> list[Column]:
    """Sum of each KPI, plus the record count."""
    named = [F.sum(c).alias(out) for c, out in zip(columns, KPI_SUMS)]
    return [*named, (F.count("*") if count is None else F.sum(count)).alias("n_rec")]


def minutes(events: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Events added up per store, arrival minute and event minute; clocks as epoch seconds.

    This is the finest rollup, and all others can be made from it: minutes nest
    in ten minutes and hours, and sums and counts are decomposable. Every event
    is touched once here, so the nine-fold expansion of :func:`rollup_all` works
    on sums instead of raw events.
    """
    return events.groupBy(
        *dims,
        step_seconds(F.unix_seconds("ingest_time"), 60).alias("ingest_sec"),
        step_seconds(F.unix_seconds("event_time"), 60).alias("event_sec"),
    ).agg(*sums())


def rollup_rows(
    grouped: DataFrame, grain: Column, period: Column, state: Column, store: Column, arrival: Column
) -> DataFrame:
    """Rollup rows from groups; ``arrival`` is the start of the arrival bucket."""
    return grouped.select(
        F.concat(F.lit("BY_"), grain, F.lit("_"), period).alias("type"),
        grain.alias("grain"),
        period.alias("period"),
        "region",
        state.alias("state"),
        store.cast("int").alias("store_id"),
        *KPI_SUMS,
        "n_rec",
        border(arrival).alias("ingest_time"),
        border(F.timestamp_seconds("event_sec")).alias("event_time"),
    )


def rollup(events: DataFrame, grain: str, period: str) -> DataFrame:
    """One of the nine rollups, in one aggregation."""
    width = period_seconds(period)
    grouped = events.groupBy(
        *GRAINS[grain],
        step_seconds(F.unix_seconds("ingest_time"), width).alias("ingest_sec"),
        step_seconds(F.unix_seconds("event_time"), width).alias("event_sec"),
    ).agg(*sums())
    state = F.lit(NO_STATE) if grain == "REGION" else F.col("state")
    store = F.col("store_id") if grain == "STORE" else F.lit(NO_STORE)
    return rollup_rows(grouped, F.lit(grain), F.lit(period), state, store, F.timestamp_seconds("ingest_sec"))


def rollup_all(
    events: DataFrame,
    grains: Sequence[str] = tuple(GRAINS),
    periods: Sequence[str] = tuple(PERIODS),
    from_minutes: bool = True,
) -> DataFrame:
    """All nine rollups, or those of some grains and periods, in one pass over the events.

    With ``from_minutes`` events are first added up per store and minute. That
    costs one more (small) shuffle and saves expanding every event nine times,
    which pays off as soon as a store has several events per minute.
    """
    dims = max((GRAINS[g] for g in grains), key=len)
    if from_minutes:
        base = minutes(events, dims)
        measures = sums(KPI_SUMS, F.col("n_rec"))
    else:
        base = events.withColumns(
            {"ingest_sec": F.unix_seconds("ingest_time"), "event_sec": F.unix_seconds("event_time")}
        )
        measures = sums()
    width = F.col("width")
    clocks = ["width", "ingest_sec", "event_sec"]
    grouped = (
        base.withColumn("width", F.explode(F.array(*[F.lit(period_seconds(p)) for p in periods])))
        .withColumn("ingest_sec", step_seconds(F.col("ingest_sec"), width))
        .withColumn("event_sec", step_seconds(F.col("event_sec"), width))
        .groupingSets([[*clocks, *GRAINS[g]] for g in grains], *clocks, *dims)
        .agg(*measures, *[F.grouping(d).alias(f"no_{d}") for d in dims])
    )
    has = {d: (F.col(f"no_{d}") == 0) if d in dims else F.lit(False) for d in DIMENSIONS}
    grain = F.when(has["store_id"], "STORE").when(has["state"], "STATE").otherwise("REGION")
    period = F.coalesce(*[F.when(width == period_seconds(p), p) for p in periods])
    state = F.when(has["state"], F.col("state")).otherwise(NO_STATE) if "state" in dims else F.lit(NO_STATE)
    store = F.when(has["store_id"], F.col("store_id")).otherwise(NO_STORE) if "store_id" in dims else F.lit(NO_STORE)
    return rollup_rows(grouped, grain, period, state, store, F.timestamp_seconds("ingest_sec"))


def rollup_10s(events: DataFrame, grain: str) -> DataFrame:
    """Two-KPI rollup per arrival minute and 10-second arrival bucket.

    The bucket is grouped by but not shown, so a minute has up to six rows.
    """
    dims = GRAINS[grain]
    second = F.unix_seconds("ingest_time")
    return (
        events.groupBy(*dims, step_seconds(second, 60).alias("minute"), step_seconds(second, 10).alias("bucket"))
        .agg(F.sum("kpi_1").alias("kpi_1_sum"), F.sum("kpi_2").alias("kpi_2_sum"))
        .select(*dims, "kpi_1_sum", "kpi_2_sum", border(F.timestamp_seconds("minute")).alias("ingest_time"))
    )


def keyed(rollups: DataFrame) -> DataFrame:
    """Rollup rows as items of the rollup store: typed columns plus the two text keys."""
    return rollups.select(
        partition_key(F.col("grain"), F.col("region"), F.col("state"), F.col("store_id")).alias("pk"),
        sort_key(F.col("period"), F.col("event_time"), F.col("ingest_time")).alias("sk"),
        "type",
        "grain",
        "period",
        "region",
        "state",
        "store_id",
        *[F.col(a).alias(b) for a, b in zip(KPI_SUMS, STORE_KPIS)],
        "n_rec",
        "ingest_time",
        "event_time",
    )


def calendar_rollup(events: DataFrame, grain: str, key_space: str, unit: str, date_format: str) -> DataFrame:
    """Sums per key and calendar unit of event time, under a key such as ``D#2024-01-05``.

    Groups by the truncated time and turns it into text afterwards, once per group.
    """
    dims = GRAINS[grain]
    grouped = events.groupBy(*dims, F.date_trunc(unit, "event_time").alias("unit")).agg(*sums())
    state = F.col("state") if "state" in dims else F.lit(NO_STATE)
    store = F.col("store_id") if "store_id" in dims else F.lit(NO_STORE)
    return grouped.select(
        partition_key(F.lit(grain), F.col("region"), state, store).alias("pk"),
        F.concat_ws("#", F.lit(key_space), F.date_format("unit", date_format)).alias("sk"),
        *[F.col(a).alias(b) for a, b in zip(KPI_SUMS, STORE_KPIS)],
        "n_rec",
    )
