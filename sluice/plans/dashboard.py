"""Dashboard queries: from the event table to rollups, store items and served results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.numbers import json_float, json_int
from sluice.functions.time import period_for_label, period_of_label
from sluice.operators import intake, scan, totals
from sluice.operators import rollup as ru
from sluice.schema import DASHBOARD_KPIS, GRAINS, MONEY, PERIODS, STORE_KPIS, region_dimension
from sluice.session import scratch_folder
from sluice.sinks import store, versions
from sluice.sinks.wide import append, minute_records, month_records
from sluice.sources import tables

# Parameters of the single-key queries. They pick a key and a day that hold rows
# in every test data size; the store's queries take any other values.
REGION, STATE, STORE = "NORTHEAST", "BA", 10
DAY = "2024-01-15"
CUTOFF = "2024-01-20 02:00:00"
PAGE_START = "PT10M#2024-01-20 00:00:00.000#2024-01-20 00:00:00.000"

Query = Callable[[SparkSession, str], DataFrame]


#: Stores of folders of events, by application.
_stores: dict[tuple[str, str], str] = {}


def served(spark: SparkSession, folder: str) -> str:
    """The store of a folder's events, with its calendar tables; filled once by an application."""
    key = spark.sparkContext.applicationId, folder
    if key not in _stores or not versions.numbers(spark, _stores[key]):
        path = scratch_folder(spark, "served")
        store.write_rollups(tables.kpi_events(spark, folder), path, batch="events")
        store.refresh(spark, path)
        _stores[key] = path
    return _stores[key]


def _items(spark: SparkSession, folder: str, grain: str, period: str, day: str | None = None) -> DataFrame:
    """Store items of one grain and period; of one day of event time if given."""
    return ru.keyed(ru.rollup(tables.kpi_events(spark, folder, day), grain, period))


def _all_items(spark: SparkSession, folder: str) -> DataFrame:
    return ru.keyed(ru.rollup_all(tables.kpi_events(spark, folder)))


def _single(grain: str, period: str) -> Query:
    return lambda spark, folder: ru.rollup(tables.kpi_events(spark, folder), grain, period).select(*ru.ROLLUP)


def _tens(grain: str) -> Query:
    return lambda spark, folder: ru.rollup_10s(tables.kpi_events(spark, folder), grain)


def rollup_all(spark: SparkSession, folder: str) -> DataFrame:
    return ru.rollup_all(tables.kpi_events(spark, folder)).select(*ru.ROLLUP)


def keyed_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _all_items(spark, folder)


def classify(spark: SparkSession, folder: str) -> DataFrame:
    return intake.classify(tables.wire_records(spark, folder), "event_id")


def dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    return intake.dead_letters(classify(spark, folder)).drop("grain")


def load_stats(spark: SparkSession, folder: str) -> DataFrame:
    return intake.load_stats(classify(spark, folder))


def prefix_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan.by_key(store.read_settled(spark, served(spark, folder), None, DAY, DAY), REGION, STATE)
    return scan.by_period(rows, "PT1H", DAY).select(*scan.ITEM)


def range_scan(spark: SparkSession, folder: str) -> DataFrame:
    return store.calendar_scan(spark, served(spark, folder), REGION, "SLOT#2024-01-10_00:00", "SLOT#2024-01-12_23:59")


def scan_day(spark: SparkSession, folder: str) -> DataFrame:
    return store.calendar_scan(spark, served(spark, folder), REGION, "D#")


def scan_month(spark: SparkSession, folder: str) -> DataFrame:
    return store.calendar_scan(spark, served(spark, folder), REGION, "M#")


def key_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan.keys_only(_all_items(spark, folder))


def latest_store(spark: SparkSession, folder: str) -> DataFrame:
    return scan.kpi_value(store.newest_items(spark, served(spark, folder), "PT1M", 15, REGION, STATE, STORE), "kpi1")


def _of_day(spark: SparkSession, folder: str, period: str, state: str | None = None) -> DataFrame:
    rows = scan.by_key(store.read_settled(spark, served(spark, folder), None, DAY, DAY), REGION, state)
    return scan.by_period(rows, period, DAY)


def latest_state(spark: SparkSession, folder: str) -> DataFrame:
    return scan.kpi_value(scan.newest(_of_day(spark, folder, "PT10M", STATE), 15), "kpi1")


def latest_region(spark: SparkSession, folder: str) -> DataFrame:
    return scan.kpi_value(scan.newest(_of_day(spark, folder, "PT1H"), 15), "kpi1")


def page_after(spark: SparkSession, folder: str) -> DataFrame:
    return store.newest_items(spark, served(spark, folder), "PT10M", 100, REGION, STATE, before=PAGE_START).select(*scan.ITEM)


def kpi_rows(spark: SparkSession, folder: str) -> DataFrame:
    kept = scan.newest_per_arrival(_of_day(spark, folder, "PT10M", STATE), DASHBOARD_KPIS)
    return kept.select("pk", "ingest_time", *DASHBOARD_KPIS)


def newer_than(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan.by_key(_items(spark, folder, "REGION", "PT1M"), REGION)
    kept = scan.newest_per_arrival(scan.newer_than(rows, CUTOFF), [*STORE_KPIS, "n_rec"])
    return kept.orderBy("event_time", "ingest_time")


def newer_than_stats(spark: SparkSession, folder: str) -> DataFrame:
    return scan.newer_than_stats(_items(spark, folder, "REGION", "PT1M"), CUTOFF)


def dedup_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return scan.newest_per_arrival(_all_items(spark, folder), [*STORE_KPIS, "n_rec"])


def _served(spark: SparkSession, folder: str, periods: list[str]) -> DataFrame:
    """Region and state items of some periods, as the dashboard reads them."""
    rows = store.read_settled(spark, served(spark, folder))
    return rows.where(F.col("grain").isin("REGION", "STATE") & F.col("period").isin(periods))


def dashboard_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Of every key only the days that the counts say hold its newest rows."""
    starts = store.starts(spark, served(spark, folder), 200, ["REGION", "STATE"])
    rows = _served(spark, folder, list(PERIODS)).join(starts, ["pk", "period"]).where("event_date >= start")
    return totals.dashboard_totals(rows, 200)


def chart_series(spark: SparkSession, folder: str) -> DataFrame:
    rows = store.newest_items(spark, served(spark, folder), period_for_label("10-Minute"), 200, REGION, STATE)
    return scan.series(rows, DASHBOARD_KPIS, REGION)


def kpi_day_month(spark: SparkSession, folder: str) -> DataFrame:
    return totals.day_and_month(_served(spark, folder, ["PT10M", "PT1H"]), DAY)


def kpi_day_month_compat(spark: SparkSession, folder: str) -> DataFrame:
    return totals.day_and_month_overlapping(_served(spark, folder, ["PT10M", "PT1H"]), DAY)


def daily_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return totals.per_day(_items(spark, folder, "REGION", "PT1M"))


def daily_kpis_map(spark: SparkSession, folder: str) -> DataFrame:
    """The items' attributes as a map, as a schemaless store holds them."""
    names = [*STORE_KPIS, "n_rec"]
    attributes = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*names))
    rows = _items(spark, folder, "REGION", "PT1M").withColumn("attributes", attributes)
    return totals.per_day_dynamic(rows, "attributes")


def region_totals(spark: SparkSession, folder: str) -> DataFrame:
    return totals.region_totals(_items(spark, folder, "REGION", "PT1M"))


def local_time(spark: SparkSession, folder: str) -> DataFrame:
    return scan.kpi_value(_items(spark, folder, "REGION", "PT1H"), "kpi1")


def date_keys(spark: SparkSession, folder: str) -> DataFrame:
    return tables.wide_records(spark, folder).select("event_id", "month", "day", "minute")


def region_states(spark: SparkSession, folder: str) -> DataFrame:
    """States to choose from in every region, with the number of events each one has."""
    seen = tables.kpi_events(spark, folder).groupBy("region", "state").agg(F.count("*").alias("n"))
    return (
        region_dimension(spark)
        .join(seen, ["region", "state"], "left")
        .select("region", "state", F.coalesce("n", F.lit(0)).alias("n_events"))
    )


def filter_sets(spark: SparkSession, folder: str) -> DataFrame:
    return scan.in_sets(
        tables.table(spark, folder, "orders"),
        {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH"]},
        "o_orderdate",
        1996,
        1998,
    )


def json_number(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("c_acctbal").cast(MONEY)
    return tables.table(spark, folder, "customer").select(
        "c_custkey",
        json_int(amount).alias("as_int"),
        json_float(amount).alias("as_float"),
        amount.cast("double").alias("always_float"),
    )


def wide_month(spark: SparkSession, folder: str) -> DataFrame:
    return month_records(tables.wide_records(spark, folder), "event_id")


def wide_minute(spark: SparkSession, folder: str) -> DataFrame:
    return minute_records(tables.wide_records(spark, folder), "event_id")


def label_periods(spark: SparkSession, folder: str) -> DataFrame:
    """The period that each event's dashboard label asks for."""
    turn = F.col("event_id") % 4
    label = F.when(turn == 0, "Hours").when(turn == 1, "10-Minute").when(turn == 2, "Minutes")
    return tables.table(spark, folder, "events").select("event_id", period_of_label(label).alias("period"))


def plain_insert(spark: SparkSession, folder: str) -> DataFrame:
    """Wide records inserted in two steps, read back."""
    path, records = scratch_folder(spark, "wide"), wide_minute(spark, folder)
    for half in (0, 1):
        append(records.where(F.col("event_id") % 2 == half), path)
    return spark.read.schema(records.schema).parquet(path)


def placed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events written by place, and those of one state read back."""
    path = scratch_folder(spark, "places")
    store.write_by_place(tables.kpi_events(spark, folder), path)
    return spark.read.parquet(path).where((F.col("region") == REGION) & (F.col("state") == STATE)).select("event_id", "region", "state", "store_id", "kpi_1")


QUERIES: dict[str, Query] = {
    **{f"rollup_{g.lower()}_{p.lower()}": _single(g, p) for p in PERIODS for g in GRAINS},
    **{f"rollup_10s_{g.lower()}": _tens(g) for g in GRAINS},
    **{
        f.__name__: f
        for f in (
            rollup_all, keyed_rollup, classify, dead_letter, load_stats, prefix_scan, range_scan, scan_day,
            scan_month, key_scan, latest_store, latest_state, latest_region, page_after, kpi_rows, newer_than,
            newer_than_stats, dedup_ingest, dashboard_totals, chart_series, kpi_day_month,
            kpi_day_month_compat, daily_kpis, daily_kpis_map, region_totals, local_time, date_keys,
            region_states, filter_sets, json_number, wide_month, wide_minute, label_periods, plain_insert,
            placed_events,
        )
    },
}
