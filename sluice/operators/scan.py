"""Reads of the rollup store: by key and prefix, by range, newest N rows, next page.

The store has typed columns next to its text keys. Filters go on the typed ones
(grain, period, event_date are its partition columns), because a prefix test on
a text key can prune neither partitions nor Parquet row groups.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.keys import sort_key_time
from sluice.functions.time import local_time, parse_time
from sluice.schema import STORE_KPIS

ITEM = ["pk", "sk", *STORE_KPIS, "n_rec", "event_time", "ingest_time"]
NEWEST_FIRST = ["event_time", "ingest_time"]


def by_key(store: DataFrame, region: str, state: str | None = None, store_id: int | None = None) -> DataFrame:
    """Rows of one partition key. A key that does not exist gives no rows."""
    found = store.filter(F.col("region") == region)
    if store_id is not None:
        return found.filter((F.col("grain") == "STORE") & (F.col("state") == state) & (F.col("store_id") == store_id))
    if state:
        return found.filter((F.col("grain") == "STATE") & (F.col("state") == state))
    return found.filter(F.col("grain") == "REGION")


def by_period(rows: DataFrame, period: str, day: str | None = None) -> DataFrame:
    """Rows of one period, and of one day of event time if given."""
    rows = rows.filter(F.col("period") == period)
    if day:
        rows = rows.filter(on_day(day))
        if "event_date" in rows.columns:
            rows = rows.filter(F.col("event_date") == date.fromisoformat(day))
    return rows


def on_day(day: str) -> Column:
    start = datetime.fromisoformat(day)
    t = F.col("event_time")
    return (t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(start + timedelta(days=1)).cast("timestamp_ntz"))


def by_prefix(rows: DataFrame, pk: str, prefix: str) -> DataFrame:
    """Rows of one key whose sort key begins with a text; for key spaces that have no typed columns."""
    return rows.filter((F.col("pk") == pk) & F.col("sk").startswith(prefix))


def by_range(rows: DataFrame, pk: str, first: str, last: str) -> DataFrame:
    """Rows of one key with a sort key from ``first`` to ``last``, both included."""
    return rows.filter((F.col("pk") == pk) & F.col("sk").between(first, last))


def keys_only(rows: DataFrame) -> DataFrame:
    return rows.select("pk", "sk")


def newest(rows: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` rows of one key: a top-k, so no task ever sorts more than its own rows."""
    return rows.orderBy(*[F.desc(c) for c in NEWEST_FIRST]).limit(n)


def newest_per_key(rows: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` rows of every key and period. Each task cuts to ``n`` per key before the shuffle."""
    w = Window.partitionBy("pk", "period").orderBy(*[F.desc(c) for c in NEWEST_FIRST])
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).drop("rank")


class Cursor(NamedTuple):
    """A place in the descending order of a key's rows: period, event time and arrival time of a sort key."""

    period: str
    event_time: datetime
    ingest_time: datetime

    @staticmethod
    def of(sk: str) -> Cursor:
        period, event, arrival = sk.split("#")
        return Cursor(period, datetime.fromisoformat(event), datetime.fromisoformat(arrival))

    def later(self) -> Column:
        """Rows that come after this place. Bounds on typed columns, so that they prune partitions and row groups; rows of
        one event time, at a page's border, are told apart by their arrival."""
        event, arrival = (F.lit(t).cast("timestamp_ntz") for t in (self.event_time, self.ingest_time))
        here = (F.col("event_time") < event) | ((F.col("event_time") == event) & (F.col("ingest_time") < arrival))
        return (F.col("period") < self.period) | ((F.col("period") == self.period) & here)


#: The order of sort keys, on typed columns.
SORT_KEY = ["period", "event_time", "ingest_time"]


def page_after(rows: DataFrame, last_sk: str | None, n: int) -> DataFrame:
    """Next page of one key in descending order of the sort key; ``last_sk`` is the last key of the page before."""
    if last_sk is not None:
        cursor = Cursor.of(last_sk)
        rows = rows.filter(cursor.later())
        if "event_date" in rows.columns:
            rows = rows.filter((F.col("period") < cursor.period) | (F.col("event_date") <= cursor.event_time.date()))
    return rows.orderBy(*[F.desc(c) for c in SORT_KEY]).limit(n)


def newer_than(rows: DataFrame, cutoff: str) -> DataFrame:
    """Rows that arrived at ``cutoff`` or later."""
    return rows.filter(_arrived_since(cutoff))


def newer_than_stats(rows: DataFrame, cutoff: str) -> DataFrame:
    """Per key: rows parsed, rows that pass the cutoff, and distinct arrival times among those."""
    passes = _arrived_since(cutoff)
    return rows.groupBy("pk").agg(
        F.count("*").alias("records_parsed"),
        F.count_if(passes).alias("records_returned"),
        F.count_distinct(F.when(passes, F.col("ingest_time"))).alias("records_kept"),
    )


def _arrived_since(cutoff: str) -> Column:
    return F.col("ingest_time") >= F.lit(datetime.fromisoformat(cutoff)).cast("timestamp_ntz")


def newest_per_arrival(rows: DataFrame, measures: list[str]) -> DataFrame:
    """One row per key, period and arrival bucket: the one with the greatest sort key.

    Within such a group the sort keys differ in event time only, so that is what
    decides. Every ``max_by`` then has fixed-width state, which keeps this a hash
    aggregation with a partial step before the shuffle.
    """
    return rows.groupBy("pk", "period", "ingest_time").agg(
        *[F.max_by(m, "event_time").alias(m) for m in measures], F.max("event_time").alias("event_time")
    )


def kpi_value(rows: DataFrame, kpi: str) -> DataFrame:
    """One KPI, chosen by name, with the time of its sort key in UTC and in local time."""
    if kpi not in STORE_KPIS:
        raise ValueError(f"unknown KPI {kpi!r}, expected one of {STORE_KPIS}")
    utc = parse_time(sort_key_time(F.col("sk")))
    return rows.select(
        "pk",
        "sk",
        utc.cast("timestamp_ntz").alias("time_utc"),
        local_time(utc).cast("timestamp_ntz").alias("time_local"),
        F.col(kpi).alias("value"),
    )


def series(rows: DataFrame, kpis: list[str], name: str) -> DataFrame:
    """Chart form: one row per point and KPI, named like ``NORTH - KPI1``."""
    return rows.unpivot(["pk", "sk", "ingest_time"], kpis, "kpi", "value").select(
        "pk", "sk", "ingest_time", F.concat(F.lit(f"{name} - "), F.upper("kpi")).alias("series"), "value"
    )


def in_sets(
    df: DataFrame, sets: dict[str, list[str]], time_column: str, first_year: int, last_year: int
) -> DataFrame:
    """Rows whose columns lie in the given sets, strictly between January 1 of two years."""
    for column, values in sets.items():
        df = df.filter(F.col(column).isin(values))
    t = F.col(time_column)
    after, before = (F.lit(datetime(y, 1, 1)).cast("timestamp_ntz") for y in (first_year, last_year))
    return df.filter((t > after) & (t < before))
