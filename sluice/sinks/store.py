"""The rollup store: rollup rows by day of event time, grain and period, with calendar tables made from them.

Writers add partial rows, a part for each batch; readers add them up. Compaction replaces the parts of a day by one whose
rows are settled. Which parts are live is kept in versions (``versions``), so every change is seen as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.keys import key_value
from sluice.functions.time import DAY_KEY, MINUTE_KEY, MONTH_KEY
from sluice.operators.rollup import keyed, rollup_all
from sluice.operators.scan import Cursor, by_key, by_period, by_prefix, by_range, newest, page_after
from sluice.schema import GRAINS, PERIODS, STORE_KPIS, columns
from sluice.session import apart, shuffled_for
from sluice.sinks import versions
from sluice.sinks.versions import Version
from sluice.sources.records import event_record

ROLLUPS = "rollups"
#: The table's partition columns; the first one is the place of a part.
PARTITIONS = ["event_date", "grain", "period"]
MEASURES = [*STORE_KPIS, "n_rec"]
SETTLED = "settled"

ITEM = columns(
    "pk string, sk string, type string, region string, state string, store_id int, "
    + ", ".join(f"{m} bigint" for m in MEASURES)
    + ", ingest_time timestamp_ntz, event_time timestamp_ntz, writer string, batch string, event_date date, grain string, period string"
)


def with_date(items: DataFrame) -> DataFrame:
    return items.withColumn("event_date", F.col("event_time").cast("date"))


def write_items(items: DataFrame, path: str, writer: str, batch: str) -> dict[str, str]:
    """Writes items as parts that are not live yet."""
    # The rebalance hint makes few, well-sized files per table partition, and lets AQE split a table partition that is much
    # larger than the others. Rows are sorted by key, so Parquet statistics skip row groups of other keys.
    rows = with_date(items).hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "pk", "event_time", "ingest_time")
    return versions.write_parts(rows, path, ROLLUPS, PARTITIONS, writer, batch)


def batch_of(folder: str) -> tuple[str, str]:
    """Writer and batch of a part's folder."""
    _, writer, batch = folder.split("/")
    return writer.removeprefix("writer="), batch.removeprefix("batch=").rpartition("-")[0]


def write_store(items: DataFrame, path: str, writer: str = "batch", batch: str | int | None = None) -> None:
    """Adds items to the store, as one version.

    A batch with a number follows the ones before it; delivered again, it is left out. A batch with a name is replaced when
    it is written again, unless compaction has taken it up. Without either it is added.
    """
    spark, label = items.sparkSession, uuid.uuid4().hex if batch is None else str(batch)
    if not is_done(versions.load(spark, path), writer, batch):
        added = write_items(items, path, writer, label)
        versions.commit(spark, path, lambda now: added_to(now, writer, batch, {ROLLUPS: added}))


def write_rollups(events: DataFrame, path: str, writer: str = "batch", batch: str | int | None = None) -> None:
    """Adds all rollups of events to the store, as one version."""
    with shuffled_for(events.sparkSession, events.count() * len(GRAINS) * len(PERIODS)):
        write_store(keyed(rollup_all(events)), path, writer, batch)


def is_done(now: Version, writer: str, batch: str | int | None) -> bool:
    return isinstance(batch, int) and now.done.get(writer, -1) >= batch


def added_to(now: Version, writer: str, batch: str | int | None, tables: dict[str, dict[str, str]]) -> Version | None:
    """The version with a batch's parts of some tables; None if the batch is there already."""
    if is_done(now, writer, batch):
        return None
    if f"{writer}/{batch}" in now.merged:
        raise ValueError(f"batch {batch!r} of {writer!r} is compacted and cannot be replaced")
    for table, added in tables.items():
        now = now.with_parts(table, added, lambda place, folder: isinstance(batch, str) and batch_of(folder) == (writer, batch))
    return replace(now, done={**now.done, writer: batch}) if isinstance(batch, int) else now


def read_store(spark: SparkSession, path: str, version: int | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of the store as they were written, of days from ``first`` to ``last``, by default of its newest version."""
    folders = versions.load(spark, path, version).folders(ROLLUPS)
    return _rows(spark, path, versions.within(folders, first, last))


def _rows(spark: SparkSession, path: str, folders: dict[str, list[str]]) -> DataFrame:
    return versions.read_parts(spark, path, ROLLUPS, ITEM, PARTITIONS[0], folders)


def settled(items: DataFrame) -> DataFrame:
    """Items of the store with the partial rows of a key added up."""
    keys = [c for c in items.columns if c not in (*MEASURES, "writer", "batch", "event_date")]
    return apart(items, *keys).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def read_settled(spark: SparkSession, path: str, version: int | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """Settled rows with their ``event_date``. Days of one part have settled rows, as every writer adds up its own; only the
    others are added up here."""
    folders = versions.within(versions.load(spark, path, version).folders(ROLLUPS), first, last)
    one = _rows(spark, path, {p: f for p, f in folders.items() if len(f) == 1}).drop("writer", "batch")
    many = {p: f for p, f in folders.items() if len(f) > 1}
    return one.unionByName(with_date(settled(_rows(spark, path, many)))) if many else one


def compact(spark: SparkSession, path: str, parts: int = 2) -> Version:
    """Settles the days that have ``parts`` parts or more into one part each. Parts that come meanwhile stay beside it."""
    before = versions.load(spark, path)
    old = {p: f for p, f in before.folders(ROLLUPS).items() if len(f) >= parts}
    if not old:
        return before
    added = write_items(settled(_rows(spark, path, old)), path, SETTLED, f"v{before.number}")

    def switch(now: Version) -> Version | None:
        if any(not set(f) <= set(now.folders(ROLLUPS).get(p, [])) for p, f in old.items()):
            return None  # someone else has changed these days; what was written is never live
        after = now.with_parts(ROLLUPS, added, lambda place, folder: folder in old.get(place, []))
        names = {"/".join(batch_of(f)) for own in old.values() for f in own}
        names = {n for n in names if n.partition("/")[0] not in (*now.done, SETTLED)}
        # Days whose calendar rows were made from the same rows need no new ones.
        calendar = {p: after.folders(ROLLUPS)[p] if p in old and f == now.folders(ROLLUPS)[p] else f for p, f in now.calendar.items()}
        return replace(after, merged=sorted({*now.merged, *names}), calendar=calendar)

    return versions.commit(spark, path, switch)


def purge_range(spark: SparkSession, path: str, region: str, state: str | None = None, first: str | None = None, last: str | None = None) -> Version:
    """Removes all rows of a region, or of a state of it, whose day of event time is from ``first`` to ``last``.

    Only the days that hold such rows are written again; all other parts stay as they are, and a reader of an earlier version
    reads on. Calendar rows of these days are made again by the next ``refresh``.
    """
    here = F.col("region") == region
    if state is not None:
        here &= F.col("state") == state
    before = versions.load(spark, path)
    candidates = versions.within(before.folders(ROLLUPS), first, last)
    met = _rows(spark, path, candidates).where(here).select("event_date").distinct().collect()
    old = {str(r["event_date"]): candidates[str(r["event_date"])] for r in met}
    if not old:
        return before
    added = write_items(settled(_rows(spark, path, old).where(~F.coalesce(here, F.lit(False)))), path, SETTLED, f"v{before.number}")

    def switch(now: Version) -> Version:
        if any(f != now.folders(ROLLUPS).get(p) for p, f in old.items()):
            raise RuntimeError("the days to purge were changed meanwhile; purge again")
        after = now.with_parts(ROLLUPS, added, lambda place, folder: folder in old.get(place, []))
        names = {"/".join(batch_of(f)) for own in old.values() for f in own}
        return replace(after, merged=sorted({*now.merged, *(n for n in names if n.partition("/")[0] not in (*now.done, SETTLED))}))

    return versions.commit(spark, path, switch)


# Calendar tables: rows per key and slot (minute), day and month, and how many rows a key has on a day.

#: Table: its first partition column, the key space, and the date format of the sort key.
CALENDAR = {"slots": ("day", "SLOT", MINUTE_KEY), "days": ("month", "D", DAY_KEY), "months": ("year", "M", MONTH_KEY)}
CALENDAR_ROW = columns(
    "pk string, sk string, unit timestamp_ntz, " + ", ".join(f"{m} bigint" for m in MEASURES) + ", writer string, batch string, grain string"
)
COUNTS = "counts"
COUNT_ROW = columns("pk string, n bigint, writer string, batch string, event_date date, grain string, period string")


def _calendar(spark: SparkSession, path: str, table: str, folders: dict[str, list[str]]) -> DataFrame:
    column = CALENDAR[table][0]
    schema = T.StructType([*CALENDAR_ROW.fields[:-1], T.StructField(column, T.StringType()), CALENDAR_ROW.fields[-1]])
    return versions.read_parts(spark, path, table, schema, column, folders)


def _per_unit(rows: DataFrame, table: str, unit: Column) -> DataFrame:
    column, space, form = CALENDAR[table]
    summed = rows.groupBy("grain", "pk", unit.alias("unit")).agg(*[F.sum(m).alias(m) for m in MEASURES])
    place = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[column]
    return summed.withColumns({"sk": F.concat_ws("#", F.lit(space), F.date_format("unit", form)), column: F.date_format("unit", place)})


def _write_calendar(rows: DataFrame, path: str, table: str, batch: str) -> dict[str, str]:
    column = CALENDAR[table][0]
    sorted_rows = rows.select("pk", "sk", "unit", *MEASURES, column, "grain").hint("rebalance", column, "grain").sortWithinPartitions(column, "grain", "pk", "unit")
    return versions.write_parts(sorted_rows, path, table, [column, "grain"], "calendar", batch)


def stale_days(now: Version) -> list[str]:
    """Days with rows that the calendar tables do not have yet, or no longer have."""
    live = now.folders(ROLLUPS)
    return sorted(p for p in {*live, *now.calendar} if live.get(p) != now.calendar.get(p))


def refresh(spark: SparkSession, path: str, grains: Sequence[str] = ("REGION", "STATE")) -> Version:
    """Brings the calendar tables up to date: slots and counts of the days that changed, from the store; the months of these
    days, from their other days' rows and these; the years of these months likewise."""
    now = versions.load(spark, path)
    days = stale_days(now)
    if not days:
        return now
    live, batch = now.folders(ROLLUPS), f"v{now.number}"
    rows = _rows(spark, path, {p: live[p] for p in days if p in live})
    minutes = rows.where((F.col("period") == "PT1M") & F.col("grain").isin(list(grains)))
    written = {"slots": _write_calendar(_per_unit(minutes, "slots", F.col("event_time")), path, "slots", batch)}
    slots = _calendar(spark, path, "slots", {p: [f] for p, f in written["slots"].items()})

    finer, touched = slots, {"days": days, "months": sorted({d[:7] for d in days})}
    for table, width, unit in (("days", 7, "day"), ("months", 4, "month")):
        units = touched[table]
        places = sorted({u[:width] for u in units})
        own = now.folders(table)
        others = _calendar(spark, path, table, {p: own[p] for p in places if p in own})
        others = others.where(~F.date_format("unit", CALENDAR[table][2]).isin(units)).drop("writer", "batch")
        fresh = _per_unit(finer, table, F.date_trunc(unit, "unit").cast("timestamp_ntz"))
        written[table] = _write_calendar(others.unionByName(fresh), path, table, batch)
        finer = _calendar(spark, path, table, {p: [f] for p, f in written[table].items()})
        finer = finer.where(F.date_format("unit", MONTH_KEY).isin(touched["months"]))

    # The rows of a day of one part are settled and need no comparison; those of the others are counted once for each key.
    one, many = ({p: live[p] for p in days if p in live and (len(live[p]) > 1) == several} for several in (False, True))
    keys = [*PARTITIONS, "pk", "sk"]
    named = _rows(spark, path, one).select(*keys)
    if many:
        named = named.unionByName(apart(_rows(spark, path, many).select(*keys), *keys).distinct())
    per_key = named.groupBy(*PARTITIONS, "pk").agg(F.count("*").alias("n"))
    counted = per_key.select("pk", "n", *PARTITIONS).hint("rebalance", "event_date").sortWithinPartitions(*PARTITIONS, "pk")
    written[COUNTS] = versions.write_parts(counted, path, COUNTS, PARTITIONS, "calendar", batch)
    replaced = {"slots": set(days), COUNTS: set(days), "days": {d[:7] for d in days}, "months": {d[:4] for d in days}}

    def switch(newest: Version) -> Version:
        if newest.calendar != now.calendar:
            raise RuntimeError("the calendar tables were brought up to date by someone else meanwhile")
        after = newest
        for table, added in written.items():
            after = after.with_parts(table, added, lambda place, folder, table=table: place in replaced[table])
        calendar = {p: f for p, f in newest.calendar.items() if p not in days} | {p: live[p] for p in days if p in live}
        return replace(after, calendar=calendar)

    return versions.commit(spark, path, switch)


def calendar_rows(spark: SparkSession, path: str, table: str, first: str | None = None, last: str | None = None, version: int | None = None) -> DataFrame:
    """Rows of ``slots``, ``days`` or ``months`` whose unit lies from ``first`` to ``last``, which are texts as in the sort key
    or beginnings of them. Only the places between are read."""
    width = {"slots": 10, "days": 7, "months": 4}[table]
    folders = versions.load(spark, path, version).folders(table)
    places = versions.within(folders, first[:width] if first else None, last[:width] if last else None)
    # A beginning that is shorter than a place covers all places that go on from it.
    if last and len(last) < width:
        places = {p: f for p, f in folders.items() if (not first or p >= first[:width]) and p[: len(last)] <= last}
    return _calendar(spark, path, table, places).drop("writer", "batch")


def calendar_scan(spark: SparkSession, path: str, pk: str, first: str, last: str | None = None, version: int | None = None) -> DataFrame:
    """Rows of one key of a calendar table from one sort key to another, both included, or with a beginning of a sort key.
    The key space names the table, and the times prune its places."""
    space, _, begin = first.partition("#")
    table = next(t for t, (_, s, _) in CALENDAR.items() if s == space)
    end = begin if last is None else last.partition("#")[2]
    rows = calendar_rows(spark, path, table, begin or None, end or None, version)
    found = by_prefix(rows, pk, first) if last is None else by_range(rows, pk, first, last)
    return found.select("pk", "sk", *MEASURES)


def counts(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``n`` rows of each key, grain and period by day; at least so many are in the store."""
    return versions.read_parts(spark, path, COUNTS, COUNT_ROW, PARTITIONS[0], versions.load(spark, path, version).folders(COUNTS))


def newest_from(spark: SparkSession, path: str, grain: str, period: str, pk: str, n: int, before: str | None = None, version: int | None = None) -> str | None:
    """The latest day from which on a key has ``n`` rows at least, or None where it has fewer. With ``before`` only rows of
    earlier days count. Days without a count are taken to have none, which only makes the answer earlier."""
    own = counts(spark, path, version).where((F.col("grain") == grain) & (F.col("period") == period) & (F.col("pk") == pk))
    if before:
        own = own.where(F.col("event_date") < F.lit(before).cast("date"))
    summed = own.groupBy("event_date").agg(F.sum("n").alias("n"))
    upto = summed.withColumn("total", F.sum("n").over(Window.orderBy(F.desc("event_date"))))
    found = upto.where(F.col("total") >= n).agg(F.max("event_date").alias("day")).first()["day"]
    return str(found) if found else None


def starts(spark: SparkSession, path: str, n: int, grains: Sequence[str], version: int | None = None) -> DataFrame:
    """For every key and period of some grains the day from which on it has ``n`` rows at least, or its first day."""
    own = counts(spark, path, version).where(F.col("grain").isin(list(grains)))
    w = Window.partitionBy("pk", "period").orderBy(F.desc("event_date"))
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.withColumn("before", before).where(F.col("before") < n).groupBy("pk", "period").agg(F.min("event_date").alias("start"))


def newest_items(spark: SparkSession, path: str, period: str, n: int, region: str, state: str | None = None, store_id: int | None = None, before: str | None = None) -> DataFrame:
    """Newest rows of one key, or with a sort key ``before`` the next page after it. Only as many days are read as ``n`` rows
    need by the counts."""
    grain = "STORE" if store_id is not None else "STATE" if state else "REGION"
    last = Cursor.of(before).event_time.date().isoformat() if before else None
    first = newest_from(spark, path, grain, period, key_value(region, state, store_id), n, last)
    rows = by_period(by_key(read_settled(spark, path, None, first, last), region, state, store_id), period)
    return page_after(rows, before, n) if before else newest(rows, n)


# What is final.


def frontier(now: Version) -> datetime | None:
    """The least arrival that any writer can still bring; None while some writer has told none."""
    if not now.frontier or any(w not in now.frontier for w in now.done):
        return None
    return datetime(1970, 1, 1) + timedelta(microseconds=min(now.frontier.values()))


def final_rows(spark: SparkSession, path: str, width: dict[str, int], version: int | None = None) -> DataFrame:
    """Settled rows whose arrival bucket no writer can add to any more. ``width`` has the seconds of each period."""
    now = versions.load(spark, path, version)
    upto = frontier(now)
    rows = read_settled(spark, path, now.number or None)
    if upto is None:
        return rows.where("false")
    seconds = F.coalesce(*[F.when(F.col("period") == p, F.lit(s).cast("bigint")) for p, s in width.items()])
    ends = F.timestamp_micros(F.unix_micros(F.col("ingest_time").cast("timestamp")) + seconds * 1_000_000).cast("timestamp_ntz")
    return rows.where(ends <= F.lit(upto).cast("timestamp_ntz"))


def current_items(items: DataFrame) -> DataFrame:
    """Items of an intake table as an upsert would leave them: per key, the one of the newest batch."""
    newest = Window.partitionBy("pk", "sk").orderBy(F.desc("batch_id"))
    ranked = items.withColumn("newest", F.row_number().over(newest)).where("newest = 1")
    return ranked.select("pk", "sk", *[c for c in items.columns if c not in ("pk", "sk", "batch_id")])


def publish(events: DataFrame, *carried: str) -> DataFrame:
    """Records in their wire form keyed by ``region#state``, for a sink that partitions by key."""
    return events.select(*carried, F.concat_ws("#", "region", "state").alias("key"), F.to_json(event_record()).alias("value"))


def write_by_place(events: DataFrame, path: str) -> None:
    """Events in folders by region and state; a large state gets several tasks and files."""
    events.hint("rebalance", "region", "state").write.mode("append").partitionBy("region", "state").parquet(path)


def purge(spark: SparkSession, path: str) -> None:
    """Removes all rows and keeps the store: a version without parts. Readers of earlier versions read on."""
    versions.commit(spark, path, lambda now: replace(now, parts={}, calendar={}))
