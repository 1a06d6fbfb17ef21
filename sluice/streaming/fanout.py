"""One raw source, several sinks, one commit a batch.

Each micro-batch of raw records is archived as it came. What it then delivers is read from that archive, so that all sinks
see the same records whatever the source does when it is asked again: records that cannot be counted go to the quarantine
with the reason, all others into the rollups, and the counts of both are taken while the quarantine is written. At the end
one version makes the parts of all sinks, the counts and the batch's number visible. If the job dies before that, nothing
of the batch is seen, and the batch is delivered again; after it, the batch is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.rollup import keyed, rollup_all
from sluice.schema import GRAINS, PERIODS, REGIONS, columns
from sluice.session import shuffled_for
from sluice.sinks import store, versions
from sluice.sources.streams import parse_events
from sluice.streaming.delivery import start
from sluice.streaming.rollups import told, writer_name

ARCHIVE, QUARANTINE = "archive", "quarantine"
DAY = "arrival_date"
ARCHIVED = columns(f"value string, arrival timestamp, writer string, batch string, {DAY} string")
SET_ASIDE = columns(f"value string, arrival timestamp, reason string, writer string, batch string, {DAY} string")
#: Arrivals keep their microseconds in the archive's JSON.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "compression": "none"}

# --- fixed values: why a record is set aside ---
UNREADABLE, NO_TIME, NO_REGION, NO_STATE, NO_STORE = "unreadable", "missing_time", "missing_region", "missing_state", "missing_store"
REASONS = (UNREADABLE, NO_TIME, NO_REGION, NO_STATE, NO_STORE)


def reason() -> Column:
    """Why a parsed event cannot be counted; null if it can."""
    return (
        F.when(F.col("bad_record").isNotNull() & F.get_json_object("value", "$").isNull(), UNREADABLE)
        .when(F.col("event_time").isNull(), NO_TIME)
        .when(F.col("region").isNull(), NO_REGION)
        .when(F.col("state").isNull(), NO_STATE)
        .when(F.col("store_id").isNull(), NO_STORE)
        .when(F.col("bad_record").isNotNull(), UNREADABLE)
    )


def _counts() -> list[Column]:
    """Counts of parsed records, one number each: all, by outcome, and good ones by region and state."""
    good = F.col("reason").isNull()
    named = {"total|all": F.lit(True), "total|ok": good, "total|err": ~good}
    named |= {f"reason|{r}": F.col("reason") == r for r in REASONS}
    named |= {f"region|{r}": good & (F.col("region") == r) for r in REGIONS}
    named |= {f"state|{r}#{s}": good & (F.col("region") == r) & (F.col("state") == s) for r, states in REGIONS.items() for s in states}
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in named.items()]


def parsed(archived: DataFrame) -> DataFrame:
    """Archived records as events, with ``value`` and the ``reason`` of those that cannot be counted."""
    raw = archived.select("value", "arrival", DAY)
    events = parse_events(raw, "arrival", DAY, "value")
    return events.withColumn("reason", reason())


def fan_out(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    writer: str | None = None,
    periods: Sequence[str] = tuple(PERIODS),
    grains: Sequence[str] = tuple(GRAINS),
    lateness: timedelta | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Archives, quarantines, rolls up and counts raw records (``value``, ``arrival``) into the tables of one store."""
    name = writer or writer_name(checkpoint)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if store.is_done(versions.load(spark, path), name, batch_id):
            return
        if batch.isEmpty():  # nothing to write or to count
            versions.commit(spark, path, lambda now: store.added_to(now, name, batch_id, {}))
            return
        label, seen, counted = str(batch_id), Observation(), Observation()
        incoming = batch.select("value", "arrival").observe(seen, F.max(F.unix_micros("arrival")).alias("newest"), F.count("*").alias("n"))
        incoming = incoming.withColumn(DAY, F.date_format("arrival", "yyyy-MM-dd"))
        added = {ARCHIVE: versions.write_parts(incoming, path, ARCHIVE, [DAY], name, label, "json", **JSON)}
        events = parsed(_archived(spark, path, {p: [f] for p, f in added[ARCHIVE].items()}))
        aside = events.observe(counted, *_counts()).where("reason is not null").select("value", F.col("ingest_time").alias("arrival"), "reason", DAY)
        added[QUARANTINE] = versions.write_parts(aside, path, QUARANTINE, [DAY], name, label)
        items = keyed(rollup_all(events.where("reason is null"), grains, periods))
        with shuffled_for(spark, seen.get["n"] * len(grains) * len(periods)):
            added[store.ROLLUPS] = store.write_items(items, path, name, label)

        def change(now: versions.Version) -> versions.Version | None:
            after = store.added_to(now, name, batch_id, added)
            return after and told(after.counted(name, counted.get), name, seen.get["newest"], lateness)

        versions.commit(spark, path, change)

    return start(raw.writeStream.foreachBatch(deliver), checkpoint, every)


def _archived(spark: SparkSession, path: str, folders: dict[str, list[str]]) -> DataFrame:
    return versions.read_parts(spark, path, ARCHIVE, ARCHIVED, DAY, folders, "json", timestampFormat=JSON["timestampFormat"])


def read_archive(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All records as they came."""
    return _archived(spark, path, versions.load(spark, path, version).folders(ARCHIVE))


def read_quarantine(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The records that were set aside, with the reason."""
    return versions.read_parts(spark, path, QUARANTINE, SET_ASIDE, DAY, versions.load(spark, path, version).folders(QUARANTINE))


def delivered(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``stat``, ``key`` and ``n`` of all that was delivered, over all writers."""
    total: dict[str, int] = {}
    for counts in versions.load(spark, path, version).totals.values():
        for name, n in counts.items():
            total[name] = total.get(name, 0) + n
    rows = [(*name.split("|", 1), n) for name, n in sorted(total.items()) if n]
    return spark.createDataFrame(rows, "stat string, key string, n bigint")
