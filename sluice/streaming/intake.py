"""Intake of rollup records in one job for each micro-batch.

A batch is decoded, classified and written once, by status, and its statistics are observed while it is written: nothing is
kept in memory and no second job counts it. Rows, counts and the batch's number become visible with one version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.keys import UNKNOWN_PERIOD
from sluice.operators.intake import DEAD, ERROR, OK, classify, decode, load_stats
from sluice.schema import GRAINS, NO_STATE, PERIODS, REGIONS, STORE_KPIS, columns
from sluice.sinks import store, versions
from sluice.streaming.delivery import start
from sluice.streaming.rollups import writer_name

INTAKE = "intake"
STATUS = "status"
ROW = columns(
    "data string, reason string, pk string, sk string, type string, grain string, period string, region string, state string, store_id string, "
    + ", ".join(f"{k} bigint" for k in [*STORE_KPIS, "n_rec"])
    + f", event_time timestamp_ntz, ingest_time timestamp_ntz, writer string, batch string, {STATUS} string"
)
OTHER = "other|other"


def observed() -> list[Column]:
    """The statistics of classified records as one number each, and how many of them fall under none of the names."""
    ok, grain = F.col("status") == OK, F.col("grain")
    states = sorted({s for own in REGIONS.values() for s in own} | {NO_STATE})
    named = {"total|all": F.lit(True), "total|ok": ok, "total|err": ~ok}
    named |= {f"grain|{g}": ok & (grain == g) for g in GRAINS}
    named |= {f"period|{p}": (F.col("status") != ERROR) & (F.col("period") == p) for p in (*PERIODS, UNKNOWN_PERIOD)}
    named |= {f"state|{s}": ok & (grain == "STATE") & (F.col("state") == s) for s in states}
    named |= {f"region|{r}": ok & (grain == "REGION") & (F.col("region") == r) for r in REGIONS}
    named[OTHER] = ok & (((grain == "STATE") & ~F.col("state").isin(states)) | ((grain == "REGION") & ~F.col("region").isin(list(REGIONS))))
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in named.items()]


def take_in(records: DataFrame, path: str, checkpoint: str, writer: str | None = None, every: str | None = None) -> StreamingQuery:
    """Decodes, classifies, stores and counts rollup records (``data``); no record stops the stream."""
    name = writer or writer_name(checkpoint)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if store.is_done(versions.load(spark, path), name, batch_id):
            return
        if batch.isEmpty():  # nothing to write or to count
            versions.commit(spark, path, lambda now: store.added_to(now, name, batch_id, {}))
            return
        seen = Observation()
        items = classify(decode(batch.select("data")), "data").observe(seen, *observed())
        added = versions.write_parts(items, path, INTAKE, [STATUS], name, str(batch_id))
        counts = dict(seen.get)
        if counts.pop(OTHER):  # regions or states that the dimension does not know: their names are in the rows
            own = load_stats(_rows(spark, path, {p: [f] for p, f in added.items()})).where("stat in ('state', 'region')")
            counts |= {f"{r['stat']}|{r['key']}": r["n"] for r in own.collect()}

        def change(now: versions.Version) -> versions.Version | None:
            after = store.added_to(now, name, batch_id, {INTAKE: added})
            return after and after.counted(name, counts)

        versions.commit(spark, path, change)

    return start(records.writeStream.foreachBatch(deliver), checkpoint, every)


def _rows(spark: SparkSession, path: str, folders: dict[str, list[str]]) -> DataFrame:
    return versions.read_parts(spark, path, INTAKE, ROW, STATUS, folders)


def read_intake(spark: SparkSession, path: str, *status: str, version: int | None = None) -> DataFrame:
    """Records of some of the statuses ok, dead_letter and error, by default of all."""
    folders = versions.load(spark, path, version).folders(INTAKE)
    return _rows(spark, path, {s: f for s, f in folders.items() if s in (status or (OK, DEAD, ERROR))})
