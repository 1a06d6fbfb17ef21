"""Queries that run as streams over the tables' files, or that parse records off the wire."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.time import border
from sluice.operators import intake
from sluice.operators.rollup import ROLLUP, keyed, rollup_all
from sluice.schema import KPI_SUMS, KPIS, PERIODS, STORE_KPIS
from sluice.session import scratch_folder
from sluice.sinks import store, versions
from sluice.sinks.store import MEASURES, publish, read_store, settled
from sluice.sources import tables
from sluice.sources.records import in_envelope, rollup_record
from sluice.sources.streams import parse_events, typed_folder
from sluice.streaming import fanout
from sluice.streaming.delivery import rollup_json, to_table
from sluice.streaming.intake import take_in
from sluice.streaming.ledger import account_stream as account_verdicts
from sluice.streaming.rollups import rollups_to_store

#: An item's columns, in the order of the queries' SQL.
ITEMS = ["pk", "sk", "type", "grain", "period", "region", "state", "store_id", *MEASURES, "ingest_time", "event_time"]

#: Batches of the feeds, and the column that deals events out to their files.
BATCHES, TURN = 3, "turn"

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _result(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Runs a stream over what there is, into a table in the scratch folder."""
    base = scratch_folder(spark, label)
    to_table(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _dealt(events: DataFrame) -> DataFrame:
    """Events dealt out by their turn, in tasks of a bounded size."""
    return events.withColumn(TURN, F.col("event_id") % BATCHES).hint("rebalance", TURN)


def _written(dealt: DataFrame, path: str) -> int:
    """Writes what is dealt out, in files by turn, and gives the number of files that make a third."""
    dealt.write.partitionBy(TURN).parquet(path)
    return -(-len(dealt.sparkSession.read.schema(dealt.schema).parquet(path).inputFiles()) // BATCHES)


def _feed(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Events as a stream of several files, a third per batch, none in order of arrival."""
    return typed_folder(spark, path, files_per_batch=max(_written(_dealt(events), path), 1))


def _rollups(period: str) -> Callable[[SparkSession, str], DataFrame]:
    """All rows of one period, stored batch by batch and added up by the reader."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        base = scratch_folder(spark, f"stream-{period}")
        feed = _feed(spark, tables.kpi_events(spark, folder), f"{base}/in")
        rollups_to_store(feed, f"{base}/store", f"{base}/checkpoint", [period]).awaitTermination()
        rows = settled(read_store(spark, f"{base}/store"))
        return rows.withColumnsRenamed(dict(zip(STORE_KPIS, KPI_SUMS))).select(*ROLLUP)

    return run


def store_stream(spark: SparkSession, folder: str) -> DataFrame:
    """One store with many writers: two streams of some periods each over half of the events, and a batch of the rest."""
    base, events = scratch_folder(spark, "store"), tables.kpi_events(spark, folder)
    half = F.col("event_id") % 2 == 0
    for name, periods in (("long", ["PT1H"]), ("short", ["PT1M", "PT10M"])):
        feed = _feed(spark, events.where(half), f"{base}/{name}")
        rollups_to_store(feed, f"{base}/store", f"{base}/c-{name}", periods).awaitTermination()
    store.write_rollups(events.where(~half), f"{base}/store")
    return settled(read_store(spark, f"{base}/store")).select(*ITEMS)


def _raw_feed(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """Raw records as a stream of several files, a third per batch, none in order of arrival."""
    n = _written(tables.raw_records(_dealt(tables.kpi_events(spark, folder)), TURN).drop("event_id"), path)
    return spark.readStream.schema("value string, arrival timestamp").option("maxFilesPerTrigger", max(n, 1)).parquet(path)


def _fanned_out(spark: SparkSession, folder: str) -> str:
    base = scratch_folder(spark, "fan-out")
    fanout.fan_out(_raw_feed(spark, folder, f"{base}/in"), f"{base}/store", f"{base}/checkpoint").awaitTermination()
    return f"{base}/store"


def fan_out_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """What one job over raw records has rolled up."""
    return store.read_settled(spark, _fanned_out(spark, folder)).select(*ITEMS)


def fan_out_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records in each sink of that job, and its own counts. Archived are set aside and counted ones together."""
    path = _fanned_out(spark, folder)
    archived = fanout.read_archive(spark, path).select(F.lit("archive").alias("sink"), F.lit("records").alias("key"), F.lit(1).alias("n"))
    aside = fanout.read_quarantine(spark, path).select(F.lit("quarantine").alias("sink"), F.col("reason").alias("key"), F.lit(1).alias("n"))
    rolled = store.read_store(spark, path).where("grain = 'REGION' and period = 'PT1H'")
    rolled = rolled.select(F.lit("rollups").alias("sink"), F.lit("records").alias("key"), F.col("n_rec").alias("n"))
    told = fanout.delivered(spark, path).where("stat in ('total', 'region')").select("stat", "key", "n")
    every = archived.unionByName(aside).unionByName(rolled).unionByName(told.withColumnRenamed("stat", "sink"))
    return every.groupBy("sink", "key").agg(F.sum("n").alias("n"))


def store_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """A store of three batches before and after compaction: a reader of the old version, and one of the new."""
    base, events = scratch_folder(spark, "compacted"), tables.kpi_events(spark, folder)
    rollups_to_store(_feed(spark, events, f"{base}/in"), f"{base}/store", f"{base}/checkpoint").awaitTermination()
    old = versions.load(spark, f"{base}/store").number
    store.compact(spark, f"{base}/store")
    before = store.settled(store.read_store(spark, f"{base}/store", old)).withColumn("reader", F.lit("old"))
    after = store.read_store(spark, f"{base}/store").withColumn("reader", F.lit("new"))
    columns = ["reader", "pk", "sk", *MEASURES]
    return before.select(*columns).unionByName(after.select(*columns))


def calendar_increment(spark: SparkSession, folder: str) -> DataFrame:
    """Days and months after two batches, the second of which brings more rows for some days only."""
    base, events = scratch_folder(spark, "calendar"), tables.kpi_events(spark, folder)
    late = (F.col("event_id") % 5 == 0) & (F.col("event_time") >= F.lit("2024-01-20").cast("timestamp"))
    for name, part in (("first", events.where(~late)), ("second", events.where(late))):
        store.write_rollups(part, base, batch=name)
        store.refresh(spark, base)
    return store.calendar_rows(spark, base, "days").unionByName(store.calendar_rows(spark, base, "months"), allowMissingColumns=True).select("grain", "pk", "sk", *MEASURES)


def purged(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of a store after the rows of a state on some days are removed."""
    base = scratch_folder(spark, "purged")
    store.write_rollups(tables.kpi_events(spark, folder), base, batch="events")
    store.purge_range(spark, base, "NORTHEAST", "BA", "2024-01-10", "2024-01-12")
    return store.read_settled(spark, base).select(*ITEMS)


def final_items(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that are final in a store of two streams, one of which has come further than the other."""
    base, events = scratch_folder(spark, "final"), tables.kpi_events(spark, folder)
    for k, upto in enumerate(("2024-01-15", "2024-01-20")):
        part = events.where((F.col("event_id") % 2 == k) & (F.col("ingest_time") < F.lit(upto).cast("timestamp")))
        feed = _feed(spark, part, f"{base}/in-{k}")
        rollups_to_store(feed, f"{base}/store", f"{base}/c-{k}", lateness=timedelta(0)).awaitTermination()
    return store.final_rows(spark, f"{base}/store", PERIODS).select(*ITEMS)


def intake_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of rollup records that a stream has taken in, as it observed them."""
    base = scratch_folder(spark, "intake")
    records = tables.typed_records(_dealt(tables.kpi_events(spark, folder)), TURN)
    n = _written(records.select(TURN, in_envelope(rollup_record(KPIS)).alias("data")), f"{base}/in")
    feed = spark.readStream.schema("data string").option("maxFilesPerTrigger", max(n, 1)).parquet(f"{base}/in")
    take_in(feed, f"{base}/store", f"{base}/checkpoint").awaitTermination()
    return fanout.delivered(spark, f"{base}/store")


def upsert_view(spark: SparkSession, folder: str) -> DataFrame:
    """Items of an intake table whose second batch has some of the first one's keys again, with other values."""
    items = keyed(rollup_all(tables.kpi_events(spark, folder), ["REGION"], ["PT1H"])).select("pk", "sk", "kpi1", "n_rec")
    again = items.where("n_rec % 2 = 0").withColumn("kpi1", F.col("kpi1") + 1000)
    both = items.withColumn("batch_id", F.lit(0)).unionByName(again.withColumn("batch_id", F.lit(1)))
    return store.current_items(both)


def account_stream(spark: SparkSession, folder: str) -> DataFrame:
    commands = tables.typed_commands(
        tables.table_stream(spark, folder, "orders"), tables.table(spark, folder, "customer")
    )
    verdicts = account_verdicts(commands, tables.accounts(spark, folder))
    with rocksdb(spark):
        return _result(spark, verdicts.drop("balance"), "stream-accounts")


def late_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Deposits and withdrawals of accounts some of which are created, or created again, by the stream."""
    commands = tables.commands_beside_creations(spark, folder).where("kind <> 'MoneyTransfer'")
    base = scratch_folder(spark, "late")
    commands.write.parquet(f"{base}/commands")
    tables.later_creations(spark, folder).write.parquet(f"{base}/creations")
    feeds = [spark.readStream.schema(spark.read.parquet(f"{base}/{n}").schema).parquet(f"{base}/{n}") for n in ("commands", "creations")]
    verdicts = account_verdicts(feeds[0], tables.first_accounts(spark, folder), feeds[1], held=20)
    with rocksdb(spark):
        return _result(spark, verdicts, "late-accounts").select("cmd_id", "acc_id", "accepted", "reason", "balance")


def parsed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as JSON the way producers send them, and read back."""
    published = publish(tables.kpi_events(spark, folder).withColumn("arrival", F.col("ingest_time")), "arrival")
    raw = published.select("value", "arrival")
    return parse_events(raw).withColumns({c: border(F.col(c)) for c in ("event_time", "ingest_time")})


def decoded_records(spark: SparkSession, folder: str) -> DataFrame:
    """Rollup records written as base64 JSON, then decoded and classified."""
    envelopes = tables.wire_records(spark, folder).select("event_id", in_envelope(rollup_record(KPIS)).alias("data"))
    return intake.classify(intake.decode(envelopes), "event_id")


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """What the intake of all records sets aside, with the reason."""
    return intake.quarantined(decoded_records(spark, folder)).select("event_id", "reason")


def rollup_wire(spark: SparkSession, folder: str) -> DataFrame:
    """All rollups written as JSON, put in envelopes, decoded and classified."""
    texts = rollup_json(rollup_all(tables.kpi_events(spark, folder)))
    data = F.base64(F.col("value").cast("binary")).alias("data")
    return intake.classify(intake.decode(texts.select(data))).select("status", "pk", "sk", "n_rec")


QUERIES = {
    **{f"stream_rollup_{p.lower()}": _rollups(p) for p in PERIODS},
    "account_stream": account_stream,
    "parsed_events": parsed_events,
    "decoded_records": decoded_records,
    "store_stream": store_stream,
    "quarantine": quarantine,
    "rollup_wire": rollup_wire,
    "fan_out_rollups": fan_out_rollups,
    "fan_out_counts": fan_out_counts,
    "store_compacted": store_compacted,
    "calendar_increment": calendar_increment,
    "purged": purged,
    "final_items": final_items,
    "upsert_view": upsert_view,
    "intake_stats": intake_stats,
    "late_accounts": late_accounts,
}
