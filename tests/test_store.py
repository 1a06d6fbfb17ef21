"""The versioned store: fan-out, compaction, calendar tables, newest rows and pages, final rows, purge."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluice import session
from sluice.operators import scan
from sluice.operators.rollup import calendar_rollup, keyed, rollup_all
from sluice.plans import streams as plans
from sluice.schema import PERIODS
from sluice.sinks import store, versions
from sluice.sources import streams, tables
from sluice.streaming import fanout, rollups

ITEM = ["pk", "sk", "grain", "period", *store.MEASURES]
GRAINS = ["REGION", "STATE"]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def events(spark, small):
    """Events of five days, so that few folders are written."""
    picked = tables.kpi_events(spark, small).where("event_time < timestamp'2024-01-06' and event_time >= timestamp'2024-01-01'")
    return spark.createDataFrame(picked.collect(), picked.schema)


def items(events, periods=("PT1M", "PT1H")):
    return keyed(rollup_all(events, GRAINS, periods))


def settled(spark, path, version=None):
    return rows(store.settled(store.read_store(spark, path, version)).select(*ITEM))


def raw_feed(spark, small, path, files=3):
    raw = tables.raw_events(spark, small).where("event_id % 4 = 0").orderBy("event_id").collect()
    step = -(-len(raw) // files)
    for k in range(0, len(raw), step):
        part = [(r["value"], r["arrival"]) for r in raw[k : k + step]]
        spark.createDataFrame(part, "value string, arrival timestamp").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("value string, arrival timestamp").option("maxFilesPerTrigger", 1).parquet(path)


def test_fan_out_killed_between_two_sinks(spark, small, tmp_path, monkeypatch):
    path, checkpoint = str(tmp_path / "store"), str(tmp_path / "c")
    feed = raw_feed(spark, small, str(tmp_path / "in"))
    write, calls = versions.write_parts, Counter()

    def dies(df, base, table, *rest, **options):
        calls[table] += 1
        if table == store.ROLLUPS and calls[table] == 2:
            raise OSError("killed")
        return write(df, base, table, *rest, **options)

    monkeypatch.setattr(versions, "write_parts", dies)
    with pytest.raises(Exception, match="killed"):
        fanout.fan_out(feed, path, checkpoint, grains=GRAINS, periods=["PT1H"]).awaitTermination()
    # The second batch is archived and quarantined, yet nothing of it is seen.
    archived = fanout.read_archive(spark, path).count()
    told = {(r["stat"], r["key"]): r["n"] for r in fanout.delivered(spark, path).collect()}
    assert calls[fanout.QUARANTINE] == 2 and told[("total", "all")] == archived < tables.raw_events(spark, small).where("event_id % 4 = 0").count()
    monkeypatch.setattr(versions, "write_parts", write)
    for _ in range(2):  # a restart finishes the batch; another one adds nothing
        fanout.fan_out(feed, path, checkpoint, grains=GRAINS, periods=["PT1H"]).awaitTermination()
        raw = tables.raw_events(spark, small).where("event_id % 4 = 0")
        good = tables.kpi_events(spark, small).where("event_id % 4 = 0 and event_id % 50 not in (0, 1, 2)")
        assert rows(fanout.read_archive(spark, path).select("value", "arrival")) == rows(raw.select("value", "arrival"))
        assert settled(spark, path) == rows(keyed(rollup_all(good, GRAINS, ["PT1H"])).select(*ITEM))
        assert store.read_store(spark, path).where("region is null or state is null or event_date is null").isEmpty()
        aside = Counter(r["reason"] for r in fanout.read_quarantine(spark, path).collect())
        assert set(aside) == {"unreadable", "missing_time"} and sum(aside.values()) + good.count() == raw.count()
        told = {(r["stat"], r["key"]): r["n"] for r in fanout.delivered(spark, path).collect()}
        assert told[("total", "all")] == raw.count() and told[("total", "ok")] == good.count() and told[("reason", "unreadable")] == aside["unreadable"]
        per_region = {("region", r["region"]): r["n"] for r in good.groupBy("region").agg(F.count("*").alias("n")).collect()}
        assert {k: n for k, n in told.items() if k[0] == "region"} == per_region


def test_reasons_to_set_aside(spark):
    good = '{"event-time":"2024-01-01T00:00:00","region":"NORTH","state":"AM","store-id":1,"kpi-1":1}'
    raw = [good, "{", "", "[1]", good.replace("2024", "x"), good.replace('"NORTH"', "null"), good.replace('"AM"', "null"), good.replace('"store-id":1', '"store-id":null'), good.replace('"kpi-1":1', '"kpi-1":"x"')]
    df = spark.createDataFrame([(r, datetime(2024, 1, 1), "d") for r in raw], f"value string, arrival timestamp, {fanout.DAY} string")
    got = [r["reason"] for r in fanout.parsed(df).select("value", "reason").collect()]
    assert got == [None, "unreadable", "unreadable", "missing_time", "missing_time", "missing_region", "missing_state", "missing_store", "unreadable"]


def test_compaction_changes_no_result(spark, events, tmp_path):
    path = str(tmp_path / "s")
    for k in range(4):
        store.write_store(items(events.where(f"event_id % 4 = {k}")), path, "w", k)
    want, old = rows(items(events).select(*ITEM)), versions.load(spark, path)
    assert settled(spark, path) == want and all(len(f) == 4 for f in old.folders(store.ROLLUPS).values())
    after = store.compact(spark, path)
    assert all(len(f) == 1 for f in after.folders(store.ROLLUPS).values()) and after.number == old.number + 1
    assert rows(store.read_store(spark, path).select(*ITEM)) == want == rows(store.read_settled(spark, path).select(*ITEM))
    assert settled(spark, path, old.number) == want  # a reader of the old version
    store.write_store(items(events.where("event_id % 4 = 1")), path, "w", 1)  # delivered again
    assert versions.load(spark, path) == after and store.compact(spark, path) == after
    store.write_store(items(events.where("event_id % 4 = 1")), path, "w", 4)
    assert sum(n for *_, n in store.read_store(spark, path).select("n_rec").collect()) > after.number
    # Folders that no version lists go; those of kept versions stay.
    assert versions.vacuum(spark, path, keep=1, unused_for=0) == 4
    with pytest.raises(Exception, match="FileNotFound"):
        versions.load(spark, path, old.number)
    assert store.read_settled(spark, path).agg(F.sum("n_rec")).first()[0] > 0


def test_batches_that_come_during_compaction_stay(spark, events, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    for k in range(2):
        store.write_store(items(events.where(f"event_id % 3 = {k}")), path, "w", k)
    write = store.write_items

    def slow(*rest):
        out = write(*rest)
        monkeypatch.setattr(store, "write_items", write)
        store.write_store(items(events.where("event_id % 3 = 2")), path, "w", 2)
        return out

    monkeypatch.setattr(store, "write_items", slow)
    store.compact(spark, path)
    assert settled(spark, path) == rows(items(events).select(*ITEM))
    assert rows(store.read_settled(spark, path).select(*ITEM)) == rows(items(events).select(*ITEM))


def test_named_batches_replace_and_versions_conflict(spark, events, tmp_path):
    path = str(tmp_path / "s")
    store.write_store(items(events), path, batch="one")
    store.write_store(items(events.where("event_id % 2 = 0")), path, batch="one")
    assert settled(spark, path) == rows(items(events.where("event_id % 2 = 0")).select(*ITEM))
    files = versions.Files(spark, f"{path}/{versions.VERSIONS}")
    assert not files.create(files.names()[-1], "{}") and files.create("x.json", "{}") and files.names()[-1] == "x.json"
    files.delete("x.json")
    store.write_store(items(events.where("event_id % 2 = 1")), path, batch="two")
    store.compact(spark, path)
    with pytest.raises(ValueError, match="compacted"):
        store.write_store(items(events), path, batch="one")


def calendar(spark, path, events):
    for table, space, unit, form in (("slots", "SLOT", "minute", "yyyy-MM-dd_HH:mm"), ("days", "D", "day", "yyyy-MM-dd"), ("months", "M", "month", "yyyy-MM")):
        want = calendar_rollup(events, "REGION", space, unit, form).unionByName(calendar_rollup(events, "STATE", space, unit, form))
        assert rows(store.calendar_rows(spark, path, table).select(*want.columns)) == rows(want)


def test_calendar_follows_touched_days_only(spark, events, tmp_path):
    path = str(tmp_path / "s")
    late = "event_id % 3 = 0 and event_time >= timestamp'2024-01-04'"
    store.write_store(items(events.where(f"not ({late})")), path, "w", 0)
    first = store.refresh(spark, path)
    calendar(spark, path, events.where(f"not ({late})"))
    store.write_store(items(events.where(late)), path, "w", 1)
    assert store.stale_days(versions.load(spark, path)) == ["2024-01-04", "2024-01-05"]
    second = store.refresh(spark, path)
    calendar(spark, path, events)
    slots = [v.folders("slots") for v in (first, second)]
    assert [d for d in slots[0] if slots[0][d] != slots[1][d]] == ["2024-01-04", "2024-01-05"]
    assert store.refresh(spark, path) == second
    store.compact(spark, path)
    assert store.stale_days(versions.load(spark, path)) == []  # other parts, the same rows
    store.purge_range(spark, path, "NORTHEAST", first="2024-01-02", last="2024-01-02")
    store.refresh(spark, path)
    calendar(spark, path, events.where("not (region = 'NORTHEAST' and event_time >= timestamp'2024-01-02' and event_time < timestamp'2024-01-03')"))


def paths_read(df):
    """Days whose files a plan reads."""
    return {f.split("event_date=")[1][:10] for f in df.inputFiles() if "/rollups/" in f}


def test_newest_rows_and_pages_read_few_days(spark, events, tmp_path):
    path = str(tmp_path / "s")
    for k in range(2):
        store.write_store(items(events.where(f"event_id % 2 = {k}")), path, "w", k)
    store.refresh(spark, path)
    every = [tuple(r) for r in items(events).where("pk = 'NORTHEAST' and period = 'PT1M'").select("sk", "kpi1", "n_rec").orderBy(F.desc("sk")).collect()]
    newest = store.newest_items(spark, path, "PT1M", 7, "NORTHEAST")
    assert [tuple(r) for r in newest.select("sk", "kpi1", "n_rec").collect()] == every[:7]
    assert paths_read(newest) == {"2024-01-05"}
    assert store.newest_items(spark, path, "PT1M", 10**6, "NORTHEAST").count() == len(every)
    got, last = [], None
    while page := store.newest_items(spark, path, "PT1M", 23, "NORTHEAST", before=last).select("sk", "kpi1", "n_rec").collect():
        got, last = [*got, *map(tuple, page)], page[-1]["sk"]
        if len(got) > len(every):
            break
    assert got == every
    assert store.newest_items(spark, path, "PT1M", 5, "NOWHERE").count() == 0
    range_read = store.read_settled(spark, path, None, "2024-01-02", "2024-01-03")
    assert paths_read(range_read) == {"2024-01-02", "2024-01-03"}
    found = store.calendar_scan(spark, path, "NORTHEAST", "SLOT#2024-01-02_12:00", "SLOT#2024-01-03_05:59")
    want = calendar_rollup(events, "REGION", "SLOT", "minute", "yyyy-MM-dd_HH:mm").where("pk = 'NORTHEAST' and sk between 'SLOT#2024-01-02_12:00' and 'SLOT#2024-01-03_05:59'")
    assert rows(found) == rows(want.select(*found.columns)) and {f.split("day=")[1][:10] for f in found.inputFiles()} == {"2024-01-02", "2024-01-03"}
    assert rows(store.calendar_scan(spark, path, "NORTHEAST", "D#2024-01-0").select("n_rec")) == rows(store.calendar_scan(spark, path, "NORTHEAST", "D#").select("n_rec"))


def test_cursor_with_ties_at_the_border(spark):
    t = datetime(2024, 1, 1)
    made = [(p, t + timedelta(hours=h), t + timedelta(hours=h, minutes=m)) for p in ("PT1H", "PT1M", "PT10M") for h in range(4) for m in range(5)]
    df = spark.createDataFrame(made, "period string, event_time timestamp_ntz, ingest_time timestamp_ntz")
    sk = F.concat_ws("#", "period", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS"), F.date_format("ingest_time", "yyyy-MM-dd HH:mm:ss.SSS"))
    df = df.withColumns({"sk": sk, "event_date": F.col("event_time").cast("date")})
    every = [r["sk"] for r in df.orderBy(F.desc("sk")).collect()]
    got, last = [], None
    while page := scan.page_after(df, last, 7).collect():
        got += [r["sk"] for r in page]
        last = got[-1]
    assert got == every


def test_final_rows_follow_the_slowest_writer(spark, events, tmp_path):
    path = str(tmp_path / "s")

    def feed(name, upto):
        events.where(f"ingest_time < timestamp'{upto}'").coalesce(1).write.parquet(str(tmp_path / name))
        return spark.readStream.schema(events.schema).parquet(str(tmp_path / name))

    def run(name, upto, lateness):
        source = feed(f"{name}-{upto}", upto)
        rollups.rollups_to_store(source, path, str(tmp_path / f"c-{name}-{upto}"), ["PT1H"], GRAINS, name, lateness=lateness).awaitTermination()

    run("a", "2024-01-03", timedelta(hours=1))
    upto = store.frontier(versions.load(spark, path))
    newest = events.where("ingest_time < timestamp'2024-01-03'").agg(F.max("ingest_time")).first()[0]
    assert upto == newest - timedelta(hours=1)
    final = store.final_rows(spark, path, PERIODS)
    assert not final.isEmpty() and final.where(F.col("ingest_time") + F.expr("interval 1 hour") > F.lit(upto)).isEmpty()
    run("b", "2024-01-05", None)  # tells nothing, so nothing is final
    assert store.frontier(versions.load(spark, path)) is None and store.final_rows(spark, path, PERIODS).isEmpty()


def test_purge_leaves_all_other_parts(spark, events, tmp_path):
    path = str(tmp_path / "s")
    for k in range(2):
        store.write_store(items(events.where(f"event_id % 2 = {k}")), path, "w", k)
    before = versions.load(spark, path)
    after = store.purge_range(spark, path, "NORTHEAST", "BA", "2024-01-02", "2024-01-03")
    parts = before.folders(store.ROLLUPS), after.folders(store.ROLLUPS)
    assert {d for d in parts[0] if parts[0][d] != parts[1].get(d)} <= {"2024-01-02", "2024-01-03"}
    gone = "region = 'NORTHEAST' and state = 'BA' and event_date between '2024-01-02' and '2024-01-03'"
    want = store.with_date(items(events))
    assert not want.where(gone).isEmpty()
    assert settled(spark, path) == rows(want.where(f"not ({gone})").select(*ITEM)) and settled(spark, path, before.number) == rows(want.select(*ITEM))
    assert store.purge_range(spark, path, "NORTHEAST", "BA", "2024-01-02", "2024-01-03") == after
    store.write_store(items(events.where("event_id % 2 = 1")), path, "w", 1)  # delivered again: does not come back
    assert settled(spark, path) == rows(want.where(f"not ({gone})").select(*ITEM))


def test_shuffles_grow_with_the_rows(spark, events, tmp_path, monkeypatch):
    """Tasks of a stream's batch, of a batch and of a settling reader hold a bounded number of rows."""
    n, seen = events.count(), {}
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    write = store.write_items

    def told(rows, path, writer, batch):
        seen[writer] = int(rows.sparkSession.conf.get(session.PARTITIONS))
        return write(rows, path, writer, batch)

    monkeypatch.setattr(store, "write_items", told)
    path = str(tmp_path / "store")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    rollups.rollups_to_store(streams.typed_folder(spark, str(tmp_path / "in")), path, str(tmp_path / "c"), writer="stream").awaitTermination()
    store.write_rollups(events, path, "more")
    raw = store.publish(events, "event_time").select("value", F.col("event_time").alias("arrival"))
    raw.write.parquet(str(tmp_path / "raw"))
    feed = spark.readStream.schema("value string, arrival timestamp").parquet(str(tmp_path / "raw"))
    fanout.fan_out(feed, str(tmp_path / "fan"), str(tmp_path / "c2"), writer="fan").awaitTermination()
    assert seen == dict.fromkeys(("stream", "more", "fan"), -(-9 * n // 100))
    assert int(spark.conf.get(session.PARTITIONS)) == 4
    before = settled(spark, path)
    monkeypatch.setattr(session, "TASK_BYTES", 10_000)
    few = store.settled(store.read_store(spark, path))
    assert "REPARTITION_BY_NUM" in few._jdf.queryExecution().executedPlan().toString()
    assert settled(spark, path) == before


def test_feeds_have_as_many_files_as_the_rows_need(spark, events, tmp_path):
    """A large feed has several files for each turn, yet the same three batches."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "2k")
    try:
        feed = plans._feed(spark, events.repartition(8), str(tmp_path / "in"))
    finally:
        spark.conf.unset(size)
    rollups.rollups_to_store(feed, str(tmp_path / "store"), str(tmp_path / "c"), ["PT1H"], ["REGION"], writer="w").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "in")).count() == events.count()
    assert len(list((tmp_path / "in").rglob("*.parquet"))) > 3
    assert 1 <= versions.load(spark, str(tmp_path / "store")).done["w"] <= 2
    assert settled(spark, str(tmp_path / "store")) == rows(keyed(rollup_all(events, ["REGION"], ["PT1H"])).select(*ITEM))


def test_counts_compare_only_rows_of_several_parts(spark, events, tmp_path, monkeypatch):
    path, plan, write = str(tmp_path / "store"), [], versions.write_parts

    def told(df, base, table, *rest, **options):
        if table == store.COUNTS:
            plan.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, base, table, *rest, **options)

    monkeypatch.setattr(versions, "write_parts", told)
    parts = items(events), items(events.where("event_time < timestamp'2024-01-03'"))
    for k, part in enumerate(parts):
        store.write_store(part, path, batch=f"b{k}")
        store.refresh(spark, path)
        own = store.counts(spark, path).select("event_date", "grain", "period", "pk", "n")
        want = store.with_date(parts[0]).groupBy("event_date", "grain", "period", "pk").agg(F.count("*").alias("n"))
        assert rows(own) == rows(want)
        assert "sk#" not in plan[0]
    assert "sk#" in plan[1]
