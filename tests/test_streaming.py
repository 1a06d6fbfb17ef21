"""Streams against the batch jobs over the same rows."""

from __future__ import annotations

import base64
import json
from collections import Counter
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from brute import money
from brute import replay as one_by_one
from pyspark.sql import functions as F
from test_ledger_store import plain as one_by_one_with_creations
from test_replay import ACCOUNTS, COMMANDS, T0, made_up

from sluice.operators.intake import load_stats
from sluice.operators.rollup import keyed, minutes, rollup, rollup_all
from sluice.schema import GRAINS, KPI_SUMS, PERIODS
from sluice.sinks import store, wide
from sluice.sources import streams, tables
from sluice.streaming import delivery, fanout, intake, ledger, rollups


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def feed(spark, small, tmp_path_factory):
    """Events as eight files in order of arrival, as a folder source sees them."""
    path = str(tmp_path_factory.mktemp("feed"))
    events = tables.kpi_events(spark, small).orderBy("ingest_time", "event_id").collect()
    step = -(-len(events) // 8)
    schema = tables.kpi_events(spark, small).schema
    for i in range(0, len(events), step):
        spark.createDataFrame(events[i : i + step], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def test_rollups_of_batches_out_of_order_lose_nothing(spark, small, tmp_path):
    events = tables.kpi_events(spark, small)
    path, out, check = (str(tmp_path / n) for n in ("in", "store", "check"))
    mixed = events.orderBy(F.xxhash64("event_id")).collect()
    for k in range(0, len(mixed), 300):
        spark.createDataFrame(mixed[k : k + 300], events.schema).coalesce(1).write.mode("append").parquet(path)
    source = streams.typed_folder(spark, path, files_per_batch=1)
    for _ in range(2):  # a restart from the checkpoint adds nothing
        rollups.rollups_to_store(source, out, check, ["PT1H"]).awaitTermination()
        stored = store.read_store(spark, out)
        assert stored.filter("grain = 'STORE'").agg(F.sum("n_rec")).first()[0] == events.count()
        want = keyed(rollup_all(events, periods=["PT1H"]))
        assert rows(store.settled(stored).select(want.columns)) == rows(want)
    assert stored.count() > want.count()  # partial rows, from more than one batch


def test_writers_share_a_store(spark, small, feed, tmp_path):
    events, out = tables.kpi_events(spark, small), str(tmp_path / "store")
    for period in ("PT1H", "PT10M"):
        source = streams.typed_folder(spark, feed, files_per_batch=4)
        rollups.rollups_to_store(source, out, str(tmp_path / period), [period]).awaitTermination()
    store.write_store(keyed(rollup_all(events, periods=["PT1M"])), out)
    want = keyed(rollup_all(events))
    assert rows(store.settled(store.read_store(spark, out)).select(want.columns)) == rows(want)


def test_json_events_from_a_folder(spark, tmp_path):
    lines = [
        {"event-time": "2024-01-01T00:00:01.250", "state": "AM", "region": "NORTH", "store-id": 3,
         **{f"kpi-{i}": i for i in range(1, 8)}},
        {"event-time": "2024-01-01T00:00:02", "state": "MA", "region": "NORTHEAST", "store-id": 4, "kpi-1": -2},
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*map(json.dumps, lines), "{broken", '{"event-time": "never"}']))
    raw = streams.folder(spark, str(tmp_path / "in"), files_per_batch=1)
    parsed = streams.parse_events(raw)
    delivery.to_table(parsed, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    good = out.filter("bad_record IS NULL").orderBy("event_time").collect()
    assert [(r.region, r.state, r.store_id, r.kpi_1, r.kpi_5) for r in good] == [
        ("NORTH", "AM", 3, 1, 5), ("NORTHEAST", "MA", 4, -2, None),
    ]
    assert good[0].event_time.microsecond == 250000 and good[0].ingest_time is not None
    assert "kpi_6" not in out.columns
    assert {r.bad_record for r in out.filter("bad_record IS NOT NULL").collect()} == {"{broken", '{"event-time": "never"}'}
    # the archive keeps every record, broken ones too
    delivery.archive(raw, str(tmp_path / "raw"), str(tmp_path / "c2"), every=None).awaitTermination()
    assert spark.read.json(str(tmp_path / "raw")).count() == 4
    # a consumer that starts later finds nothing
    later = streams.folder(spark, str(tmp_path / "in"), since=datetime.now(timezone.utc) + timedelta(hours=1))
    delivery.to_table(later, str(tmp_path / "later"), str(tmp_path / "c3")).awaitTermination()
    assert spark.read.schema(later.schema).parquet(str(tmp_path / "later")).count() == 0


def record(**fields):
    base = {"type": "BY_REGION_PT1M", "region": "SOUTH", "state": "PR", "store-id": 5, "N_REC": 2,
            "EVENT_TIME": "2024-01-01 00:01:00.000", "INGEST_TIME": "2024-01-01 00:02:00.000",
            **{f"KPI_{i}_SUM": 10 * i for i in range(1, 6)}}
    data = {k: v for k, v in {**base, **fields}.items() if v is not None}
    return base64.b64encode(json.dumps(data).encode()).decode()


RECORDS = [
    record(),
    record(type="by_store_pt10m"),
    record(type="BY_STATE_PT1H", state=None),  # no key part: error
    record(type="BY_STORE_PT1H", **{"store-id": None}),
    record(type="BY_CITY_PT5M"),  # unknown: dead letter
    record(type=None),
    record(region=None),
    record(KPI_3_SUM=None),
    record(EVENT_TIME=None, INGEST_TIME=None, N_REC=None, state=None),
    "not base64 !!",
    base64.b64encode(b"{not json").decode(),
]


def check_intake(spark, base):
    items = spark.read.parquet(f"{base}/items")
    keys = {r.sk.split("#")[0] + "|" + r.pk for r in items.collect()}
    assert keys == {"PT1M|SOUTH", "PT10M|SOUTH#PR#5"}
    defaults = items.filter("n_rec = 0").first()
    assert (defaults.state, str(defaults.event_time)) == ("NN", "2019-01-01 00:00:00")
    dead = spark.read.parquet(f"{base}/dead")
    assert [(r.pk, r.sk.split("#")[0]) for r in dead.collect()] == [("SOUTH", "UNK")] * 2
    stats = {(r.stat, r.key): r.n for r in spark.read.parquet(f"{base}/stats").collect()}
    aside = spark.read.parquet(f"{base}/dead_quarantine")
    assert items.count() + dead.count() + aside.count() == len(RECORDS)
    assert {r.data for r in aside.filter("reason = 'bad_payload'").collect()} == set(RECORDS[-2:])
    assert stats[("total", "all")] == 11 and stats[("total", "ok")] == 3 and stats[("total", "err")] == 8
    assert stats[("grain", "REGION")] == 2 and stats[("region", "SOUTH")] == 2
    assert stats[("period", "UNK")] == 2 and stats[("period", "PT1M")] == 2


def test_intake_of_envelopes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(RECORDS))
    source = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "data")
    b = str(tmp_path)
    paths = f"{b}/items", f"{b}/dead", f"{b}/stats"
    delivery.to_intake(source, *paths, f"{b}/c").awaitTermination()
    check_intake(spark, b)
    # the same batch delivered again replaces its rows
    again = spark.createDataFrame([(r,) for r in RECORDS], "data string")
    delivery.intake_batch(*paths)(again, 0)
    check_intake(spark, b)
    # delivered in a later batch with new sums, it wins over the same key of the earlier batch
    newer = spark.createDataFrame([(record(KPI_1_SUM=77),)], "data string")
    delivery.intake_batch(*paths)(newer, 1)
    items = spark.read.parquet(paths[0])
    now = store.current_items(items)
    assert items.count() == now.count() + 1
    assert [r.kpi1 for r in now.filter("sk LIKE 'PT1M#2024-01-01 00:01%'").collect()] == [77]


def test_json_output(spark, feed, tmp_path):
    source = streams.typed_folder(spark, feed)
    wide_rows = source.select(
        "event_id", (F.col("kpi_1") + F.col("event_id") % 2 * 0.5).cast("decimal(10,1)").alias("amount"), "region"
    )
    delivery.to_json_files(wide_rows, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    want = {r.event_id: r.kpi_1 + r.event_id % 2 * 0.5 for r in spark.read.parquet(feed).collect()}
    assert {g["event_id"]: g["amount"] for g in got} == want
    assert all(isinstance(g["amount"], int) == (g["event_id"] % 2 == 0) for g in got)


def test_account_stream_equals_replay(spark, small, tmp_path):
    cmds = tables.commands(spark, small).filter("kind <> 'MoneyTransfer'")
    acc = tables.accounts(spark, small)
    path = str(tmp_path / "in")
    ordered = cmds.orderBy("ts", "cmd_id").collect()
    for part in (ordered[:400], ordered[400:]):
        spark.createDataFrame(part, cmds.schema).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(cmds.schema).option("maxFilesPerTrigger", 1).parquet(path)
    stream = ledger.account_stream(source, acc)
    delivery.to_table(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = {r.cmd_id: (r.accepted, r.reason) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want, _ = one_by_one([tuple(r) for r in ordered], {r.acc_id: r.opening for r in acc.collect()})
    assert got == want


@pytest.mark.parametrize("held", [40, 100_000])
def test_account_stream_with_a_hot_account_and_late_ones(spark, tmp_path, held):
    """An account with a third of the feed, in pieces, and creations among the rows."""
    commands, openings = made_up(9, 900, 20, 0.35, 2, transfer_share=0)
    openings = {a: v for a, v in openings.items() if a % 4 != 1 and a}
    made = [(10**6 + k, T0 + timedelta(seconds=29 * k), [0, 0, 5, 1][k % 4], money(100 * k)) for k in range(12)]
    want, _, lines = one_by_one_with_creations(commands, openings, made)
    feeds = []
    for name, data, schema in (("commands", commands, COMMANDS), ("made", made, "cmd_id bigint, ts timestamp_ntz, acc_id bigint, init_balance decimal(18,2)")):
        spark.createDataFrame(data, schema).repartition(3).write.parquet(str(tmp_path / name))
        feeds.append(spark.readStream.schema(schema).parquet(str(tmp_path / name)))
    acc = spark.createDataFrame(list(openings.items()), ACCOUNTS)
    stream = ledger.account_stream(feeds[0], acc, feeds[1], held, timedelta(seconds=30))
    delivery.to_table(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.cmd_id: r.reason for r in got} == want and len(got) == len(commands)
    assert Counter((r.acc_id, r.cmd_id, r.balance) for r in got if r.accepted) == lines


def test_decisions_equal_one_by_one():
    rng = np.random.default_rng(3)
    for n, start in ((0, 5), (1, -3), (3000, 40), (5000, 0)):
        change, valid = rng.integers(-30, 30, n), rng.random(n) < 0.9
        cents, want = start, []
        for c, v in zip(change.tolist(), valid.tolist(), strict=True):
            ok = v and not (c < 0 and cents + c < 0)
            cents += c if ok else 0
            want.append((ok, cents))
        accepted, after = ledger.decide(start, change, valid)
        assert list(zip(accepted.tolist(), after.tolist(), strict=True)) == want


def test_decisions_of_many_balances_equal_one_by_one():
    rng = np.random.default_rng(4)
    size = np.append(rng.integers(0, 9, 400), [ledger.SHORT + 1, 0, 3 * ledger.BLOCK, 1])
    change, valid, cents = rng.integers(-30, 30, size.sum()), rng.random(size.sum()) < 0.9, rng.integers(-5, 40, len(size))
    accepted, after = ledger.decide_each(cents, size, change, valid)
    for k, own in enumerate(np.split(np.arange(size.sum()), np.cumsum(size)[:-1])):
        want = ledger.decide(int(cents[k]), change[own], valid[own])
        assert accepted[own].tolist() == want[0].tolist() and after[own].tolist() == want[1].tolist()


class Kept:
    """State of one key in memory."""

    def __init__(self):
        self.value, self.rows = None, {}
        self.get, self.exists = lambda: self.value, lambda: self.value is not None
        self.getValue, self.clear = self.rows.get, self.rows.clear

    def update(self, value):
        self.value = value

    def updateValue(self, key, value):
        self.rows[key] = value


def test_a_group_with_many_rows_goes_by_pieces(monkeypatch):
    """The same verdicts and balances, however many rows of a group or of an account are held."""
    rng, n = np.random.default_rng(6), 4000
    acc = np.where(rng.random(n) < 0.3, 3, rng.integers(0, 60, n))
    rows = np.stack([acc, rng.integers(0, 10**8, n), rng.random(n) > 0.02, np.arange(n), rng.integers(-30, 30, n), rng.random(n) < 0.9], 1).astype(np.int64)
    found = []
    for held, of_group in ((10**6, 10**6), (50, 10**6), (10**6, 900), (50, 700)):
        monkeypatch.setattr(ledger, "HELD_OF_GROUP", of_group)
        own = ledger.AccountBalance(held, timedelta(seconds=9))
        own.balances, own.pieces = Kept(), Kept()
        for k in (0, 20):  # the group's balances come in chunks
            own.handleInitialState((0,), pd.DataFrame({"acc_id": range(k, k + 20), "opening": range(20)}), None)
        out = pd.concat(own.handleInputRows((0,), (pd.DataFrame(c, columns=ledger.ROW) for c in np.array_split(rows, 13)), None))
        found.append((sorted(map(str, out.itertuples(index=False))), own.balances.value))
        assert not own.pieces.rows
    assert all(f == found[0] for f in found) and len(found[0][0]) == (rows[:, 2] == 1).sum()


def test_account_state_grows_by_groups_and_not_by_accounts(spark, tmp_path):
    """Two batches; accounts share the keys of the state, and rows without an account or a balance are kept apart."""
    n = 3 * ledger.GROUPS
    acc = spark.range(n).selectExpr("id as acc_id", "cast(if(id = 5, null, 10) as decimal(18,2)) as opening")
    schema = "cmd_id bigint, ts timestamp_ntz, kind string, src bigint, dst bigint, amount decimal(18,2)"
    for at in (1, 2):
        cmds = spark.range(n).selectExpr(f"id * 10 + {at} as cmd_id", f"timestamp_ntz'2024-01-0{at} 00:00:00' as ts", "'MoneyWithdraw' as kind", "id as src", "cast(null as bigint) as dst", "cast(7 as decimal(18,2)) as amount")
        odd = spark.createDataFrame([(-at, datetime(2024, 1, at), "MoneyDeposit", None, None, money(500)), (-10 - at, None, "MoneyDeposit", None, 6, None)], schema)
        cmds.unionByName(odd).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = delivery.to_table(ledger.account_stream(source, acc), str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination()
    assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= ledger.GROUPS
    got = {r.cmd_id: (r.acc_id, r.reason, r.balance) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 2 * n + 4
    assert got.pop(-1) == got.pop(-2) == (None, "No account data found", None)
    assert [got.pop(-k)[1] for k in (11, 12)] == ["Invalid amount"] * 2
    assert got.pop(51) == got.pop(52) == (5, "No account data found", None)
    # Whichever of the two batches came first has what the account held.
    assert Counter(v for k, v in got.items() if k // 10 == 7) == Counter({(7, None, money(300)): 1, (7, "Insufficient balance", money(300)): 1})
    assert Counter(v[1] for v in got.values()) == Counter({None: n - 1, "Insufficient balance": n - 1})


def test_intake_in_one_job(spark, tmp_path):
    """The same counts as of the batch, also for regions that the dimension does not know; a restart adds nothing."""
    (tmp_path / "in").mkdir()
    records = [*RECORDS, record(region="ELSEWHERE"), record(type="BY_STATE_PT1H", state="ZZ")]
    (tmp_path / "in" / "a.txt").write_text("\n".join(records))
    source = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "data")
    for _ in range(2):
        intake.take_in(source, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
        kept = intake.read_intake(spark, str(tmp_path / "s"))
        assert kept.count() == len(records) and {r.data for r in kept.where("reason = 'bad_payload'").collect()} == set(RECORDS[-2:])
        assert {r.status for r in intake.read_intake(spark, str(tmp_path / "s"), "ok", "dead_letter").collect()} == {"ok", "dead_letter"}
        assert rows(fanout.delivered(spark, str(tmp_path / "s"))) == rows(load_stats(kept))
    assert ("region", "ELSEWHERE", 1) in rows(fanout.delivered(spark, str(tmp_path / "s")))


def test_store_sinks(spark, small, tmp_path):
    events = tables.kpi_events(spark, small)
    items = keyed(rollup(events, "STATE", "PT1H"))
    path = str(tmp_path / "store")
    store.write_store(items, path)
    assert rows(store.read_store(spark, path).select(items.columns)) == rows(items)
    store.purge(spark, path)
    assert store.read_store(spark, path).count() == 0
    raw = store.publish(events).select("value", F.lit(None).cast("timestamp").alias("arrival"))
    assert streams.parse_events(raw).filter("bad_record is null").count() == events.count()
    published = store.publish(events).first()
    assert published.key == "#".join(json.loads(published.value)[k] for k in ("region", "state"))
    store.write_by_place(events, str(tmp_path / "place"))
    assert spark.read.parquet(str(tmp_path / "place")).count() == events.count()
    wide.append(events, str(tmp_path / "plain"))
    wide.append(events, str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2 * events.count()


def test_rollups_agree_with_each_other(spark, small):
    """Regions, states and stores add up alike, in all periods and from minutes or events."""
    events = tables.kpi_events(spark, small)
    all_rows = rollup_all(events).cache()
    assert rows(all_rows) == rows(rollup_all(events, from_minutes=False))
    sums = [F.sum(c).alias(c) for c in [*KPI_SUMS, "n_rec"]]
    hour = F.date_trunc("hour", "event_time").alias("h")
    per_type = all_rows.groupBy("type", "region", hour).agg(*sums).drop("type")
    assert per_type.distinct().count() * len(PERIODS) * len(GRAINS) == per_type.count()
    assert minutes(events).agg(F.sum("n_rec")).first()[0] == events.count()
