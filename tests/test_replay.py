"""Replay against the plain one-by-one ledger."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from brute import money, replay as one_by_one
from pyspark.sql import functions as F

from sluice.operators import ledger, replay as replay_module
from sluice.operators.replay import replay
from sluice.operators.running import running_total
from sluice.session import _shared
from sluice.sources import tables

COMMANDS = "cmd_id bigint, ts timestamp_ntz, kind string, src bigint, dst bigint, amount decimal(18,2)"
ACCOUNTS = "acc_id bigint, opening decimal(18,2)"
T0 = datetime(2024, 1, 1)


def command(n, ts, src, dst, cents):
    kind = "MoneyDeposit" if src is None else "MoneyWithdraw" if dst is None else "MoneyTransfer"
    return (n, ts, kind, src, dst, money(cents))


def run(spark, commands, openings, partitions):
    df = spark.createDataFrame(commands, COMMANDS)
    acc = spark.createDataFrame(list(openings.items()), ACCOUNTS)
    verdicts = replay(df, acc, partitions)
    got = {r.cmd_id: (r.accepted, r.reason) for r in verdicts.collect()}
    return df, acc, verdicts, got


def made_up(seed, n, accounts, hot_share, ties, transfer_share=0.5):
    """Random commands in which one account takes a given share and money is short."""
    rnd = random.Random(seed)
    openings = {a: money(rnd.choice([-500, 0, 1000, 20000])) for a in range(accounts)}

    def pick():
        return 0 if rnd.random() < hot_share else rnd.randrange(-1, accounts)

    out = []
    for i in range(n):
        ts = T0 + timedelta(seconds=rnd.randrange(n // ties + 1))
        cents = rnd.choice([0, 99, 100, 199, rnd.randrange(100, 30000)])
        x = rnd.random()
        if x < transfer_share:
            out.append(command(i, ts, pick(), pick(), cents))
        elif x < (1 + transfer_share) / 2:
            out.append(command(i, ts, None, pick(), cents))
        else:
            out.append(command(i, ts, pick(), None, cents))
    return out, openings


@pytest.mark.parametrize("partitions, wave", [(1, 50_000), (3, 20), (16, 150), (5, 0)])
def test_hot_account_and_ties(spark, monkeypatch, partitions, wave):
    """With all, some and few of the open commands in a wave."""
    monkeypatch.setattr(replay_module, "WAVE", wave or 10)
    commands, openings = made_up(1, 900, 12, 0.4, 5)
    want, closing = one_by_one(commands, openings)
    df, acc, verdicts, got = run(spark, commands, openings, partitions)
    assert got == want
    balances = ledger.closing_balances(ledger.postings(verdicts), acc)
    assert {r.acc_id: r.balance for r in balances.collect()} == closing


@pytest.mark.parametrize("partitions", [1, 8])
def test_one_account_only(spark, partitions):
    """All commands on one account, with withdrawals that exceed the balance all the time."""
    commands, openings = made_up(2, 1000, 1, 1.0, 1, transfer_share=0)
    want, _ = one_by_one(commands, openings)
    assert run(spark, commands, openings, partitions)[3] == want


def rounds(spark):
    """Rounds of the newest replay, by the folders of its tables."""
    base = Path(_shared(spark).removeprefix("file:"))
    newest = max(base.glob("replay-*"), key=lambda p: p.stat().st_mtime)
    return len(list(newest.glob("step=*")))


@pytest.mark.parametrize("links, wave", [(200, 50_000), (2000, 50_000), (200, 60)])
def test_chain(spark, monkeypatch, links, wave):
    """Each transfer can be paid only from the one before."""
    monkeypatch.setattr(replay_module, "WAVE", wave)
    openings = {a: money(0) for a in range(links + 1)}
    commands = [command(0, T0, None, 0, 10000)]
    commands += [command(i + 1, T0 + timedelta(seconds=i + 1), i, i + 1, 10000) for i in range(links)]
    early = [command(10**6 + i, T0 + timedelta(seconds=i, milliseconds=500), i + 1, None, 10000) for i in range(links)]
    commands += early  # one withdrawal per account before the money gets there
    want, _ = one_by_one(commands, openings)
    assert run(spark, commands, openings, 4)[3] == want
    # After the first round, one for each wave that the open commands fill, and one of bounds.
    assert rounds(spark) <= 2 + -(-2 * links // wave)
    assert want[links] == (True, None) and not any(want[c[0]][0] for c in early)


def test_all_at_the_same_time(spark):
    """Only the command id tells what comes first."""
    commands, openings = made_up(4, 400, 6, 0.3, 10**9)
    want, _ = one_by_one(commands, openings)
    assert len({c[1] for c in commands}) == 1
    assert run(spark, commands, openings, 5)[3] == want


def test_edges(spark):
    openings = {1: money(10000), 2: money(0)}
    commands = [
        command(1, T0, 1, None, 99),  # below one whole unit
        command(2, T0, 1, None, 199),  # fractions above one unit count in full
        command(3, T0, 1, 1, 500),
        command(4, T0, 9, None, 500),
        command(5, T0, None, 9, 500),
        command(6, T0, 1, 9, 500),
        command(7, T0, 1, 2, 9801),  # exactly what is left
        command(8, T0, 1, None, 100),
        command(9, T0, 2, 1, 9802),
        command(10, T0, None, 1, -500),
    ]
    want, _ = one_by_one(commands, openings)
    got = run(spark, commands, openings, 3)[3]
    assert got == want
    assert want[2] == (True, None) and want[7] == (True, None) and want[8] == (False, "Insufficient balance")


def test_transfers_of_the_test_tables(spark, small):
    cmds, acc = tables.commands(spark, small), tables.accounts(spark, small)
    rows = [tuple(r) for r in cmds.select("cmd_id", "ts", "kind", "src", "dst", "amount").collect()]
    openings = {r.acc_id: r.opening for r in acc.collect()}
    want, closing = one_by_one(rows, openings)
    verdicts = replay(cmds, acc)
    assert {r.cmd_id: (r.accepted, r.reason) for r in verdicts.collect()} == want
    posted = ledger.postings(verdicts)
    assert {r.acc_id: r.balance for r in ledger.closing_balances(posted, acc).collect()} == closing
    # two postings per transfer, and no money made or lost inside the bank
    per = {r.cmd_id: r for r in posted.groupBy("cmd_id", "kind").agg(
        F.count("*").alias("n"), F.sum(ledger.signed()).alias("net")).collect()}
    for r in per.values():
        assert r.n == (2 if r.kind == "MoneyTransfer" else 1)
        assert r.kind != "MoneyTransfer" or r.net == 0
    # the last line of each statement is the closing balance
    lines = ledger.statement(posted, acc).collect()
    last = {}
    for r in sorted(lines, key=lambda r: (r.ts, r.cmd_id)):
        last[r.acc_id] = r.balance
    assert last == {a: closing[a] for a in last}


@pytest.mark.parametrize("partitions", [1, 5, 32])
def test_running_total_with_a_hot_key(spark, partitions):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.6 else rnd.randrange(1, 30), i, rnd.randrange(-50, 50)) for i in range(4000)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, v bigint")
    want, sums = {}, {}
    for k, o, v in rows:
        sums[k] = sums.get(k, 0) + v
        want[(k, o)] = sums[k]
    got = running_total(df, "k", ["o"], "v", "total", partitions).collect()
    assert {(r.k, r.o): r.total for r in got} == want and len(got) == len(rows)


def test_statement_of_one_account(spark, small):
    cmds, acc = tables.commands(spark, small), tables.accounts(spark, small)
    posted = ledger.postings(replay(cmds, acc)).cache()
    account = posted.groupBy("acc_id").count().orderBy(F.desc("count"), "acc_id").first().acc_id
    one = ledger.statement(posted, acc, account)
    times = [(r.ts, r.cmd_id) for r in one.collect()]
    assert times == sorted(times)
    whole = ledger.statement(posted, acc).filter(F.col("acc_id") == account)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, whole.collect()))
    short = ledger.short_statement(posted).filter(F.col("acc_id") == account).collect()
    assert all(r.kind == "MoneyDeposit" or (r.kind == "MoneyTransfer" and r.indicator == "Debit") for r in short)


def test_account_openings(spark):
    rows = [(1, T0, 7, money(100)), (2, T0, 7, money(300)), (3, T0 - timedelta(days=1), 7, money(900)), (4, T0, 8, money(5))]
    made = ledger.open_accounts(
        spark.createDataFrame(rows, "cmd_id bigint, ts timestamp_ntz, acc_id bigint, init_balance decimal(18,2)")
    )
    got = {r.acc_id: (r.balance, r.indicator, r.n_creations) for r in made.collect()}
    assert got == {7: (money(300), "Credit", 3), 8: (money(5), "Credit", 1)}
    assert ledger.customer_data(made).filter("overdraft_allowed").count() == 0
