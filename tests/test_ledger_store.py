"""The stored ledger, and creations in the ledger's order."""

from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import pytest
from brute import money
from test_replay import ACCOUNTS, COMMANDS, T0, command, made_up

from sluice.operators import creations, ledger
from sluice.operators.replay import replay
from sluice.sinks import ledger as stored
from sluice.sinks import versions


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_two_runs_equal_one(spark, tmp_path):
    path = str(tmp_path / "l")
    commands, openings = made_up(7, 600, 15, 0.3, 3)
    df, acc = spark.createDataFrame(commands, COMMANDS), spark.createDataFrame(list(openings.items()), ACCOUNTS)
    whole = replay(df, acc)
    assert versions.load(spark, path).number == 0 and stored.read_balances(spark, path).isEmpty()
    cut = sorted(c[1] for c in commands)[300]
    early, late = (spark.createDataFrame([c for c in commands if (c[1] < cut) == first], COMMANDS) for first in (True, False))
    stored.apply(early, path, acc.where("acc_id <> 99"))
    halfway = stored.read_balances(spark, path)
    assert rows(halfway) == rows(ledger.closing_balances(ledger.postings(replay(early, acc)), acc))
    old = versions.load(spark, path).number
    stored.apply(late, path)
    names = ["cmd_id", "accepted", "reason"]
    assert rows(stored.read_verdicts(spark, path).select(*names)) == rows(whole.select(*names))
    assert rows(stored.read_balances(spark, path)) == rows(ledger.closing_balances(ledger.postings(whole), acc))
    assert rows(stored.read_balances(spark, path, old)) == rows(halfway)  # a reader of the old version
    with pytest.raises(ValueError, match="not later"):
        stored.apply(late, path)
    assert stored.apply(late.where("false"), path).number == versions.load(spark, path).number
    # An account that is new enters with its opening.
    new = spark.createDataFrame([(77, money(500))], ACCOUNTS)
    stored.apply(spark.createDataFrame([command(10**6, T0 + timedelta(days=90), 77, None, 400)], COMMANDS), path, new)
    assert stored.read_balances(spark, path).where("acc_id = 77").first().balance == money(100)
    assert stored.read_verdicts(spark, path, "2024-03", "2024-03").count() == 1


def plain(commands, accounts, made):
    """One by one, creations before a command of the same time and number."""
    has, out, lines = dict(accounts), {}, []
    every = [(c[1], c[0], 1, c) for c in commands] + [(ts, n, 0, (acc, opening)) for n, ts, acc, opening in made]
    for ts, n, kind, c in sorted(every, key=lambda e: e[:3]):
        if kind == 0:
            has[c[0]] = c[1]
            continue
        src, dst, amount = c[3:]
        if int(amount) <= 0:
            out[n] = "Invalid amount"
        elif src is not None and src == dst:
            out[n] = "Same source and destination accounts not allowed"
        elif any(a is not None and a not in has for a in (src, dst)):
            out[n] = "No account data found"
        elif src is not None and has[src] < amount:
            out[n] = "Insufficient balance"
        else:
            out[n] = None
            for acc, sign in ((src, -1), (dst, 1)):
                if acc is not None:
                    has[acc] += sign * amount
                    lines.append((acc, n, has[acc]))
    return out, has, Counter(lines)


@pytest.mark.parametrize("partitions", [2, 9])
def test_creations_cut_a_hot_account_into_segments(spark, partitions):
    commands, openings = made_up(5, 700, 8, 0.4, 2)
    rnd = random.Random(4)
    openings = {a: v for a, v in openings.items() if a % 3}  # account 0, the hot one, and others come later
    made = [(10**6 + k, T0 + timedelta(seconds=rnd.randrange(350)), rnd.choice([0, 0, 3, 6, 1, 9]), money(rnd.choice([0, 500, 30000]))) for k in range(25)]
    made.append((commands[350][0], commands[350][1], 0, money(700)))  # with the time and number of a command
    want, closing, lines = plain(commands, openings, made)
    frames = (
        spark.createDataFrame(commands, COMMANDS),
        spark.createDataFrame(list(openings.items()), ACCOUNTS),
        spark.createDataFrame(made, "cmd_id bigint, ts timestamp_ntz, acc_id bigint, init_balance decimal(18,2)"),
    )
    done, segments = creations.replay_with_creations(*frames, partitions)
    assert {r.cmd_id: r.reason for r in done.collect()} == want and all(r.accepted == (r.reason is None) for r in done.collect())
    assert {r.acc_id: r.balance for r in creations.closing_balances(done, segments).collect()} == closing
    assert Counter((r.acc_id, r.cmd_id, r.balance) for r in creations.statement(done, segments).collect()) == lines
    assert set(Counter(want.values())) >= {None, "No account data found", "Insufficient balance"}
