"""Stored verdicts and balances of a ledger, so that new commands are replayed alone.

Verdicts lie by month of their commands. With each run goes a snapshot of all balances, the openings of the next one: when a
run ends every command up to its last one is decided, so nothing is left open at the cut. Both come with one version.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.time import MONTH_KEY
from sluice.operators.ledger import closing_balances, postings
from sluice.operators.replay import replay
from sluice.schema import columns
from sluice.sinks import versions
from sluice.sinks.versions import Version

VERDICTS, BALANCES, LEDGER = "verdicts", "balances", "ledger"
MONTH = ["month"]
ROW = columns("cmd_id bigint, ts timestamp_ntz, kind string, src bigint, dst bigint, amount money, accepted boolean, reason string, writer string, batch string, month string")
BALANCE = columns("acc_id bigint, balance money, writer string, batch string, cut string")


def last_applied(now: Version) -> tuple[int, int] | None:
    """Time, in microseconds, and number of the last command that the ledger holds."""
    own = now.totals.get(LEDGER)
    return (own["at"], own["cmd_id"]) if own else None


def apply(commands: DataFrame, path: str, accounts: DataFrame | None = None) -> Version:
    """Replays commands, all later than those that the ledger holds, and adds their verdicts. The first run takes the
    opening balances of ``accounts`` (``acc_id``, ``opening``); later ones add accounts that are new in it."""
    spark, now = commands.sparkSession, versions.load(commands.sparkSession, path)
    order = F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "cmd_id")
    ends = commands.agg(F.min(order).alias("first"), F.max(order).alias("last")).first()
    if ends["last"] is None:
        return now
    before = last_applied(now)
    if before and tuple(ends["first"]) <= before:
        raise ValueError("a command is not later than those that the ledger holds")
    openings = read_balances(spark, path, now.number or None).withColumnRenamed("balance", "opening")
    if accounts is not None:
        added = accounts.select("acc_id", "opening")
        openings = openings.unionByName(added.join(openings, "acc_id", "left_anti")) if before else added
    batch = f"v{now.number}"
    rows = replay(commands, openings).select(*ROW.names[:8]).withColumn("month", F.date_format("ts", MONTH_KEY))
    written = versions.write_parts(rows.hint("rebalance", *MONTH), path, VERDICTS, MONTH, LEDGER, batch)
    decided = _verdicts(spark, path, {p: [f] for p, f in written.items()})
    closed = closing_balances(postings(decided), openings).withColumn("cut", F.lit(batch))
    snapshot = versions.write_parts(closed, path, BALANCES, ["cut"], LEDGER, batch)

    def change(newest: Version) -> Version:
        if last_applied(newest) != before:
            raise RuntimeError("someone else has applied commands meanwhile")
        after = newest.with_parts(VERDICTS, written).with_parts(BALANCES, snapshot, lambda place, folder: True)
        return replace(after, totals={**newest.totals, LEDGER: ends["last"].asDict()})

    return versions.commit(spark, path, change)


def _verdicts(spark: SparkSession, path: str, folders: dict[str, list[str]]) -> DataFrame:
    return versions.read_parts(spark, path, VERDICTS, ROW, MONTH[0], folders).drop("writer", "batch")


def read_verdicts(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, version: int | None = None) -> DataFrame:
    """Commands of the months from ``first`` to ``last`` (as 2024-01) with ``accepted`` and ``reason``."""
    folders = versions.load(spark, path, version).folders(VERDICTS)
    return _verdicts(spark, path, versions.within(folders, first, last))


def read_balances(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Balance of every account after all commands that the ledger holds."""
    folders = versions.load(spark, path, version).folders(BALANCES)
    return versions.read_parts(spark, path, BALANCES, BALANCE, "cut", folders).select("acc_id", "balance")
