"""Ordered replay of ledger commands under a balance guard, over all accounts at once.

A withdrawal or transfer is accepted only if the source account holds the amount
at that moment, so every decision hangs on earlier ones, also across accounts.
The replay decides in rounds, from bounds:

* Every command is split into legs, one per account, in global order of account
  and time, over range partitions ("chunks"). A hot account spreads over many.
* A round passes once over each chunk and keeps, for the account at hand, the
  lowest and highest balance it can have. A debit that fits the lowest is
  accepted, one that exceeds the highest is rejected, any other waits. A credit
  that waits for its debit elsewhere raises only the highest.
* Decisions then reach their credit legs by a join on the command, and what is
  left goes into the next round. Runs of decided legs shrink to one number on
  the next open leg, so a round's input is the open legs of the round before.
* An account that crosses a chunk border leaves a "tail" row per chunk, from
  which the next chunks take their starting bounds. There are at most two tails
  per chunk, so that table is bounded by the number of partitions.

* Chains of commands that hang on each other's outcome would need a round for each link. So where bounds decide less than
  half of what is open, or little is left, a wave goes over the earliest ``WAVE`` open commands: both legs of a command lie
  in the same stretch of time and all before it is decided, so balances are exact and one pass in order decides it whole.
  What it decides is input of the next round of bounds. A wave's size is fixed, so it is one task whatever the ledger's
  size, and there are at most as many rounds after the first as waves that the open commands fill, and bounds rounds
  that halve them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.money import to_cents
from sluice.operators.running import ordered_chunks
from sluice.session import scratch_folder

# --- fixed values: reason texts of a rejected command ---
INVALID_AMOUNT = "Invalid amount"
SAME_ACCOUNT = "Same source and destination accounts not allowed"
UNKNOWN_ACCOUNT = "No account data found"
TOO_LITTLE = "Insufficient balance"

NO_BOUND = 4 * 10**18  # cents; above any balance, with room to add without overflow
LAST = 2**63 - 1  # sorts a tail behind all legs of its account
UNSET = -(2**63)  # in place of starting bounds: the account starts in this chunk

#: Open commands that a wave decides.
WAVE = 50_000

LEG = "chunk int, acc bigint, at bigint, cmd_id bigint, side int, amount bigint, opening bigint, before bigint"
LEG_COLUMNS = [c.split()[0] for c in LEG.split(", ")]
OUT = f"{LEG}, accepted boolean, min_net bigint, max_net bigint, lo bigint, hi bigint, kind string"
LEG_AND_SURE = [*LEG_COLUMNS, "sure"]
FOLD_INPUT = [*LEG_AND_SURE, "lo", "hi"]


def static_reason(known: Column) -> Column:
    """Why a command is rejected whatever the balance; null if it is not. Checked in this order."""
    return (
        F.when(F.coalesce(F.col("amount").cast("bigint"), F.lit(0)) <= 0, INVALID_AMOUNT)
        .when(F.col("src") == F.col("dst"), SAME_ACCOUNT)
        .when(~known, UNKNOWN_ACCOUNT)
    )


def check(commands: DataFrame, accounts: DataFrame) -> DataFrame:
    """Commands with the opening balances of their accounts (cents) and the static reason."""
    opening = to_cents(F.col("opening"))
    src = accounts.select(F.col("acc_id").alias("src_key"), opening.alias("src_open"))
    dst = accounts.select(F.col("acc_id").alias("dst_key"), opening.alias("dst_open"))
    # A null account is outside the bank. Those rows match nothing, so they join on a
    # hash of the command instead of all meeting in the one partition of the null key.
    spread = F.xxhash64("cmd_id")
    joined = commands.join(src, F.coalesce("src", spread) == F.col("src_key"), "left").join(
        dst, F.coalesce("dst", spread) == F.col("dst_key"), "left"
    )
    known = (F.col("src").isNull() | F.col("src_key").isNotNull()) & (
        F.col("dst").isNull() | F.col("dst_key").isNotNull()
    )
    return joined.withColumn("reason", static_reason(known)).drop("src_key", "dst_key")


def replay(commands: DataFrame, accounts: DataFrame, partitions: int | None = None) -> DataFrame:
    """All commands with ``accepted`` and ``reason``, as applied in (ts, cmd_id) order.

    Rounds of bounds decide what no open command bears on, waves the earliest of the rest.

    Runs its Spark jobs at once; the outcome of each is a table in the shared
    scratch folder, which also holds the result.
    """
    spark = commands.sparkSession
    base = scratch_folder(spark, "replay")
    legs = _legs(check(commands, accounts).filter(F.col("reason").isNull()))
    first = ordered_chunks(legs, "acc", ["at", "cmd_id"], partitions).withColumns(
        {"before": F.lit(0).cast("bigint"), **_no_bounds()}
    )
    done = _run(first, _fold(first_round=True), base, 1)
    before = None
    for step in count(2):
        _, still_open = _count_open(done)
        if not still_open:
            break
        rows = _open_rows(done)
        if still_open <= WAVE or (before is not None and 2 * still_open > before):
            told = _wave(rows, base, step, still_open)
            if still_open <= WAVE:
                break
            rows = _applied(rows, told)
        before = still_open
        done = _run(_in_chunks(rows, _tails(done)), _fold(first_round=False), base, step)
    decided = (
        spark.read.schema(f"{OUT}, step int, part string")
        .parquet(base)
        .filter("kind = 'verdict'")
        .select("cmd_id", "accepted")
    )
    return _verdicts(commands, decided)


def _no_bounds() -> dict[str, Column]:
    return {c: F.lit(UNSET) for c in ("lo", "hi")}


def _legs(valid: DataFrame) -> DataFrame:
    amount = to_cents(F.col("amount"))
    debit = F.struct(
        F.col("src").alias("acc"), F.lit(-1).alias("side"), F.col("src_open").alias("opening"), F.lit(False).alias("sure")
    )
    credit = F.struct(
        F.col("dst").alias("acc"), F.lit(1).alias("side"), F.col("dst_open").alias("opening"), F.col("src").isNull().alias("sure")
    )
    return valid.select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        "cmd_id",
        amount.alias("amount"),
        F.inline(F.array(debit, credit)),
    ).filter(F.col("acc").isNotNull())


def _run(todo: DataFrame, fold, base: str, step: int, part: str = "bounds") -> DataFrame:
    """Runs one pass and returns its table."""
    path = f"{base}/step={step}/part={part}"
    todo.select(*FOLD_INPUT).mapInArrow(fold, OUT).write.partitionBy("kind").mode("overwrite").parquet(path)
    return todo.sparkSession.read.schema(OUT).parquet(path)


def _open(done: DataFrame) -> DataFrame:
    return done.filter("kind = 'leg'")


def _count_open(done: DataFrame) -> tuple[int, int]:
    """Number of open legs, and of debits among them."""
    return tuple(_open(done).agg(F.count("*"), F.count_if(F.col("side") < 0)).first())


def _tails(done: DataFrame) -> DataFrame:
    return done.filter("kind = 'tail'")


def _open_rows(done: DataFrame) -> DataFrame:
    """Open legs and tails of a round, with its decisions applied to the waiting credits."""
    legs = _open(done).select(*LEG_COLUMNS).withColumn("sure", F.lit(False))
    tails = _tails(done).select(*LEG_COLUMNS).withColumn("sure", F.lit(True))
    credits = _applied(legs.filter("side > 0"), done.filter("kind = 'verdict'"))
    return legs.filter("side < 0").unionByName(credits).unionByName(tails)


def _applied(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Open rows with decisions applied: a leg of a decided command is sure, and of a rejected one nothing."""
    verdicts = done.select("cmd_id", "accepted")
    rejected = F.coalesce(~F.col("accepted"), F.lit(False))
    told = rows.join(verdicts, "cmd_id", "left").withColumns(
        {"amount": F.when(rejected, 0).otherwise(F.col("amount")), "sure": F.col("sure") | F.col("accepted").isNotNull()}
    )
    return told.select(*LEG_COLUMNS, "sure")


def _wave(rows: DataFrame, base: str, step: int, still_open: int) -> DataFrame:
    """Decides the earliest ``WAVE`` open commands, or all if there are fewer, and returns their verdicts."""
    if still_open > WAVE:
        earliest = rows.filter("side < 0 and not sure").select("at", "cmd_id").orderBy("at", "cmd_id").limit(WAVE)
        at, cmd = earliest.agg(F.max(F.struct("at", "cmd_id")).alias("last")).select("last.*").first()
        rows = rows.filter((F.col("side") == 0) | (F.col("at") < at) | ((F.col("at") == at) & (F.col("cmd_id") <= cmd)))
    ordered = rows.withColumns({c: F.lit(0).cast("bigint") for c in ("lo", "hi")})
    # Tails come first: what an account gained in a chunk after its last open leg counts before its next chunk.
    ordered = ordered.repartition(1).sortWithinPartitions(F.abs("side"), "at", "cmd_id", "side", "chunk")
    return _run(ordered, _in_order, base, step, "wave")


def _in_chunks(rows: DataFrame, tails: DataFrame) -> DataFrame:
    """Each chunk in one task again, with new starting bounds. Chunks shrink, so AQE sets the task count."""
    return (
        rows.join(F.broadcast(_starts(tails)), ["chunk", "acc"], "left")
        .fillna(UNSET, ["lo", "hi"])
        .repartition("chunk")
        .sortWithinPartitions("chunk", "acc", "at", "cmd_id")
    )


def _starts(tails: DataFrame) -> DataFrame:
    """Bounds on an account's balance at the start of each of its chunks.

    The balance before a chunk is at least what it was after any earlier chunk
    plus the least that the chunks between can have added; the best of these
    counts. The highest is found likewise.
    """
    by_chunk = Window.partitionBy("acc").orderBy("chunk")
    upto = by_chunk.rowsBetween(Window.unboundedPreceding, 0)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    t = tails.withColumns({"s_min": F.sum("min_net").over(upto), "s_max": F.sum("max_net").over(upto)})
    low = F.greatest(F.col("opening"), F.max(F.col("lo") - F.col("s_min")).over(earlier))
    high = F.least(F.col("opening"), F.min(F.col("hi") - F.col("s_max")).over(earlier))
    floor = F.least(F.col("opening"), F.lit(0))  # guarded debits never take a balance below 0
    return t.select(
        "chunk",
        "acc",
        F.greatest(low + F.col("s_min") - F.col("min_net"), floor).alias("lo"),
        (high + F.col("s_max") - F.col("max_net")).alias("hi"),
    )


class _Account:
    """Bounds of one account within one chunk, and its open legs since the last open debit."""

    def __init__(self, chunk, acc, opening, lo, hi):
        self.chunk, self.acc, self.opening, self.lo, self.hi = chunk, acc, opening, lo, hi
        self.delta = self.min_net = self.max_net = 0
        self.waiting = []

    def move(self, change):
        self.lo += change
        self.hi += change
        self.delta += change
        self.min_net += change
        self.max_net += change

    def leave_open(self, at, cmd, side, amount):
        self.waiting.append((self.chunk, self.acc, at, cmd, side, amount, self.opening, self.delta))
        self.delta = 0

    def tail(self):
        leg = (self.chunk, self.acc, LAST, LAST, 0, 0, self.opening, self.delta)
        return (*leg, self.min_net, self.max_net, self.lo, min(self.hi, NO_BOUND))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows as tuples of plain numbers; no input column has nulls, so NumPy can unpack them."""
    return zip(*[c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns])


class _Output:
    """Collects verdicts, open legs and tails; gives them out as batches of the output columns."""

    def __init__(self):
        arrow = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
        self.schema = pa.schema([(name, arrow[kind]) for name, kind in (f.split() for f in OUT.split(", "))])
        self.clear()

    def clear(self):
        self.verdicts, self.legs, self.tails = {True: [], False: []}, [], []

    def batches(self) -> Iterator[pa.RecordBatch]:
        for accepted, cmds in self.verdicts.items():
            yield self._batch("verdict", {"cmd_id": cmds, "accepted": [accepted] * len(cmds)}, len(cmds))
        yield self._batch("leg", dict(zip(LEG_COLUMNS, zip(*self.legs))), len(self.legs))
        names = [*LEG_COLUMNS, "min_net", "max_net", "lo", "hi"]
        yield self._batch("tail", dict(zip(names, zip(*self.tails))), len(self.tails))
        self.clear()

    def _batch(self, kind: str, values: dict[str, list], n: int) -> pa.RecordBatch:
        values = {**values, "kind": [kind] * n}
        arrays = [pa.array(values[f.name], f.type) if f.name in values else pa.nulls(n, f.type) for f in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _fold(first_round: bool):
    """One pass over sorted legs, with one account's bounds as the only state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, accounts, out = None, 0, _Output()

        def may_go_on():
            # At a border of the chunk: the account may have more legs in the next one.
            out.legs += a.waiting
            out.tails.append(a.tail())
            a.waiting = []

        for batch in batches:
            if first_round and batch.num_rows:
                decided, rest = _clean(batch)
                out.verdicts[True] += batch.column(LEG_COLUMNS.index("cmd_id")).take(pa.array(decided)).to_pylist()
                batch = batch.take(pa.array(rest))
            for chunk, acc, at, cmd, side, amount, opening, before, sure, lo, hi in _rows(batch):
                if a is None or acc != a.acc or chunk != a.chunk:
                    if first_round and accounts == 1:
                        may_go_on()
                    accounts += 1
                    if first_round and accounts == 1 and chunk > 0:
                        lo, hi = min(opening, 0), NO_BOUND  # it may come from the chunk before
                    elif lo == UNSET:
                        lo = hi = opening
                    a = _Account(chunk, acc, opening, lo, hi)
                if before:
                    a.move(before)
                if side == 0:
                    may_go_on()
                elif side > 0:
                    if sure:
                        a.move(amount)
                        if first_round:
                            out.verdicts[True].append(cmd)
                    else:
                        a.leave_open(at, cmd, side, amount)
                        a.hi += amount
                        a.max_net += amount
                elif sure:
                    a.move(-amount)
                elif a.lo >= amount:
                    a.move(-amount)
                    out.verdicts[True].append(cmd)
                elif a.hi < amount:
                    out.verdicts[False].append(cmd)
                else:
                    a.leave_open(at, cmd, side, amount)
                    out.legs += a.waiting
                    a.waiting = []
                    a.lo, a.hi = min(a.lo, 0), max(amount - 1, a.hi - amount)
                    a.min_net -= amount
            yield from out.batches()
        if a is not None and first_round:
            may_go_on()
        yield from out.batches()

    return run


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact verdicts of commands in order; all that is held is a balance for each account that they name."""
    balance: dict[int, int] = {}
    gains: dict[int, list[tuple[int, int]]] = {}
    last = None
    for batch in batches:
        out = _Output()
        for chunk, acc, _, cmd, side, amount, opening, before, sure, *_ in _rows(batch):
            if side == 0:
                gains.setdefault(acc, []).append((chunk, before))
                continue
            has = balance.get(acc, opening)
            if waiting := gains.get(acc):
                has += sum(gain for at, gain in waiting if at < chunk)
                gains[acc] = [w for w in waiting if w[0] >= chunk]
            has += before
            if sure:
                has += side * amount
            elif side < 0:
                last = cmd if has >= amount else None
                out.verdicts[last is not None].append(cmd)
                has -= amount if last is not None else 0
            elif cmd == last:
                has += amount
            balance[acc] = has
        yield from out.batches()


def _clean(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Which rows belong to an account whose debits are all covered by what it has for certain, and which are left to be
    gone through one by one. An account at an end of the batch may have rows in others, so it is among the rest."""
    acc, side, amount, opening, sure = (batch.column(LEG_AND_SURE.index(c)).to_numpy(zero_copy_only=False) for c in ("acc", "side", "amount", "opening", "sure"))
    starts = np.flatnonzero(np.append(True, acc[1:] != acc[:-1]))
    size = np.diff(np.append(starts, len(acc)))
    total = np.cumsum(np.where(side < 0, -amount, np.where(sure, amount, 0)))
    base = np.where(starts > 0, total[starts - 1], 0)
    has = total - np.repeat(base, size) + opening
    covered = np.minimum.reduceat(np.where(side < 0, has, 0), starts) >= 0
    covered[[0, -1]] = False
    clean = np.repeat(covered, size)
    return np.flatnonzero(clean & ((side < 0) | sure)), np.flatnonzero(~clean)


def _verdicts(commands: DataFrame, decided: DataFrame) -> DataFrame:
    """Commands with their verdicts; one that never became a leg was rejected statically."""
    known = F.col("accepted").isNotNull()
    reason = F.coalesce(static_reason(known), F.when(~F.col("accepted"), TOO_LITTLE))
    return commands.join(decided, "cmd_id", "left").select(
        *commands.columns, F.coalesce("accepted", F.lit(False)).alias("accepted"), reason.alias("reason")
    )
