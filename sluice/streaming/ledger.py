"""Deposits and withdrawals as a stream, with the accounts' balances as state.

Accounts may be there from the start or come as creations, which are rows of the stream and take effect in their place.
Transfers tie accounts together and are left to the batch replay.

A call of the processor costs milliseconds, whatever it does. So accounts are dealt to a fixed number of groups, which are the
keys of the state, and all accounts of a group are decided together.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluice.functions.money import from_cents, to_cents
from sluice.operators.replay import INVALID_AMOUNT, TOO_LITTLE, UNKNOWN_ACCOUNT

OUT = "cmd_id bigint, acc_id bigint, accepted boolean, reason string, cents bigint"
#: Groups of accounts. The state lies by them, so a stream keeps the number that it began with.
GROUPS = 1024
#: An account's rows of a micro-batch that are held at once; more go into the state, by time.
HELD = 100_000
#: Rows of a group of accounts that are held at once; beyond that all of them go into the state.
HELD_OF_GROUP = 1_000_000
#: How much time goes into a piece of the state.
PIECE = timedelta(hours=1)
#: Rows that are added up at once: a rejection makes the rest of them be added up again.
BLOCK = 1024
#: Up to so many rows, accounts are decided side by side.
SHORT = 64

ROW = ["acc_id", "at", "turn", "cmd_id", "change", "valid"]
ACC, AT, TURN, CMD, CHANGE, VALID = range(len(ROW))
#: Stands for a missing number in arrays, which have none.
MISSING = -(2**63)


def decide(cents: int, change: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which changes of a balance are accepted, and the balance after each. Up to the next debit that is not covered the
    balance is a running sum."""
    accepted, after, at = np.zeros(len(change), bool), np.empty(len(change), np.int64), 0
    while at < len(change):
        here = slice(at, at + BLOCK)
        total = cents + np.cumsum(np.where(valid[here], change[here], 0))
        short = np.flatnonzero(valid[here] & (change[here] < 0) & (total < 0))
        n = int(short[0]) if len(short) else len(total)
        accepted[at : at + n], after[at : at + n] = valid[at : at + n], total[:n]
        cents = int(total[n - 1]) if n else cents
        if len(short):
            after[at + n] = cents
        at += n + bool(len(short))
    return accepted, after


def decide_each(cents: np.ndarray, size: np.ndarray, change: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``decide`` for many balances: the rows of each lie together, ``size`` of them. Short ones go side by side: each round
    adds up what is left of all that have a debit not covered, and takes them one such debit further."""
    accepted, after = valid.copy(), np.empty(len(change), np.int64)
    ends = np.cumsum(size)
    for k in np.flatnonzero(size > SHORT).tolist():
        own = slice(ends[k] - size[k], ends[k])
        accepted[own], after[own] = decide(int(cents[k]), change[own], valid[own])
    of, moved, has = np.repeat(np.arange(len(size)), size), np.where(valid, change, 0), cents.copy()
    left = np.flatnonzero(np.repeat(size <= SHORT, size))
    while len(left):
        total = np.cumsum(moved[left])
        starts = np.flatnonzero(np.append(True, of[left][1:] != of[left][:-1]))
        n = np.diff(np.append(starts, len(left)))
        # Sums of other balances may wrap around; their difference does not.
        total += np.repeat(has[of[left[starts]]] - total[starts] + moved[left[starts]], n)
        after[left] = total
        short = np.flatnonzero((moved[left] < 0) & (total < 0))
        if not len(short):
            break
        which, at = np.unique(np.repeat(np.arange(len(starts)), n)[short], return_index=True)
        at = short[at]
        rejected = left[at]
        accepted[rejected] = False
        after[rejected] -= moved[rejected]
        has[of[rejected]] = after[rejected]
        beyond = np.full(len(starts), len(left))
        beyond[which] = at
        left = left[np.arange(len(left)) > np.repeat(beyond, n)]
    return accepted, after


def _known(acc: np.ndarray, cents: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which accounts have a balance, and the balance. ``acc`` is sorted."""
    at = np.minimum(np.searchsorted(acc, of), max(len(acc) - 1, 0))
    return (acc[at] == of, cents[at]) if len(acc) else (np.zeros(len(of), bool), np.zeros(len(of), np.int64))


def _merged(acc: np.ndarray, cents: np.ndarray, more: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Balances with those of more accounts, which win over the ones before."""
    both, first = np.unique(np.append(more, acc), return_index=True)
    return both, np.append(own, cents)[first]


class AccountBalance(StatefulProcessor):
    """Applies a group of accounts' rows of a micro-batch in order of time; state is the balance of each in cents.

    Rows come unordered and in chunks. Those of most accounts are few and sorted as they are. Where an account has more than
    ``held``, or the group more than ``HELD_OF_GROUP``, rows go into the state in pieces of time and are applied piece by
    piece, so that one piece is in memory, whatever an account's share of the batch.
    """

    def __init__(self, held: int = HELD, piece: timedelta = PIECE):
        self._most, self._width = held, piece // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.balances = handle.getValueState("balances", "accounts binary, cents binary")
        self.pieces = handle.getMapState("pieces", "piece bigint, part bigint", "rows binary")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        acc, cents = self._load()
        more, first = np.unique(initialState["acc_id"].to_numpy(np.int64), return_index=True)
        # Where an account comes twice, its first row counts.
        self._store(*_merged(more, initialState["opening"].to_numpy(np.int64)[first], acc, cents))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        balances = self._load()
        kept, new, n = np.empty((0, len(ROW)), np.int64), [], 0
        aside, parts = np.empty(0, np.int64), {}
        for chunk in rows:
            new.append(chunk[ROW].to_numpy(np.int64))
            n += len(chunk)
            if n > max(self._most, len(kept)) or n + len(kept) > HELD_OF_GROUP:
                kept, aside = self._sifted(np.concatenate([kept, *new]), aside, parts)
                new, n = [], 0
        kept = np.concatenate([kept, *new])
        if parts:
            far = np.isin(kept[:, ACC], aside)
            self._put_aside(kept[far], parts)
            kept = kept[~far]
        if len(kept):
            balances, out = self._applied(balances, kept)
            yield out
        for piece in sorted(parts):
            own = [np.frombuffer(bytes(self.pieces.getValue((piece, part))[0]), np.int64).reshape(-1, len(ROW)) for part in range(parts[piece])]
            balances, out = self._applied(balances, np.concatenate(own))
            yield out
        if parts:
            self.pieces.clear()
        self._store(*balances)

    def _load(self) -> tuple[np.ndarray, np.ndarray]:
        """Accounts, sorted, and their balances."""
        if not self.balances.exists():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        acc, cents = self.balances.get()
        return np.frombuffer(bytes(acc), np.int64), np.frombuffer(bytes(cents), np.int64)

    def _store(self, acc: np.ndarray, cents: np.ndarray) -> None:
        self.balances.update((acc.tobytes(), cents.tobytes()))

    def _sifted(self, rows: np.ndarray, aside: np.ndarray, parts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Puts the rows of accounts with too many of them aside, and gives the other rows and the accounts put aside."""
        acc, n = np.unique(rows[:, ACC], return_counts=True)
        if len(rows) <= HELD_OF_GROUP:
            acc = acc[n > self._most]
        aside = np.union1d(aside, acc)
        far = np.isin(rows[:, ACC], aside)
        self._put_aside(rows[far], parts)
        return rows[~far], aside

    def _put_aside(self, rows: np.ndarray, parts: dict[int, int]) -> None:
        """Puts rows into the state by pieces of time; ``parts`` has the number of parts of each piece."""
        of = rows[:, AT] // self._width
        order = np.argsort(of, kind="stable")
        pieces, starts = np.unique(of[order], return_index=True)
        for piece, own in zip(pieces.tolist(), np.split(rows[order], starts[1:]) if len(rows) else []):
            part = parts.get(piece, 0)
            self.pieces.updateValue((piece, part), (own.tobytes(),))
            parts[piece] = part + 1

    @staticmethod
    def _applied(balances: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], pd.DataFrame]:
        # By account, in order of time and command; a creation comes before a command of the same number.
        rows = rows[np.lexsort((rows[:, TURN], rows[:, CMD], rows[:, AT], rows[:, ACC]))]
        made, first = rows[:, TURN] == 0, np.append(True, rows[1:, ACC] != rows[:-1, ACC])
        # Rows of an account up to its next creation hang on one opening balance.
        starts = np.flatnonzero(made | first)
        size = np.diff(np.append(starts, len(rows))) - made[starts]
        known, cents = _known(*balances, rows[starts, ACC])
        known, cents = np.where(made[starts], rows[starts, VALID] == 1, known), np.where(made[starts], rows[starts, CHANGE], cents)
        known &= rows[starts, ACC] != MISSING  # rows without an account have none
        moves, named = rows[~made], np.repeat(known, size)
        valid = moves[:, VALID] == 1
        accepted, after = decide_each(cents, size, moves[:, CHANGE], valid & named)
        reason = np.where(accepted, None, np.where(~valid, INVALID_AMOUNT, np.where(named, TOO_LITTLE, UNKNOWN_ACCOUNT)))
        out = {c: pd.arrays.IntegerArray(moves[:, k].copy(), moves[:, k] == MISSING) for c, k in (("cmd_id", CMD), ("acc_id", ACC))}
        out |= {"accepted": accepted, "reason": reason, "cents": pd.arrays.IntegerArray(after, ~named)}
        # An account's balance is that after its last row, or the last opening balance where that has no rows.
        closing = np.where(size > 0, after[np.cumsum(size) - 1], cents) if len(after) else cents
        last = np.append(rows[starts[1:], ACC] != rows[starts[:-1], ACC], True)
        acc, cents = balances
        gone = np.isin(acc, rows[starts[last & ~known], ACC])
        now = last & known
        return _merged(acc[~gone], cents[~gone], rows[starts[now], ACC], closing[now]), pd.DataFrame(out)

    def close(self) -> None:
        pass


def _group(acc: str) -> Column:
    return F.pmod(F.xxhash64(F.col(acc).cast("bigint")), F.lit(GROUPS)).alias("group")


def account_stream(commands: DataFrame, accounts: DataFrame, creations: DataFrame | None = None, held: int = HELD, piece: timedelta = PIECE) -> DataFrame:
    """Verdict and balance after each deposit or withdrawal, in order within each micro-batch.

    ``accounts`` are there from the start; ``creations`` (``cmd_id``, ``ts``, ``acc_id``, ``init_balance``) is a stream too.
    Needs the RocksDB state store provider.
    """
    at = F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(MISSING)).alias("at")
    amount = to_cents(F.col("amount"))
    number = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(MISSING)).alias(c)
    moves = commands.filter(F.col("src").isNull() | F.col("dst").isNull()).select(
        F.coalesce("src", "dst").alias("acc_id"),
        at,
        F.lit(1).alias("turn"),
        number("cmd_id"),
        F.coalesce(F.when(F.col("src").isNull(), amount).otherwise(-amount), F.lit(0)).alias("change"),
        F.coalesce((F.col("amount").cast("bigint") > 0).cast("int"), F.lit(0)).alias("valid"),
    )
    if creations is not None:
        # Without an amount a creation leaves the account without a balance, as if it were not there.
        opening = to_cents(F.col("init_balance"))
        made = creations.select("acc_id", at, F.lit(0).alias("turn"), number("cmd_id"), F.coalesce(opening, F.lit(0)).alias("change"), opening.isNotNull().cast("int").alias("valid"))
        moves = moves.unionByName(made)
    openings = accounts.select(_group("acc_id"), number("acc_id"), to_cents(F.col("opening")).alias("opening")).where(f"opening is not null and acc_id <> {MISSING}").groupBy("group")
    moves = moves.select(_group("acc_id"), number("acc_id"), *ROW[1:])
    verdicts = moves.groupBy("group").transformWithStateInPandas(AccountBalance(held, piece), OUT, "append", "none", openings)
    return verdicts.select("cmd_id", "acc_id", "accepted", "reason", from_cents(F.col("cents")).alias("balance"))
