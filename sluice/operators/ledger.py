"""Ledger results: postings, statements, balances, account openings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.keys import posting_key
from sluice.functions.money import from_cents, to_cents
from sluice.operators.replay import check
from sluice.operators.running import running_total
from sluice.schema import MONEY

# --- fixed values: indicators, the name of what is outside the bank, and kinds of commands ---
CREDIT, DEBIT = "Credit", "Debit"
EXTERNAL = "External"
ONE_ACCOUNT = ["MoneyDeposit", "MoneyWithdraw"]

# --- fixed value: the message of a balance query for an unknown account ---
NO_DATA = "No account data found!"


def command_check(commands: DataFrame, accounts: DataFrame) -> DataFrame:
    """Static verdicts: everything that can be said without a balance."""
    return check(commands, accounts).select("cmd_id", "kind", F.col("reason").isNull().alias("valid"), "reason")


def postings(replayed: DataFrame) -> DataFrame:
    """One posting per accepted deposit or withdrawal, two per transfer."""
    return (
        replayed.filter("accepted")
        .select(
            "cmd_id",
            "ts",
            "kind",
            "amount",
            F.coalesce(F.col("src").cast("string"), F.lit(EXTERNAL)).alias("src_account"),
            F.coalesce(F.col("dst").cast("string"), F.lit(EXTERNAL)).alias("dst_account"),
            F.inline(
                F.array(
                    F.struct(F.col("src").alias("acc_id"), F.lit(DEBIT).alias("indicator")),
                    F.struct(F.col("dst").alias("acc_id"), F.lit(CREDIT).alias("indicator")),
                )
            ),
        )
        .filter(F.col("acc_id").isNotNull())
        .withColumn("sort", _sort())
        .select("acc_id", "sort", "cmd_id", "ts", "indicator", "amount", "kind", "src_account", "dst_account")
    )


def _sort():
    """Deposits and outgoing transfers have ``TX_`` keys, all else ``TX#``."""
    listed = (F.col("kind") == "MoneyDeposit") | ((F.col("kind") == "MoneyTransfer") & (F.col("indicator") == DEBIT))
    return posting_key(F.col("ts"), F.col("cmd_id"), listed)


def signed(indicator: str = "indicator", amount: str = "amount"):
    return F.when(F.col(indicator) == CREDIT, F.col(amount)).otherwise(-F.col(amount))


def statement(
    posted: DataFrame, accounts: DataFrame, account: int | None = None, partitions: int | None = None
) -> DataFrame:
    """All postings with the balance after each one; of one account, in order of time, if given.

    An account's opening balance goes in as its first move (its time is null,
    which sorts first), so the running total is the balance and needs no join.
    """
    if account is not None:
        posted = posted.filter(F.col("acc_id") == account)
        accounts = accounts.filter(F.col("acc_id") == account)
    moves = posted.select("acc_id", "ts", "cmd_id", "kind", "indicator", "amount", to_cents(signed()).alias("change"))
    openings = accounts.select("acc_id", to_cents(F.col("opening")).alias("change"))
    both = moves.unionByName(openings, allowMissingColumns=True)
    total = running_total(both, "acc_id", ["ts", "cmd_id"], "change", "cents", partitions)
    lines = total.filter(F.col("cmd_id").isNotNull()).select(
        "acc_id", "ts", "cmd_id", "kind", "indicator", "amount", from_cents(F.col("cents")).alias("balance")
    )
    return lines if account is None else lines.orderBy("ts", "cmd_id")


def short_statement(posted: DataFrame) -> DataFrame:
    """The postings that a query for ``TX_`` keys finds: no withdrawals and no incoming transfers."""
    return posted.filter(F.col("sort").startswith("TX_"))


def closing_balances(posted: DataFrame, accounts: DataFrame) -> DataFrame:
    """Balance of every account after all postings. Sums are partial before the shuffle, so hot accounts are fine."""
    moved = posted.groupBy("acc_id").agg(F.sum(to_cents(signed())).alias("moved"))
    balance = F.col("opening") + from_cents(F.coalesce("moved", F.lit(0)))
    return accounts.join(moved, "acc_id", "left").select("acc_id", balance.cast(MONEY).alias("balance"))


def balance_answers(requested: DataFrame, balances: DataFrame) -> DataFrame:
    """An answer per requested account; an unknown one has balance 0 and result false."""
    found = F.col("balance").isNotNull()
    return requested.join(balances, "acc_id", "left").select(
        "acc_id",
        F.coalesce("balance", F.lit(0).cast(MONEY)).alias("balance"),
        F.lit(CREDIT).alias("indicator"),
        found.alias("result"),
        F.when(~found, NO_DATA).alias("error_msg"),
    )


def referenced_accounts(commands: DataFrame) -> DataFrame:
    """Every account that a command names, known or not."""
    return (
        commands.select(F.explode(F.array("src", "dst")).alias("acc_id"))
        .filter(F.col("acc_id").isNotNull())
        .distinct()
    )


def open_accounts(creations: DataFrame) -> DataFrame:
    """Accounts as last created: a later creation of the same id overwrites, and is counted."""
    # Two steps with fixed-width state, so that both are hash aggregations.
    of_time = creations.groupBy("acc_id", "ts").agg(F.max_by("init_balance", "cmd_id").alias("init_balance"), F.count("*").alias("n"))
    return of_time.groupBy("acc_id").agg(
        F.max_by("init_balance", "ts").alias("balance"), F.lit(CREDIT).alias("indicator"), F.sum("n").alias("n_creations")
    )


def customer_data(created: DataFrame) -> DataFrame:
    """The customer row that goes with each account; the overdraft flag is stored and never used."""
    # --- fixed values: the customer data of every new account ---
    return created.select(
        "acc_id",
        F.lit("Customer Name").alias("name"),
        F.lit("15-11-1900").alias("birth"),
        F.lit("+551199999999").alias("phone"),
        F.lit(False).alias("overdraft_allowed"),
    )
