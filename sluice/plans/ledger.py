"""Ledger queries over the command and account tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import creations, ledger, replay
from sluice.session import scratch_folder
from sluice.sinks import ledger as stored
from sluice.sinks import versions
from sluice.sources import tables

VERDICT = ["cmd_id", "accepted", "reason"]
#: The account of the single statement: the customer of some order in every test data size.
ACCOUNT = 7


def _own(spark: SparkSession, folder: str) -> DataFrame:
    """The commands that touch one account: deposits and withdrawals."""
    return tables.commands(spark, folder).filter(F.col("kind").isin(ledger.ONE_ACCOUNT))


def command_check(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.command_check(tables.commands(spark, folder), tables.accounts(spark, folder))


def account_replay(spark: SparkSession, folder: str) -> DataFrame:
    return replay.replay(_own(spark, folder), tables.accounts(spark, folder)).select(*VERDICT)


def transfer_replay(spark: SparkSession, folder: str) -> DataFrame:
    return replay.replay(tables.commands(spark, folder), tables.accounts(spark, folder)).select(*VERDICT)


#: Ledgers of folders of commands, by application.
_ledgers: dict[tuple[str, str], str] = {}
HALF = "1995-06-17"


def kept(spark: SparkSession, folder: str) -> str:
    """The stored ledger of a folder's commands, filled once by an application, in two runs."""
    key = spark.sparkContext.applicationId, folder
    if key not in _ledgers or not versions.numbers(spark, _ledgers[key]):
        path, commands = scratch_folder(spark, "ledger"), tables.commands(spark, folder)
        half = F.col("ts") < F.lit(HALF).cast("timestamp_ntz")
        stored.apply(commands.where(half), path, tables.accounts(spark, folder))
        stored.apply(commands.where(~half), path)
        _ledgers[key] = path
    return _ledgers[key]


def postings(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.postings(stored.read_verdicts(spark, kept(spark, folder)))


def statement(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.statement(postings(spark, folder), tables.accounts(spark, folder))


def statement_compat(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.short_statement(postings(spark, folder))


def account_statement(spark: SparkSession, folder: str) -> DataFrame:
    """One account's statement in order of time."""
    return ledger.statement(postings(spark, folder), tables.accounts(spark, folder), ACCOUNT)


def balances(spark: SparkSession, folder: str) -> DataFrame:
    closing = stored.read_balances(spark, kept(spark, folder))
    return ledger.balance_answers(ledger.referenced_accounts(tables.commands(spark, folder)), closing)


def _with_creations(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return creations.replay_with_creations(
        tables.commands_beside_creations(spark, folder), tables.first_accounts(spark, folder), tables.later_creations(spark, folder)
    )


def creation_replay(spark: SparkSession, folder: str) -> DataFrame:
    return _with_creations(spark, folder)[0].select(*VERDICT)


def creation_statement(spark: SparkSession, folder: str) -> DataFrame:
    return creations.statement(*_with_creations(spark, folder))


def creation_balances(spark: SparkSession, folder: str) -> DataFrame:
    return creations.closing_balances(*_with_creations(spark, folder))


def open_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.open_accounts(tables.account_creations(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        command_check, account_replay, postings, statement, statement_compat, balances, open_accounts,
        transfer_replay, account_statement, creation_replay, creation_statement, creation_balances,
    )
}
