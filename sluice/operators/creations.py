"""Account creations in the order of the ledger.

A creation sets an account's balance, whatever it was, and an account can be created again. So creations cut an account's
commands into segments that do not bear on each other: each segment is replayed as an account of its own whose opening
balance is that of the creation. Commands before an account's first creation name an unknown account. Which segment a
command falls into is a running count of creations, over range partitions of account and time, so a hot account spreads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.money import from_cents, to_cents
from sluice.operators.ledger import CREDIT, DEBIT, signed
from sluice.operators.replay import replay
from sluice.operators.running import running_total
from sluice.schema import MONEY
from sluice.session import scratch_folder, through_table

ORDER = ["ts", "cmd_id", "turn"]


def _moves(commands: DataFrame, creations: DataFrame) -> DataFrame:
    """Creations and legs of commands by account, each with the number of creations of its account up to it."""
    legs = commands.select(
        "cmd_id", "ts", F.inline(F.array(F.struct(F.col("src").alias("acc_id"), F.lit(1).alias("turn")), F.struct(F.col("dst").alias("acc_id"), F.lit(2).alias("turn"))))
    ).where("acc_id is not null")
    made = creations.select("cmd_id", "ts", "acc_id", F.lit(0).alias("turn"), F.col("init_balance").cast(MONEY).alias("opening"), F.lit(1).cast("bigint").alias("made"))
    every = made.unionByName(legs.withColumn("made", F.lit(0).cast("bigint")), allowMissingColumns=True)
    return running_total(every, "acc_id", ORDER, "made", "segment")


def replay_with_creations(commands: DataFrame, accounts: DataFrame, creations: DataFrame, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Commands with ``accepted``, ``reason`` and the segments of their accounts, and the segments: ``id``, ``acc_id``,
    ``segment`` (0 for accounts that are there from the start) and ``opening``. A creation counts from its time and number
    on, before a command with the same."""
    spark = commands.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        return through_table(df, scratch_folder(spark, label))

    moves = stored(_moves(commands, creations), "moves")
    first = accounts.select("acc_id", F.lit(0).cast("bigint").alias("segment"), F.col("opening").cast(MONEY).alias("opening"))
    every = first.unionByName(moves.where("turn = 0").select("acc_id", "segment", "opening"))
    segments = stored(every.withColumn("id", F.monotonically_increasing_id()), "segments")
    named = segments.select(F.col("acc_id").alias("of"), F.col("segment").alias("at"), "id")
    legs = moves.where("turn > 0").join(named, (F.col("acc_id") == F.col("of")) & (F.col("segment") == F.col("at")), "left")
    # Unknown accounts are numbers that no segment has, and the same one on both sides only if the accounts are the same.
    found = legs.groupBy("cmd_id").agg(
        F.max(F.when(F.col("turn") == 1, F.coalesce("id", F.lit(-1)))).alias("src_segment"),
        F.max(F.when(F.col("turn") == 2, F.coalesce("id", F.lit(-2)))).alias("dst_segment"),
    )
    own = commands.join(found.withColumnRenamed("cmd_id", "of_cmd"), F.col("cmd_id") == F.col("of_cmd"), "left").drop("of_cmd")
    same = F.col("src") == F.col("dst")
    renamed = own.withColumns({"own_src": F.col("src"), "own_dst": F.col("dst"), "src": F.col("src_segment"), "dst": F.when(same, F.col("src_segment")).otherwise(F.col("dst_segment"))})
    done = replay(renamed, segments.select(F.col("id").alias("acc_id"), "opening"), partitions)
    done = done.withColumns({"src": F.col("own_src"), "dst": F.col("own_dst")}).drop("own_src", "own_dst")
    return done, segments


def _postings(done: DataFrame) -> DataFrame:
    sides = F.array(
        F.struct(F.col("src").alias("acc_id"), F.col("src_segment").alias("id"), F.lit(DEBIT).alias("indicator")),
        F.struct(F.col("dst").alias("acc_id"), F.col("dst_segment").alias("id"), F.lit(CREDIT).alias("indicator")),
    )
    return done.where("accepted").select("cmd_id", "ts", "kind", "amount", F.inline(sides)).where("acc_id is not null")


def statement(done: DataFrame, segments: DataFrame) -> DataFrame:
    """All postings with the balance after each one."""
    moves = _postings(done).withColumn("change", to_cents(signed()))
    openings = segments.select("id", to_cents(F.col("opening")).alias("change"))
    total = running_total(moves.unionByName(openings, allowMissingColumns=True), "id", ["ts", "cmd_id"], "change", "cents")
    return total.where("cmd_id is not null").select("acc_id", "ts", "cmd_id", "kind", "indicator", "amount", from_cents(F.col("cents")).alias("balance"))


def closing_balances(done: DataFrame, segments: DataFrame) -> DataFrame:
    """Balance of every account after its last creation and all postings since."""
    moved = _postings(done).groupBy("id").agg(F.sum(to_cents(signed())).alias("moved"))
    cents = to_cents(F.col("opening")) + F.coalesce("moved", F.lit(0))
    closed = segments.join(moved, "id", "left").select("acc_id", "segment", cents.alias("cents"))
    return closed.groupBy("acc_id").agg(from_cents(F.max_by("cents", "segment")).alias("balance"))
