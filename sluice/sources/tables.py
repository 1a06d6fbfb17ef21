"""Readers: the test tables and the inputs that are derived from them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.time import DAY_KEY, MINUTE_KEY, MONTH_KEY
from sluice.schema import KPIS, MONEY, region_dimension
from sluice.sources.records import event_record


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The files of a table as a stream."""
    return spark.readStream.schema(table(spark, folder, name).schema).parquet(f"{folder}/{name}*.parquet")


def kpi_events(spark: SparkSession, folder: str, day: str | None = None) -> DataFrame:
    """Typed KPI events, one per row of ``events``. The dimension has 27 rows, so it is broadcast.

    A day of event time is picked on the raw column, where the Parquet reader can
    use it. All buckets nest in days, so rollups of the day come out whole.
    """
    e = table(spark, folder, "events")
    if day:
        start = datetime.fromisoformat(day)
        first, after = (F.lit(t).cast("timestamp_ntz") for t in (start, start + timedelta(days=1)))
        e = e.filter((F.col("ts") >= first) & (F.col("ts") < after))
    return typed_events(e)


def typed_events(e: DataFrame) -> DataFrame:
    """Rows of ``events``, from the table or from a stream of it, as typed KPI events."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    d = region_dimension(e.sparkSession)
    ts = F.col("ts").cast("timestamp")
    late = (F.col("event_id") % 7) * 97 * 1_000_000
    return e.join(F.broadcast(d), d.idx == e.user_id % 27).select(
        "event_id",
        ts.alias("event_time"),
        F.timestamp_micros(F.unix_micros(ts) + late).alias("ingest_time"),
        "region",
        "state",
        (F.col("user_id") % 15 + 1).cast("int").alias("store_id"),
        F.floor("value").cast("int").alias("kpi_1"),
        (k % 51).alias("kpi_2"),
        k.alias("kpi_3"),
        (F.col("event_id") % 61).cast("int").alias("kpi_4"),
        (F.col("event_id") % 241).cast("int").alias("kpi_5"),
    )


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw JSON with their arrival, some of them broken, without a region or with a time that is none."""
    return raw_records(kpi_events(spark, folder))


def raw_records(events: DataFrame, *carried: str) -> DataFrame:
    """The same from typed events."""
    event = F.to_json(event_record())
    turn = F.col("event_id") % 50
    value = (
        F.when(turn == 0, F.substring(event, 1, 20))
        .when(turn == 1, F.to_json(event_record().withField("region", F.lit(None).cast("string"))))
        .when(turn == 2, F.to_json(event_record().withField("`event-time`", F.lit("never"))))
        .otherwise(event)
    )
    return events.select("event_id", *carried, value.alias("value"), F.col("ingest_time").alias("arrival"))


def wire_records(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded rollup records with every irregular case: unknown types and missing fields."""
    return typed_records(kpi_events(spark, folder))


def typed_records(events: DataFrame, *carried: str) -> DataFrame:
    """The same from typed events."""
    i = F.col("event_id")
    # --- fixed values: the record types in turn ---
    types = [
        "BY_REGION_PT1M", "by_region_pt10m", "BY_REGION_PT1H", "by_state_pt1m", "BY_STATE_PT10M",
        "BY_STATE_PT1H", "BY_STORE_PT1M", "BY_STORE_PT10M",
    ]
    kind = F.when(i % 2 == 0, "BY_STORE_PT1H").otherwise("BY_CITY_PT5M")
    for n, text in reversed(list(enumerate(types))):
        kind = F.when(i % 9 == n, text).otherwise(kind)

    def missing_every(n: int, c: str) -> F.Column:
        return F.when(i % n != 0, F.col(c)).alias(c)

    return events.select(
        "event_id",
        *carried,
        kind.alias("type"),
        missing_every(41, "region"),
        missing_every(43, "state"),
        missing_every(47, "store_id"),
        *KPIS,
        F.when(i % 53 != 0, 1).alias("n_rec"),
        missing_every(59, "event_time"),
        "ingest_time",
    )


def wide_records(spark: SparkSession, folder: str) -> DataFrame:
    """Wide KPI records: nine KPIs and the three date formats."""
    i = F.col("event_id")
    # --- fixed values: moduli of the four extra KPIs ---
    moduli = {"kpi_6": 1001, "kpi_7": 997, "kpi_8": 991, "kpi_9": 983}
    return kpi_events(spark, folder).select(
        "event_id",
        F.col("region").alias("pk"),
        F.date_format("event_time", MONTH_KEY).alias("month"),
        F.date_format("event_time", DAY_KEY).alias("day"),
        F.date_format("event_time", MINUTE_KEY).alias("minute"),
        *KPIS,
        *[(i % m).cast("int").alias(c) for c, m in moduli.items()],
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts with their opening balance. Money is cast from double directly, never after arithmetic."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("acc_id"), F.col("c_acctbal").cast(MONEY).alias("opening")
    )


def commands(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger commands; a null account is outside the bank."""
    return typed_commands(table(spark, folder, "orders"), table(spark, folder, "customer"))


def typed_commands(o: DataFrame, customer: DataFrame) -> DataFrame:
    """Rows of ``orders``, from the table or from a stream of it, as ledger commands."""
    n_accounts = customer.agg(F.count("*")).scalar()
    key, acc = F.col("o_orderkey"), F.col("o_custkey")
    turn = key % 3
    src = F.when(turn == 0, None).when(key % 101 == 0, -1).otherwise(acc)
    dst = (
        F.when(turn == 1, None)
        .when(key % 103 == 0, -1)
        .when(turn == 0, acc)
        .when(key % 97 == 2, acc)
        .otherwise((acc * 7 + 1) % n_accounts)
    )
    amount = (
        F.when(key % 50 == 0, F.lit(0).cast(MONEY))
        .when(key % 50 == 1, F.lit("0.99").cast(MONEY))
        .otherwise(F.col("o_totalprice").cast(MONEY))
    )
    kind = F.when(turn == 0, "MoneyDeposit").when(turn == 1, "MoneyWithdraw").otherwise("MoneyTransfer")
    return o.select(
        key.alias("cmd_id"),
        F.col("o_orderdate").alias("ts"),
        kind.alias("kind"),
        src.cast("bigint").alias("src"),
        dst.cast("bigint").alias("dst"),
        amount.alias("amount"),
    )


def account_creations(spark: SparkSession, folder: str) -> DataFrame:
    """Account creations in order; the same account may be created more than once."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("cmd_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_custkey").alias("acc_id"),
        F.col("o_totalprice").cast(MONEY).alias("init_balance"),
    )


def later_creations(spark: SparkSession, folder: str) -> DataFrame:
    """Creations among the commands, some of accounts that are there already."""
    made = account_creations(spark, folder)
    return made.where("cmd_id % 29 = 0")


def commands_beside_creations(spark: SparkSession, folder: str) -> DataFrame:
    """The commands that are no creations."""
    return commands(spark, folder).where("cmd_id % 29 <> 0")


def first_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The accounts that are there before the first command."""
    return accounts(spark, folder).where("acc_id % 5 <> 0")
