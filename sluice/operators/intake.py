"""Intake of rollup records: envelope decode, defaults, classification, error split, statistics.

No record stops a batch: what is wrong with it becomes a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.keys import (
    DEFAULT_STORE,
    DEFAULT_TIME,
    UNKNOWN_PERIOD,
    grain_of,
    partition_key,
    period_of,
    sort_key,
)
from sluice.functions.time import border
from sluice.schema import KPIS, NO_STATE, STORE_KPIS, WIRE_ROLLUP

OK, DEAD, ERROR = "ok", "dead_letter", "error"


def decode(envelopes: DataFrame, data: str = "data") -> DataFrame:
    """Base64 JSON records as typed columns; a payload that cannot be read is marked in ``bad_payload``."""
    schema = T.StructType([*WIRE_ROLLUP, T.StructField("_corrupt", T.StringType())])
    text = F.try_to_binary(F.col(data), F.lit("base64")).cast("string")
    record = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = envelopes.withColumn("r", record)
    field = lambda name: F.col("r").getField(name)
    return rows.select(
        *envelopes.columns,
        (text.isNull() | field("_corrupt").isNotNull()).alias("bad_payload"),
        field("type").alias("type"),
        field("region").alias("region"),
        field("state").alias("state"),
        field("store-id").alias("store_id"),
        *[field(f"KPI_{i}_SUM").alias(k) for i, k in enumerate(KPIS, 1)],
        field("N_REC").alias("n_rec"),
        field("EVENT_TIME").try_cast("timestamp").alias("event_time"),
        field("INGEST_TIME").try_cast("timestamp").alias("ingest_time"),
    )


def classify(records: DataFrame, *carried: str) -> DataFrame:
    """Records as store items, with ``status`` ok, dead_letter or error and the reason.

    A record of an unknown type is a dead letter: counted as an error, yet stored
    under ``UNK``. A record without a part of its key has no row in the store.
    """
    grain = grain_of(F.coalesce(F.col("type"), F.lit("")))
    bad = F.col("bad_payload") if "bad_payload" in records.columns else F.lit(False)
    default_time = F.lit(DEFAULT_TIME).cast("timestamp")
    checked = records.withColumns(
        {
            "type": F.upper(F.coalesce("type", F.lit(""))),
            "grain": grain,
            "period": period_of(F.coalesce("type", F.lit(""))),
            "event_time": F.coalesce(F.col("event_time").cast("timestamp"), default_time),
            "ingest_time": F.coalesce(F.col("ingest_time").cast("timestamp"), default_time),
            "reason": F.when(bad, "bad_payload")
            .when(F.col("region").isNull(), "missing_region")
            .when(_any_null(KPIS), "missing_kpi")
            .when((grain != "REGION") & F.col("state").isNull(), "missing_state")
            .when((grain == "STORE") & F.col("store_id").isNull(), "missing_store"),
        }
    )
    unknown = F.col("grain").isNull()
    status = F.when(F.col("reason").isNotNull(), ERROR).when(unknown, DEAD).otherwise(OK)
    reason = F.when(F.col("reason").isNull() & unknown, "unknown_type").otherwise(F.col("reason"))
    has_row = F.col("reason").isNull()
    pk = partition_key(F.coalesce("grain", F.lit("REGION")), F.col("region"), F.col("state"), F.col("store_id"))
    sk = sort_key(
        F.when(unknown, UNKNOWN_PERIOD).otherwise(F.col("period")), F.col("event_time"), F.col("ingest_time")
    )
    return checked.select(
        *carried,
        status.alias("status"),
        reason.alias("reason"),
        F.when(has_row, pk).alias("pk"),
        F.when(has_row, sk).alias("sk"),
        "type",
        "grain",
        "period",
        "region",
        F.coalesce("state", F.lit(NO_STATE)).alias("state"),
        F.coalesce(F.col("store_id").cast("string"), F.lit(DEFAULT_STORE)).alias("store_id"),
        *[F.col(a).cast("bigint").alias(b) for a, b in zip(KPIS, STORE_KPIS)],
        F.coalesce(F.col("n_rec").cast("bigint"), F.lit(0)).alias("n_rec"),
        border(F.col("event_time")).alias("event_time"),
        border(F.col("ingest_time")).alias("ingest_time"),
    )


def _any_null(columns: list[str]) -> Column:
    return F.greatest(*[F.col(c).isNull() for c in columns])


def accepted(items: DataFrame) -> DataFrame:
    return items.filter(F.col("status") == OK)


def dead_letters(items: DataFrame) -> DataFrame:
    return items.filter(F.col("status") == DEAD)


def quarantined(items: DataFrame) -> DataFrame:
    """Records that cannot be read or lack a part that their row needs."""
    return items.filter(F.col("status") == ERROR)


def load_stats(items: DataFrame) -> DataFrame:
    """Counts of a batch: all, ok, error; and by grain, period, state and region.

    The batch is added up once per combination of the counted columns, which
    leaves a few hundred rows; only those are spread over the statistics.
    """
    small = items.groupBy("status", "grain", "period", "state", "region").agg(F.count("*").alias("n"))
    ok = F.col("status") == OK
    grain = F.col("grain")

    def stat(name: str, key: Column) -> Column:
        return F.struct(F.lit(name).alias("stat"), key.cast("string").alias("key"))

    stats = F.array(
        stat("total", F.lit("all")),
        stat("total", F.when(ok, "ok").otherwise("err")),
        stat("grain", F.when(ok, grain)),
        stat("period", F.when(F.col("status") != ERROR, F.col("period"))),
        stat("state", F.when(ok & (grain == "STATE"), F.col("state"))),
        stat("region", F.when(ok & (grain == "REGION"), F.col("region"))),
    )
    return (
        small.select("n", F.inline(stats))
        .filter(F.col("key").isNotNull())
        .groupBy("stat", "key")
        .agg(F.sum("n").alias("n"))
    )
