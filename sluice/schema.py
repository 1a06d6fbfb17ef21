"""Column types, the region dimension and the rollup periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: regions and their states (MA belongs to two regions) ---
REGIONS = {
    "NORTH": ["AM", "RR", "PA", "TO", "AC", "RO", "MA", "AP"],
    "NORTHEAST": ["MA", "BA", "AL", "PE", "RN", "CE", "PB", "SE", "PI"],
    "SOUTH": ["RS", "PR", "SC"],
    "SOUTHEAST": ["MG", "SP", "RJ", "ES"],
    "MIDWEST": ["MT", "GO", "MS"],
}

# --- fixed values: ISO-8601 periods in seconds ---
PERIODS = {"PT1M": 60, "PT10M": 600, "PT1H": 3600}

# --- fixed values: rollup grains and the dimensions each one groups by ---
GRAINS = {
    "REGION": ["region"],
    "STATE": ["region", "state"],
    "STORE": ["region", "state", "store_id"],
}

# --- fixed values: what a dimension holds where a grain does not group by it ---
NO_STATE = "NN"
NO_STORE = -1

KPIS = ["kpi_1", "kpi_2", "kpi_3", "kpi_4", "kpi_5"]
KPI_SUMS = [f"{k}_sum" for k in KPIS]
STORE_KPIS = ["kpi1", "kpi2", "kpi3", "kpi4", "kpi5"]
DASHBOARD_KPIS = STORE_KPIS[:4]

#: Store event as it travels on the wire; kpi-6 and kpi-7 are not mapped.
WIRE_EVENT = T.StructType(
    [
        T.StructField("event-time", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("store-id", T.IntegerType()),
        *[T.StructField(f"kpi-{i}", T.IntegerType()) for i in range(1, 6)],
    ]
)

#: Rollup record as it travels on the wire.
WIRE_ROLLUP = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("store-id", T.StringType()),
        *[T.StructField(f"KPI_{i}_SUM", T.LongType()) for i in range(1, 6)],
        T.StructField("N_REC", T.LongType()),
        T.StructField("EVENT_TIME", T.StringType()),
        T.StructField("INGEST_TIME", T.StringType()),
    ]
)

#: Typed KPI event, the input of every rollup.
KPI_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingest_time", T.TimestampType()),
        T.StructField("region", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("store_id", T.IntegerType()),
        *[T.StructField(k, T.IntegerType()) for k in KPIS],
    ]
)

MONEY = T.DecimalType(18, 2)

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "money": MONEY}


def columns(text: str) -> T.StructType:
    """A schema from names and types; needs no session, unlike a DDL text."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in text.split(", "))])


def region_dimension(spark: SparkSession) -> DataFrame:
    """The 27 (region, state) pairs, numbered in order.

    An inline table: Spark knows its exact size, which is fixed, so it is
    always joined by broadcast.
    """
    pairs = [(r, s) for r, states in REGIONS.items() for s in states]
    rows = ", ".join(f"({i}, '{r}', '{s}')" for i, (r, s) in enumerate(pairs))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS d(idx, region, state)")
