"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sluice.plans import dashboard, ledger, oracle, streams

Query = Callable[[SparkSession, str], DataFrame]

ALL: dict[str, Query] = {**dashboard.QUERIES, **ledger.QUERIES, **streams.QUERIES}


def _in_utc(query: Query) -> Query:
    """Times in the tables are UTC, so the session has to read and show them as such."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(q) for name, q in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {**oracle.DASHBOARD, **oracle.LEDGER, **oracle.STREAMS}
