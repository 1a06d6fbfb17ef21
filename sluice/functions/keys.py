"""Composite keys of the rollup store and of the ledger."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.time import STORE_TIME

# --- fixed values: text that stands for a missing field in a rollup record ---
DEFAULT_TIME = "2019-01-01"
DEFAULT_STORE = "0"
UNKNOWN_PERIOD = "UNK"

# --- fixed values: beginnings of posting keys and the format of their time ---
LISTED, NOT_LISTED = "TX_", "TX#"
POSTING_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# --- fixed value: splits a sort key into period, time and suffix ---
SORT_KEY_PATTERN = "(.*)#(.*)#(.*)"


def grain_of(type_text: Column) -> Column:
    """Grain named in a record type; null when there is none. STORE wins over STATE over REGION."""
    t = F.upper(type_text)
    return (
        F.when(t.contains("STORE"), "STORE")
        .when(t.contains("STATE"), "STATE")
        .when(t.contains("REGION"), "REGION")
    )


def period_of(type_text: Column) -> Column:
    """Period named in a record type. PT10M wins over PT1H over PT1M."""
    t = F.upper(type_text)
    return (
        F.when(t.contains("PT10M"), "PT10M")
        .when(t.contains("PT1H"), "PT1H")
        .when(t.contains("PT1M"), "PT1M")
        .otherwise(UNKNOWN_PERIOD)
    )


def partition_key(grain: Column, region: Column, state: Column, store: Column) -> Column:
    """``REGION``, ``REGION#STATE`` or ``REGION#STATE#STORE``; null if a needed part is missing."""
    hash_ = F.lit("#")
    return (
        F.when(grain == "REGION", region)
        .when(grain == "STATE", F.concat(region, hash_, state))
        .when(grain == "STORE", F.concat(region, hash_, state, hash_, store.cast("string")))
    )


def sort_key(period: Column, event_time: Column, ingest_time: Column) -> Column:
    """``PERIOD#event time#arrival time``, unique within a partition key."""
    return F.concat_ws(
        "#", period, F.date_format(event_time, STORE_TIME), F.date_format(ingest_time, STORE_TIME)
    )


def sort_key_time(sk: Column) -> Column:
    """Time field of a sort key, as text."""
    return F.regexp_extract(sk, SORT_KEY_PATTERN, 2)


def key_value(region: str, state: str | None = None, store: int | None = None) -> str:
    """Partition key of a query parameter; an empty state means the whole region."""
    parts = [region] + ([state] if state else []) + ([str(store)] if store is not None else [])
    return "#".join(parts)


def posting_key(ts: Column, tx_id: Column, listed: Column) -> Column:
    """Sort key of a ledger posting: ``TX_time`` when listed in the short statement, else ``TX#time``.

    The transaction id takes the place of a random suffix, so no two postings share a key.
    """
    text = F.date_format(ts, POSTING_TIME)
    return F.concat(F.when(listed, LISTED).otherwise(NOT_LISTED), text, F.lit("#"), tx_id.cast("string"))
