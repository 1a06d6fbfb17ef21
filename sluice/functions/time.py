"""Time expressions. All are built-in column expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.schema import PERIODS

# --- fixed values: date formats of the key spaces ---
MONTH_KEY = "yyyy-MM"
DAY_KEY = "yyyy-MM-dd"
MINUTE_KEY = "yyyy-MM-dd_HH:mm"
STORE_TIME = "yyyy-MM-dd HH:mm:ss.SSS"

# --- fixed value: the time zone that sample reports are shown in ---
REPORT_ZONE = "America/Sao_Paulo"


def step_seconds(seconds_since_epoch: Column, width: Column | int) -> Column:
    """Floor of an epoch second to a multiple of ``width``; integer arithmetic only."""
    width = F.lit(width) if isinstance(width, int) else width
    return seconds_since_epoch - F.pmod(seconds_since_epoch, width)


def border(ts: Column) -> Column:
    """Timestamp as it leaves the library: UTC wall clock without a zone."""
    return ts.cast("timestamp_ntz")


def parse_time(text: Column) -> Column:
    """Timestamp from text with 0 to 6 fraction digits; null when it is not one."""
    return text.try_cast("timestamp")


def local_time(ts: Column, zone: str = REPORT_ZONE) -> Column:
    """UTC instant as wall clock time in ``zone``."""
    return F.from_utc_timestamp(ts, zone)


# --- fixed values: dashboard labels and their periods ---
LABELS = {"Hours": "PT1H", "10-Minute": "PT10M"}
NO_LABEL = "PT1M"


def period_of_label(label: Column) -> Column:
    """Period that a dashboard label asks for; anything unknown means one minute."""
    return F.coalesce(*[F.when(label == name, period) for name, period in LABELS.items()], F.lit(NO_LABEL))


def period_for_label(label: str) -> str:
    """Same as :func:`period_of_label` for a job parameter."""
    return LABELS.get(label, NO_LABEL)


def period_seconds(period: str) -> int:
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}, expected one of {sorted(PERIODS)}")
    return PERIODS[period]
