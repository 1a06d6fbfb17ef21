"""Money as whole cents, for exact arithmetic on longs, and back."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.schema import MONEY


def to_cents(amount: Column) -> Column:
    return (amount.cast(MONEY) * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)
