"""Exact fee arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.schemas import RATE


def expected_fee(amount: Column, rate: Column) -> Column:
    """amount * rate, rounded once, halves away from zero. A fee beyond bigint becomes null.

    A product of all digits would not fit 38, so that Spark would cut its scale and round twice. The
    rate's whole part and its fraction have the same sign, so both products are exact, and rounding
    the second one rounds the sum.
    """
    exact, rate = amount.cast("decimal(19,0)"), rate.try_cast(RATE)
    whole = F.when(rate < 0, F.ceil(rate)).otherwise(F.floor(rate))
    fraction = (rate % F.lit(1)).cast("decimal(9,9)")
    part = F.round(exact * fraction, 0).try_cast("bigint")
    rest = F.when((whole == 0) | (amount == 0), F.lit(0).cast("bigint")).otherwise(
        (exact * whole.try_cast("decimal(19,0)")).try_cast("bigint")
    )
    return F.when(amount.isNotNull() & rate.isNotNull(), F.try_add(rest, part))


def expected_net(amount: Column, fee: Column) -> Column:
    return F.try_subtract(amount, fee)
