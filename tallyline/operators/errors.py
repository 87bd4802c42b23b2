"""Order mart to error rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.rules import FLAGS, reason_of
from tallyline.schemas import ERROR_COLUMNS


def unpivot_flags(mart: DataFrame, keep: list[str]) -> DataFrame:
    """One row per input row and flag: the kept columns, error_code, has_error."""
    return mart.unpivot(keep, FLAGS, "error_code", "has_error")


def error_rows(mart: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per order and raised flag, with further columns of the mart if wanted.

    Clean orders leave before the unpivot, so only orders in error are multiplied by twelve.
    """
    keep = [name for name in ERROR_COLUMNS if name not in ("error_code", "error_reason")] + [*also]
    raised = unpivot_flags(mart.where(F.col("error_count") > 0), keep).where("has_error")
    return raised.withColumn("error_reason", reason_of(F.col("error_code"))).select(
        *ERROR_COLUMNS, *also
    )
