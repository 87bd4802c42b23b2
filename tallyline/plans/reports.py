"""The two dashboard result sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.errors import error_rows
from tallyline.operators.rules import FLAGS, error_catalog


def error_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error_code").agg(F.count("*").alias("error_count"))


def error_type_summary(errors: DataFrame) -> DataFrame:
    """Rows per error type, always all twelve types. Sort by category_sort_order, sort_order."""
    counts = error_counts(errors.where(F.col("error_code").isin(*FLAGS)))  # twelve rows at most
    return (
        error_catalog(errors.sparkSession)
        .join(F.broadcast(counts), "error_code", "left")
        .select(
            "category_sort_order",
            "error_category",
            "sort_order",
            "error_code",
            "error_reason",
            F.coalesce("error_count", F.lit(0)).alias("error_count"),
        )
    )


def settlement_statuses(mart: DataFrame) -> DataFrame:
    """order_id and statuses, a list of (settlement_status, times), of every order that has an id.

    Rows are counted in each task first, so an order that is in the mart very often is one entry for
    each status that it has, and one row in the end.
    """
    keyed = mart.where(F.col("order_id").isNotNull())
    counted = keyed.groupBy("order_id", "settlement_status").agg(F.count("*").alias("times"))
    return counted.groupBy("order_id").agg(
        F.collect_list(F.struct("settlement_status", "times")).alias("statuses")
    )


def error_details(errors: DataFrame, mart: DataFrame, unique: bool = False) -> DataFrame:
    """Error rows for an investigation, with the settlement status of their order.

    An order that is in the mart several times lends every row's status to each of its error rows.
    The join meets one row an order, so only its left side can be crowded, which adaptive execution
    splits; statuses are repeated after it. Where order ids are known to be unique and never null,
    each error row has its own status and nothing is joined.
    """
    if unique:
        rows = error_rows(mart, ("settlement_status",))
    else:
        joined = errors.join(settlement_statuses(mart), "order_id", "left")
        rows = joined.select(*errors.columns, F.inline_outer("statuses"))
        again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("times", F.lit(1).cast("bigint"))))
        rows = rows.select("*", again.alias("time"))
    return (
        rows.orderBy("order_id", "error_code")
        .select(
            "order_id",
            "payment_id",
            "settlement_id",
            "merchant_id",
            "error_reason",
            "order_amount",
            "payment_amount",
            "gross_amount",
            F.col("payment_amount").alias("expected_gross_amount"),
            "actual_fee_amount",
            "expected_fee_amount",
            F.col("actual_net_amount").alias("net_amount"),
            "expected_net_amount",
            "settlement_status",
            "ordered_at",
            "paid_at",
            "settled_at",
        )
    )
