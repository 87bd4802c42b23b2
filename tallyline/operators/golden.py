"""Compare results with expected ones, per order and per metric."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.rules import FLAGS
from tallyline.session import planned_bytes

#: Expected orders of up to this planned size are broadcast.
SHORT_LIST_BYTES = 32 * 1024 * 1024

COMPARED = [*FLAGS, "error_count", "reconciliation_status"]


@dataclass(frozen=True)
class Golden:
    """Expected results: orders with expected_ columns, and (metric, expected_value) rows."""

    orders: DataFrame
    metrics: DataFrame


def _expected(name: str) -> str:
    return f"expected_{name}"


def order_differences(expected: DataFrame, mart: DataFrame) -> DataFrame:
    """Expected orders whose flags, count or status differ, or that the mart lacks: a full outer join
    limited to expected orders.

    Rows of both are put together and counted by order and values, in each task first, so that an
    order that is very often in the mart is one row for each verdict that it has; then each order's
    verdicts are gathered and compared. The mart is read once, and no join can be crowded. Expected
    orders that Spark plans to be small are broadcast first, and the others of the mart stay out.
    """
    wanted_type = expected.select(F.struct(*map(_expected, COMPARED)).alias("w")).schema["w"].dataType
    found_type = mart.select(F.struct(*COMPARED).alias("f")).schema["f"].dataType
    actual = mart.where(F.col("order_id").isNotNull())
    size = planned_bytes(expected)
    if size is not None and size <= SHORT_LIST_BYTES:
        actual = actual.join(F.broadcast(expected.select("order_id")), "order_id", "left_semi")
    wanted = F.struct(*map(_expected, COMPARED)).alias("wanted")
    found = F.struct(*COMPARED).alias("found")
    tagged = expected.select("order_id", wanted, F.lit(None).cast(found_type).alias("found")).unionAll(
        actual.select("order_id", F.lit(None).cast(wanted_type).alias("wanted"), found)
    )
    counted = tagged.groupBy("order_id", "wanted", "found").agg(F.count("*").alias("times"))

    def gathered(name: str) -> Column:
        return F.collect_list(F.when(F.col(name).isNotNull(), F.struct(name, "times")))

    orders = counted.groupBy("order_id").agg(gathered("wanted").alias("w"), gathered("found").alias("f"))
    sides = orders.where(F.size("w") > 0).select("order_id", "f", F.inline("w"))
    sides = sides.select("order_id", "wanted", F.col("times").alias("n"), F.inline_outer("f"))
    differ = reduce(or_, [~F.col(f"found.{c}").eqNullSafe(F.col(f"wanted.{_expected(c)}")) for c in COMPARED])
    rows = sides.where(F.col("found").isNull() | differ)
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n") * F.coalesce("times", F.lit(1).cast("bigint"))))
    return rows.select("order_id", "wanted", "found", again.alias("time")).select("order_id", "wanted.*", "found.*")


def metric_distribution(mart: DataFrame, errors: DataFrame) -> DataFrame:
    """Sixteen metrics in two scans: fifteen over the order mart and the number of error rows."""
    conditions = {
        "matched_orders": F.col("reconciliation_status") == "MATCHED",
        "error_orders": F.col("reconciliation_status") == "ERROR",
        **{code: F.col(code) for code in FLAGS},
    }
    counted = mart.agg(
        F.count("*").alias("total_orders"),
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()],
    )
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(name).alias("actual_value"))
        for name in counted.columns
    ]
    rows = errors.agg(F.count("*").alias("actual_value")).select(
        F.lit("error_detail_rows").alias("metric"), "actual_value"
    )
    return counted.select(F.inline(F.array(*pairs))).unionByName(rows)


def metric_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected metrics (metric, expected_value) that the actual ones miss or contradict."""
    return (
        expected.join(actual, "metric", "left")
        .where(~F.col("actual_value").eqNullSafe(F.col("expected_value")))
        .select("metric", "expected_value", "actual_value")
    )
