"""The check suite over staging and marts, as one report."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyline.operators.checks import (
    missing_value,
    unexpected_value,
    wrong_error_count,
    wrong_verdict,
)
from tallyline.operators.golden import (
    Golden,
    metric_differences,
    metric_distribution,
    order_differences,
)
from tallyline.operators.rules import FLAGS
from tallyline.schemas import Inputs

ORDER_MART = "fct_payment_reconciliation"
ERROR_MART = "fct_reconciliation_errors"

# Which column carries which check.
NOT_NULL = {
    "stg_merchants": ["merchant_id"],
    "stg_orders": ["order_id", "merchant_id", "order_amount"],
    "stg_payments": ["payment_id", "order_id"],
    "stg_settlements": ["settlement_id", "settlement_batch_id"],
    ORDER_MART: ["order_id", *FLAGS, "error_count", "reconciliation_status"],
    ERROR_MART: ["order_id", "error_code", "error_reason"],
}
UNIQUE = {
    "stg_merchants": ["merchant_id"],
    "stg_orders": ["order_id"],
    "stg_payments": ["payment_id"],
    "stg_settlements": ["settlement_id", "settlement_batch_id"],
    ORDER_MART: ["order_id"],
}
ACCEPTED_VALUES = {
    "stg_payments": {"payment_status": ["SUCCESS", "FAILED"]},
    ORDER_MART: {"reconciliation_status": ["MATCHED", "ERROR"]},
    ERROR_MART: {"error_code": FLAGS},
}


@dataclass(frozen=True)
class Reference:
    child: str
    child_key: str
    parent: str
    parent_key: str


RELATIONSHIPS = [
    Reference("stg_payments", "order_id", "stg_orders", "order_id"),
    Reference(ERROR_MART, "order_id", ORDER_MART, "order_id"),
]

ROW_CHECKS = ("not_null", "accepted_values", "error_count", "status")


def table_set(staged: Inputs, mart: DataFrame, errors: DataFrame) -> dict[str, DataFrame]:
    return {**staged.tables(), ORDER_MART: mart, ERROR_MART: errors}


def _row_conditions(name: str, kinds: Iterable[str]) -> list[tuple[str, str, Column]]:
    """(check, column, condition of a failing row) for the checks that look at single rows."""
    found = []
    if "not_null" in kinds:
        found += [("not_null", c, missing_value(c)) for c in NOT_NULL.get(name, [])]
    if "accepted_values" in kinds:
        accepted = ACCEPTED_VALUES.get(name, {})
        found += [("accepted_values", c, unexpected_value(c, v)) for c, v in accepted.items()]
    if name == ORDER_MART and "error_count" in kinds:
        found.append(("error_count", "error_count", wrong_error_count()))
    if name == ORDER_MART and "status" in kinds:
        found.append(("status", "reconciliation_status", wrong_verdict()))
    return found


def _key_domains(
    names: Collection[str], kinds: Iterable[str]
) -> list[tuple[str, str, str, str, str | None]]:
    """(check, table, column, parent table, parent column) of the checks that compare keys."""
    found = []
    if "unique" in kinds:
        found += [("unique", n, key, n, key) for n, keys in UNIQUE.items() if n in names for key in keys]
    if "relationships" in kinds:
        found += [
            ("relationships", r.child, r.child_key, r.parent, r.parent_key)
            for r in RELATIONSHIPS
            if r.child in names and r.parent in names
        ]
    return found


RowCounts = dict[tuple[str, str, str], int]


def watch_rows(
    name: str, table: DataFrame, kinds: Iterable[str] = ROW_CHECKS
) -> tuple[DataFrame, Callable[[], RowCounts]]:
    """The table, which counts its failing rows while it is written, and how to get the counts then.

    Counting takes no scan of its own. It sits in the stage that writes, whose tasks count once each,
    however often they are tried.
    """
    conditions = _row_conditions(name, kinds)
    if not conditions:
        return table, dict
    watch = Observation()
    counts = [F.count_if(failing).alias(f"n{k}") for k, (*_, failing) in enumerate(conditions)]

    def told() -> RowCounts:
        found = watch.get
        return {(name, check, column): found[f"n{k}"] for k, (check, column, _) in enumerate(conditions)}

    return table.observe(watch, *counts), told


def _counted_rows(name: str, table: DataFrame, conditions: list[tuple[str, str, Column]]) -> DataFrame:
    """table_name, check_name, column_name, failing_rows of the checks that look at single rows."""
    sums = table.agg(*[F.count_if(failing).alias(f"n{k}") for k, (*_, failing) in enumerate(conditions)])
    lines = [_report_line(name, check, column, F.col(f"n{k}")) for k, (check, column, _) in enumerate(conditions)]
    return sums.select(F.inline(F.array(*lines)))


def _report_line(name: str, check: str, column: str, failing: Column) -> Column:
    return F.struct(
        F.lit(name).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        failing.alias("failing_rows"),
    )


def _counted_keys(tables: dict[str, DataFrame], keyed: list[tuple[str, str, str, str, str | None]]) -> DataFrame:
    """The same of the checks that compare keys.

    A row gives an entry for each key that it owns or refers to: the number of the key's domain and
    two hashes of it, 96 bits in all, which stand for the key. So what is added up in each task and
    then shuffled is a few numbers, however long keys are. Every check is a sum over the counts.
    """
    owners = sorted({(parent, column) for *_, parent, column in keyed})
    domain = {owner: k for k, owner in enumerate(owners)}
    entries = [(name, column, domain[name, column], 1, 0) for name, column in owners]
    entries += [(child, column, domain[parent, key], 0, 1) for check, child, column, parent, key in keyed if check == "relationships"]
    parts = [
        tables[name].where(F.col(column).isNotNull()).select(
            F.lit(number).alias("domain"),
            F.xxhash64(column).alias("h"),
            F.hash(column).alias("g"),
            F.lit(owned).alias("owned"),
            F.lit(used).alias("used"),
        )
        for name, column, number, owned, used in entries
    ]
    counted = reduce(DataFrame.unionAll, parts).groupBy("domain", "h", "g").agg(
        F.sum("owned").alias("owned"), F.sum("used").alias("used")
    )
    counts = []
    for check, _, _, parent, key in keyed:
        mine = F.col("domain") == domain[parent, key]
        if check == "unique":
            counts.append(F.count_if(mine & (F.col("owned") > 1)))
        else:
            counts.append(F.sum(F.when(mine & (F.col("owned") == 0), F.col("used"))))
    sums = counted.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"n{k}") for k, c in enumerate(counts)])
    lines = [_report_line(name, check, column, F.col(f"n{k}")) for k, (check, name, column, *_) in enumerate(keyed)]
    return sums.select(F.inline(F.array(*lines)))


def quality_report(
    tables: dict[str, DataFrame],
    kinds: Iterable[str] = (*ROW_CHECKS, "unique", "relationships"),
    watched: RowCounts | None = None,
) -> DataFrame:
    """One line per check: table_name, check_name, column_name, failing_rows.

    failing_rows counts rows, and key values for `unique`. Tables that are not in `tables` are left
    out. A business anomaly is not a failure; it is what the marts are there to show.

    Failing rows that were counted while the tables were written are given as `watched`. Those of
    other checks take one pass over each table, without a shuffle of rows.
    """
    kinds = tuple(kinds)
    parts, known = [], []
    for name, table in tables.items():
        conditions = _row_conditions(name, kinds)
        seen = [(name, check, column) for check, column, _ in conditions if (name, check, column) in (watched or {})]
        known += [(*line, watched[line]) for line in seen]
        left = [c for c in conditions if (name, *c[:2]) not in seen]
        if left:
            parts.append(_counted_rows(name, table, left))
    if known:
        schema = "table_name string, check_name string, column_name string, failing_rows bigint"
        parts.append(next(iter(tables.values())).sparkSession.createDataFrame(known, schema))
    keyed = _key_domains(tables, kinds)
    if keyed:
        parts.append(_counted_keys(tables, keyed))
    return reduce(DataFrame.unionAll, parts)


def row_report(name: str, table: DataFrame, kinds: Iterable[str] = ROW_CHECKS) -> DataFrame:
    """The single-row checks of one table."""
    return quality_report({name: table}, kinds)


def _line(table: str, check: str, column: str) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        F.col("failing_rows"),
    ]


def golden_report(mart: DataFrame, errors: DataFrame, golden: Golden) -> DataFrame:
    """failing_rows counts expected orders and expected metrics that differ."""
    count = F.count("*").alias("failing_rows")
    orders = order_differences(golden.orders, mart).agg(count)
    metrics = metric_differences(golden.metrics, metric_distribution(mart, errors)).agg(count)
    return orders.select(_line(ORDER_MART, "golden_orders", "order_id")).unionByName(
        metrics.select(_line(ORDER_MART, "golden_metrics", "metric"))
    )
