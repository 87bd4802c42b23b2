"""The twelve anomaly rules. Flags, error count, labels, catalog and checks all derive from here."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    category_sort_order: int
    error_category: str
    sort_order: int
    error_reason: str
    needs: frozenset[str]  # the tables that the rule compares with the order
    broken: Callable[[], Column]


def _has(key: str) -> Column:
    return F.col(key).isNotNull()


def _lacks(key: str) -> Column:
    return F.col(key).isNull()


def _differs(left: str, right: str | Column) -> Column:
    """Null-safe: a null on one side only counts as a difference."""
    other = F.col(right) if isinstance(right, str) else right
    return ~F.col(left).eqNullSafe(other)


def _out_of_order(earlier: str, later: str) -> Column:
    """True if either time is unknown or the later one comes first. Equal times are in order."""
    return F.coalesce(F.col(later) < F.col(earlier), F.lit(True))


def _fee_known() -> Column:
    return _has("settlement_id") & _has("payment_amount") & _has("fee_rate")


_PAYMENT = frozenset({"payments"})
_MERCHANT = frozenset({"merchants"})
_SETTLEMENT = frozenset({"payments", "settlements"})
_ALL = frozenset({"payments", "merchants", "settlements"})

# Codes, categories, reasons and sort numbers. The list is in mart column order;
# sort_order is the display order of the report.
RULES = [
    Rule(
        "is_payment_missing", 1, "データ欠損", 1, "決済データ欠損", _PAYMENT,
        lambda: _lacks("payment_id"),
    ),
    Rule(
        "is_merchant_missing", 1, "データ欠損", 2, "加盟店マスタ欠損", _MERCHANT,
        lambda: _lacks("merchant_master_id"),
    ),
    Rule(
        "is_fee_rate_missing", 1, "データ欠損", 3, "手数料率欠損", _MERCHANT,
        lambda: _has("merchant_master_id") & _lacks("fee_rate"),
    ),
    Rule(
        "is_order_payment_amount_mismatch", 3, "データ不一致", 6, "注文・決済金額不一致", _PAYMENT,
        lambda: _has("payment_id") & _differs("order_amount", "payment_amount"),
    ),
    Rule(
        "is_settlement_missing", 1, "データ欠損", 4, "精算データ欠損", _SETTLEMENT,
        lambda: _has("payment_id") & _lacks("settlement_id"),
    ),
    Rule(
        "is_settlement_not_completed", 2, "処理状態異常", 5, "精算未完了", _SETTLEMENT,
        lambda: _has("settlement_id") & _differs("settlement_status", F.lit("COMPLETED")),
    ),
    Rule(
        "is_merchant_mismatch", 3, "データ不一致", 7, "加盟店不一致", _SETTLEMENT,
        lambda: _has("settlement_id") & _differs("merchant_id", "settlement_merchant_id"),
    ),
    Rule(
        "is_gross_amount_mismatch", 3, "データ不一致", 8, "決済・精算総額不一致", _SETTLEMENT,
        lambda: _has("settlement_id")
        & _has("payment_id")
        & _differs("gross_amount", "payment_amount"),
    ),
    Rule(
        "is_fee_amount_mismatch", 3, "データ不一致", 9, "手数料額不一致", _ALL,
        lambda: _fee_known() & _differs("actual_fee_amount", "expected_fee_amount"),
    ),
    Rule(
        "is_net_amount_mismatch", 3, "データ不一致", 10, "入金額不一致", _ALL,
        lambda: _fee_known() & _differs("actual_net_amount", "expected_net_amount"),
    ),
    Rule(
        "is_payment_datetime_invalid", 4, "日時不正", 11, "決済日時不正", _PAYMENT,
        lambda: _has("payment_id") & _out_of_order("ordered_at", "paid_at"),
    ),
    Rule(
        "is_settlement_datetime_invalid", 4, "日時不正", 12, "精算日時不正", _SETTLEMENT,
        lambda: _has("settlement_id") & _out_of_order("paid_at", "settled_at"),
    ),
]

FLAGS = [rule.code for rule in RULES]


def flag_columns() -> dict[str, Column]:
    return {rule.code: rule.broken() for rule in RULES}


def raised_flags() -> Column:
    """How many of the twelve flag columns are true."""
    return reduce(add, [F.col(code).cast("bigint") for code in FLAGS])


def verdict(error_count: Column) -> Column:
    return F.when(error_count > 0, "ERROR").otherwise("MATCHED")


def reason_of(code: Column) -> Column:
    """Display label of an error code."""
    first, *rest = RULES
    label = F.when(code == first.code, first.error_reason)
    for rule in rest:
        label = label.when(code == rule.code, rule.error_reason)
    return label


def error_catalog(spark: SparkSession) -> DataFrame:
    """One row per rule, in display order."""
    rows = [
        F.struct(
            F.lit(rule.category_sort_order).alias("category_sort_order"),
            F.lit(rule.error_category).alias("error_category"),
            F.lit(rule.sort_order).alias("sort_order"),
            F.lit(rule.code).alias("error_code"),
            F.lit(rule.error_reason).alias("error_reason"),
        )
        for rule in sorted(RULES, key=lambda rule: rule.sort_order)
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))
