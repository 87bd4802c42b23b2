"""Staged tables to the order mart."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.money import expected_fee, expected_net
from tallyline.operators.joins import JoinStats, left_join, measure_joins, successful_payments
from tallyline.operators.rules import FLAGS, Rule, flag_columns, raised_flags, verdict
from tallyline.schemas import ORDER_COLUMNS, Inputs
from tallyline.sources.warehouse import materialize

EVERY_SIDE = frozenset({"payments", "merchants", "settlements"})


def merchant_side(merchants: DataFrame) -> DataFrame:
    """Lookup columns of the master. merchant_master_id is null after the join if no row matched."""
    return merchants.select(
        "merchant_id",
        F.col("merchant_id").alias("merchant_master_id"),
        "merchant_name",
        "fee_rate",
    )


def settlement_side(settlements: DataFrame) -> DataFrame:
    return settlements.select(
        "settlement_id",
        "settlement_batch_id",
        F.col("merchant_id").alias("settlement_merchant_id"),
        "gross_amount",
        F.col("fee_amount").alias("actual_fee_amount"),
        F.col("net_amount").alias("actual_net_amount"),
        "settlement_status",
        "settled_at",
    )


def join_orders_to_payments(
    orders: DataFrame, payments: DataFrame, stats: JoinStats = JoinStats()
) -> DataFrame:
    """Every order with each of its successful payments, or once with none."""
    paid = successful_payments(payments).drop("payment_status")
    return left_join(orders, paid, "order_id", stats.hot_orders)


def join_orders_to_merchants(
    orders: DataFrame, merchants: DataFrame, stats: JoinStats = JoinStats()
) -> DataFrame:
    side = merchant_side(merchants)
    if stats.merchants_fit:
        return orders.join(F.broadcast(side), "merchant_id", "left")
    return left_join(orders, side, "merchant_id", stats.hot_merchants)


def join_payments_to_settlements(
    payments: DataFrame, settlements: DataFrame, stats: JoinStats = JoinStats()
) -> DataFrame:
    """Every successful payment with the settlement of its batch, if there is one."""
    paid = successful_payments(payments).drop("payment_status")
    return left_join(paid, settlement_side(settlements), "settlement_batch_id", stats.hot_batches)


def join_orders(
    staged: Inputs, stats: JoinStats | None = None, sides: Collection[str] = EVERY_SIDE
) -> DataFrame:
    """Orders with the chosen other tables.

    Payments meet settlements before they meet orders. The settlement join uses payment columns
    only, so the rows are the same, and unpaid orders bring no null batch id into it.

    A master that fits is joined last, so that its columns are not shuffled. One that does not fit
    is joined first, while the rows to shuffle are still four columns wide.
    """
    stats = measure_joins(staged) if stats is None else stats
    orders = staged.orders
    with_merchants = "merchants" in sides
    if with_merchants and not stats.merchants_fit:
        orders = join_orders_to_merchants(orders, staged.merchants, stats)
    if "settlements" in sides:
        paid = join_payments_to_settlements(staged.payments, staged.settlements, stats)
        if stats.hot_orders:  # the parts of the next join would each repeat this one
            paid = materialize(paid, "settled_payments")
        orders = left_join(orders, paid, "order_id", stats.hot_orders)
    elif "payments" in sides:
        orders = join_orders_to_payments(orders, staged.payments, stats)
    if with_merchants and stats.merchants_fit:
        orders = join_orders_to_merchants(orders, staged.merchants, stats)
    return orders


def add_expected_amounts(joined: DataFrame) -> DataFrame:
    fee = expected_fee(F.col("payment_amount"), F.col("fee_rate"))
    return joined.withColumn("expected_fee_amount", fee).withColumn(
        "expected_net_amount",
        expected_net(F.col("payment_amount"), F.col("expected_fee_amount")),
    )


def joined_orders(staged: Inputs, stats: JoinStats | None = None) -> DataFrame:
    """The order row that all rules read, with the master key still in it."""
    return add_expected_amounts(join_orders(staged, stats)).select(
        *ORDER_COLUMNS, "merchant_master_id"
    )


def judge(joined: DataFrame) -> DataFrame:
    """Twelve flags, their count and the verdict."""
    counted = joined.withColumns(flag_columns()).withColumn("error_count", raised_flags())
    return counted.withColumn("reconciliation_status", verdict(F.col("error_count"))).select(
        *ORDER_COLUMNS, *FLAGS, "error_count", "reconciliation_status"
    )


def reconcile(staged: Inputs, stats: JoinStats | None = None) -> DataFrame:
    """One row per order, or one per successful payment and settlement if the order has several."""
    return judge(joined_orders(staged, stats))


def apply_rule(staged: Inputs, rule: Rule, stats: JoinStats | None = None) -> DataFrame:
    """One rule on its own, joining only the tables that it compares."""
    joined = join_orders(staged, stats, rule.needs)
    if "merchants" in rule.needs and "payments" in rule.needs:
        joined = add_expected_amounts(joined)
    return joined.select("order_id", rule.broken().alias(rule.code))
