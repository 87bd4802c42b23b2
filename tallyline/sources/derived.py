"""Raw tables with known anomalies, derived from the generic orders, customer and lineitem tables.

Which anomaly a row carries follows from its key, so a SQL oracle can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.rules import FLAGS, verdict
from tallyline.schemas import RAW_COLUMNS, Inputs


# The columns that are read; naming their types saves a job that would infer them.
COLUMNS = {
    "customer": "c_custkey bigint, c_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, "
    "l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = "cast((25 + c_custkey % 5 * 5) as decimal(9,0)) * cast('0.001' as decimal(9,9))"
    return (
        _table(spark, sf_dir, "customer")
        .where("c_custkey % 97 != 13")
        .selectExpr(
            "c_custkey as c",
            "' M' || c_custkey as merchant_id",
            "c_name || ' ' as merchant_name",
            f"if(c_custkey % 89 = 7, null, cast({rate} as decimal(18,9))) as fee_rate",
        )
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k",
        "o_custkey as c",
        "'O' || o_orderkey as order_id",
        "'M' || o_custkey || ' ' as merchant_id",
        "cast(floor(o_totalprice) as bigint) as order_amount",
        "o_orderdate as ordered_at",
    )


def _payments(orders: DataFrame) -> DataFrame:
    return (
        orders.where("k % 101 != 5")
        .selectExpr("*", "order_amount - if(k % 103 = 11, 500, 0) as base")
        .selectExpr(
            "k",
            "c",
            "merchant_id",
            "ordered_at",
            "base",
            "'P' || k as payment_id",
            "order_id",
            "if(k % 167 = 71, 'n/a', cast(base as string)) as payment_amount",
            "case when k % 107 = 17 then 'failed' when k % 2 = 0 then ' success ' else 'SUCCESS' "
            "end as payment_status",
            "if(k % 107 = 17, ' ', 'B' || k) as settlement_batch_id",
            "case when k % 127 = 31 then null when k % 109 = 19 then ordered_at - interval 1 day "
            "else ordered_at + interval 1 minute end as paid_at",
        )
    )


def _settlements(payments: DataFrame, merchants: DataFrame) -> DataFrame:
    fee = "cast(round(cast(base as decimal(19,0)) * fee_rate) as bigint)"
    return (
        payments.where("k % 113 != 23 and k % 107 != 17")
        .join(merchants.select("c", "fee_rate"), "c", "left")
        .selectExpr("*", f"coalesce({fee}, 0) as fee0")
        .selectExpr(
            "'S' || k as settlement_id",
            "' B' || k as settlement_batch_id",
            "if(k % 131 = 37, 'M-X', merchant_id) as merchant_id",
            "base + if(k % 137 = 41, 250, 0) as gross_amount",
            "fee0 + if(k % 139 = 43, 1, 0) as fee_amount",
            "base - fee0 - if(k % 149 = 47, 100, 0) as net_amount",
            "if(k % 151 = 53, 'pending', 'completed ') as settlement_status",
            "case when k % 163 = 61 then null when k % 157 = 59 then ordered_at - interval 2 day "
            "else ordered_at + interval 3 day end as settled_at",
        )
    )


def derived_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """One payment and one settlement per order at most, with every anomaly on some orders."""
    merchants = _merchants(spark, sf_dir)
    orders = _orders(spark, sf_dir)
    payments = _payments(orders)
    settlements = _settlements(payments, merchants)
    return Inputs(
        merchants=merchants.select(RAW_COLUMNS["merchants"]),
        orders=orders.select(RAW_COLUMNS["orders"]),
        payments=payments.select(RAW_COLUMNS["payments"]),
        settlements=settlements.select(RAW_COLUMNS["settlements"]),
    )


def expected_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reconciliation of derived_inputs must find, read off the keys without any join.

    To show that a comparison notices a difference, the expected status of orders with
    key % 211 = 100 is turned round and orders with key % 223 = 7 get an id that does not exist.
    """
    keys = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k",
        "o_orderkey % 101 != 5 and o_orderkey % 107 != 17 as paid",
        "o_custkey % 97 != 13 as listed",
        "o_custkey % 89 != 7 as rated",
        "o_orderkey % 167 != 71 as readable",
    )
    flags = {
        "is_payment_missing": "not paid",
        "is_merchant_missing": "not listed",
        "is_fee_rate_missing": "listed and not rated",
        "is_order_payment_amount_mismatch": "paid and (k % 103 = 11 or not readable)",
        "is_settlement_missing": "paid and not settled",
        "is_settlement_not_completed": "settled and k % 151 = 53",
        "is_merchant_mismatch": "settled and k % 131 = 37",
        "is_gross_amount_mismatch": "settled and (k % 137 = 41 or not readable)",
        "is_fee_amount_mismatch": "settled and listed and rated and readable and k % 139 = 43",
        "is_net_amount_mismatch": "settled and listed and rated and readable and k % 149 = 47",
        "is_payment_datetime_invalid": "paid and (k % 127 = 31 or k % 109 = 19)",
        "is_settlement_datetime_invalid":
            "settled and (k % 127 = 31 or k % 163 = 61 or k % 157 = 59)",
    }
    total = " + ".join(f"cast(expected_{code} as bigint)" for code in FLAGS)
    return (
        keys.selectExpr("*", "paid and k % 113 != 23 as settled")
        .selectExpr("k", *[f"{flags[code]} as expected_{code}" for code in FLAGS])
        .selectExpr("*", f"{total} as expected_error_count")
        .withColumn("status", verdict(F.col("expected_error_count")))
        .selectExpr(
            "if(k % 223 = 7, 'X', 'O') || k as order_id",
            *[f"expected_{code}" for code in FLAGS],
            "expected_error_count",
            "case when k % 211 != 100 then status when status = 'ERROR' then 'MATCHED' "
            "else 'ERROR' end as expected_reconciliation_status",
        )
    )


def messy_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """All text, with duplicates, orphans, shared batches, null keys and values that do not cast.

    Payments come from lineitem, so an order has several, and all of them share one batch.
    Values are padded with spaces, tabs and wide spaces.
    """
    tab, wide = "char(9)", "'\u3000'"
    merchant = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as c",
        f"{tab} || 'M' || c_custkey as merchant_id",
        f"{wide} || c_name as merchant_name",
        "case when c_custkey % 89 = 7 then '3%' when c_custkey % 83 = 5 then "
        "'12345678901.5' else '0.0' || (25 + c_custkey % 5 * 5) end as fee_rate",
    )
    merchants = merchant.where("c % 41 != 5").unionByName(merchant.where("c % 30 = 4"))

    order = (
        _table(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey as k",
            "o_custkey as c",
            "cast(floor(o_totalprice) as bigint) as price",
            "o_orderdate as day",
        )
        .selectExpr(
            "*",
            f"if(k % 40 != 3, 'O' || k || {wide}, null) as order_id",
            f"if(k % 45 != 8, 'M' || c || {tab}, null) as merchant_id",
            "if(k % 53 = 2, 'abc', cast(price as string)) as order_amount",
            "case when k % 59 = 1 then 'soon' when k % 61 = 1 then '10:30' "
            "else cast(day as string) end as ordered_at",
        )
    )
    orders = order.unionByName(order.where("k % 60 = 7"))

    settlement = order.selectExpr(
        "k",
        "if(k % 67 != 8, 'S' || k, null) as settlement_id",
        "if(k % 71 != 9, 'B' || k || ' ', null) as settlement_batch_id",
        "'M' || c || ' ' as merchant_id",
        "cast(price as string) as gross_amount",
        "cast(price % 1000 as string) as fee_amount",
        "if(k % 73 = 4, '', cast(price - price % 1000 as string)) as net_amount",
        "case k % 4 when 0 then 'completed' when 1 then 'COMPLETED ' when 2 then ' pending' end "
        "as settlement_status",
        "if(k % 79 != 6, cast(day + interval 30 day as string), null) as settled_at",
    )
    settlements = settlement.unionByName(settlement.where("k % 50 = 0"))

    payments = (
        _table(spark, sf_dir, "lineitem")
        .selectExpr("*", "l_orderkey as k", "l_orderkey + l_linenumber as s")
        .selectExpr(
            "if(s % 61 != 5, 'P' || k || '-' || l_linenumber, null) as payment_id",
            "case when s % 43 = 1 then null when s % 47 = 3 then 'X' || k "
            "when s % 41 = 2 then 'O' || k || char(10) when s % 41 = 3 then 'O' || k || char(13) || char(10) "
            f"else ' O' || k || {tab} end as order_id",
            "if(s % 37 = 2, 'n/a', cast(cast(floor(l_extendedprice) as bigint) as string)) "
            "as payment_amount",
            f"case s % 6 when 0 then 'failed' when 1 then {wide} || 'success ' when 2 then "
            "if(s % 5 = 1, 'SUCCESS\u2028', 'SUCCESS' || char(13)) when 3 then 'Success' when 4 then 'refunded' end as payment_status",
            f"case when s % 31 = 6 then null when s % 29 = 4 then {tab} || ' ' "
            "when s % 23 = 5 then 'B' || k || char(133) else ' B' || k end as settlement_batch_id",
            "if(s % 83 = 2, '2026-13-45', cast(l_shipdate as string)) as paid_at",
        )
    )
    return Inputs(
        merchants=merchants.select(RAW_COLUMNS["merchants"]),
        orders=orders.select(RAW_COLUMNS["orders"]),
        payments=payments,
        settlements=settlements.select(RAW_COLUMNS["settlements"]),
    )
