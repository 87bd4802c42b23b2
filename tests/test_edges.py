"""Input that the sample lacks: bad values, null keys, duplicates, shared batches, orphans."""

from __future__ import annotations

import pytest
from sample import make_inputs

from tallyline.operators.errors import error_rows
from tallyline.operators.rules import FLAGS
from tallyline.operators.staging import stage
from tallyline.plans.quality import quality_report, table_set
from tallyline.plans.reconcile import reconcile
from tallyline.plans.reports import error_details

MERCHANT = ("M1", "shop", "0.03")
ORDER = ("O1", "M1", "1000", "2026-07-01 10:00:00")
PAYMENT = ("P1", "O1", "1000", "SUCCESS", "B1", "2026-07-01 10:01:00")
SETTLEMENT = ("S1", "B1", "M1", "1000", "30", "970", "COMPLETED", "2026-07-03 00:00:00")


def changed(row, **positions):
    values = list(row)
    for position, value in positions.items():
        values[int(position[1:])] = value
    return tuple(values)


def build(spark, merchants=(MERCHANT,), orders=(ORDER,), payments=(PAYMENT,),
          settlements=(SETTLEMENT,)):
    raw = make_inputs(
        spark,
        {"merchants": list(merchants), "orders": list(orders), "payments": list(payments),
         "settlements": list(settlements)},
    )
    staged = stage(raw)
    return staged, reconcile(staged)


def flags(mart):
    return [{code for code in FLAGS if row[code]} for row in mart.collect()]


CASES = {
    "clean": ({}, set()),
    "bad payment amount": (
        {"payments": [changed(PAYMENT, _2="abc")]},
        {"is_order_payment_amount_mismatch", "is_gross_amount_mismatch"},
    ),
    "both amounts bad": (
        {"orders": [changed(ORDER, _2="x")], "payments": [changed(PAYMENT, _2="y")]},
        {"is_gross_amount_mismatch"},
    ),
    "bad rate": ({"merchants": [changed(MERCHANT, _2="3%")]}, {"is_fee_rate_missing"}),
    "no merchant": ({"merchants": []}, {"is_merchant_missing"}),
    "null order time": (
        {"orders": [changed(ORDER, _3=None)]}, {"is_payment_datetime_invalid"},
    ),
    "null payment time": (
        {"payments": [changed(PAYMENT, _5="later")]},
        {"is_payment_datetime_invalid", "is_settlement_datetime_invalid"},
    ),
    "null settlement time": (
        {"settlements": [changed(SETTLEMENT, _7=None)]}, {"is_settlement_datetime_invalid"},
    ),
    "equal times": (
        {"payments": [changed(PAYMENT, _5=ORDER[3])],
         "settlements": [changed(SETTLEMENT, _7=ORDER[3])]},
        set(),
    ),
    "paid before ordered, settled before paid": (
        {"payments": [changed(PAYMENT, _5="2026-07-01 09:59:59")],
         "settlements": [changed(SETTLEMENT, _7="2026-07-01 09:59:58")]},
        {"is_payment_datetime_invalid", "is_settlement_datetime_invalid"},
    ),
    "null settlement status": (
        {"settlements": [changed(SETTLEMENT, _6=None)]}, {"is_settlement_not_completed"},
    ),
    "padded lower case statuses": (
        {"payments": [changed(PAYMENT, _3="　success ")],
         "settlements": [changed(SETTLEMENT, _6="\tCompleted ")]},
        set(),
    ),
    "blank batch": (
        {"payments": [changed(PAYMENT, _4="　 ")],
         "settlements": [changed(SETTLEMENT, _1=" ")]},
        {"is_settlement_missing"},
    ),
    "failed payment with a settlement": (
        {"payments": [changed(PAYMENT, _3="FAILED")]}, {"is_payment_missing"},
    ),
    "payment without id": (
        {"payments": [changed(PAYMENT, _0=None)]},
        {"is_payment_missing"},
    ),
    "ids padded with tabs and wide spaces": (
        {"merchants": [changed(MERCHANT, _0="M1\t")],
         "orders": [changed(ORDER, _0="　O1", _1=" M1")],
         "payments": [changed(PAYMENT, _1="O1　", _4="\tB1")],
         "settlements": [changed(SETTLEMENT, _1="B1\u00a0", _2="　M1")]},
        set(),
    ),
    "other merchant settled": (
        {"settlements": [changed(SETTLEMENT, _2="M2")]}, {"is_merchant_mismatch"},
    ),
    "null settlement merchant": (
        {"settlements": [changed(SETTLEMENT, _2=None)]}, {"is_merchant_mismatch"},
    ),
    "fee, net and gross wrong": (
        {"settlements": [changed(SETTLEMENT, _3="999", _4="31", _5=None)]},
        {"is_gross_amount_mismatch", "is_fee_amount_mismatch", "is_net_amount_mismatch"},
    ),
    "fee not judged without a rate": (
        {"merchants": [changed(MERCHANT, _2=None)],
         "settlements": [changed(SETTLEMENT, _4="1", _5="1")]},
        {"is_fee_rate_missing"},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_flags(spark, name):
    tables, expected = CASES[name]
    assert flags(build(spark, **tables)[1]) == [expected]


def test_two_successful_payments_give_two_rows_and_a_failed_check(spark):
    second = changed(PAYMENT, _0="P2", _4="B2")
    staged, mart = build(spark, payments=[PAYMENT, second])
    assert sorted((row["payment_id"], row["settlement_id"]) for row in mart.collect()) == [
        ("P1", "S1"), ("P2", None),
    ]
    report = quality_report(table_set(staged, mart, error_rows(mart)), ("unique",))
    failing = {(row["table_name"], row["column_name"]) for row in report.collect() if row["failing_rows"]}
    assert failing == {("fct_payment_reconciliation", "order_id")}
    # The status lookup joins on the order, so one error row meets both mart rows.
    assert error_details(error_rows(mart), mart).count() == 2


def test_payments_that_share_a_batch_each_get_the_settlement(spark):
    orders = [ORDER, changed(ORDER, _0="O2")]
    payments = [PAYMENT, changed(PAYMENT, _0="P2", _1="O2")]
    _, mart = build(spark, orders=orders, payments=payments)
    assert {row["settlement_id"] for row in mart.collect()} == {"S1"}


def test_orphans_stay_out_and_the_reference_check_reports_them(spark):
    payments = [PAYMENT, changed(PAYMENT, _0="P9", _1="O9", _4="B9"), changed(PAYMENT, _0="P8", _1=None)]
    settlements = [SETTLEMENT, changed(SETTLEMENT, _0="S9", _1="B9")]
    staged, mart = build(spark, payments=payments, settlements=settlements)
    assert [row["order_id"] for row in mart.collect()] == ["O1"]
    report = quality_report(table_set(staged, mart, error_rows(mart)))
    failing = {
        (row["table_name"], row["check_name"]): row["failing_rows"]
        for row in report.collect()
        if row["failing_rows"]
    }
    assert failing == {("stg_payments", "relationships"): 1, ("stg_payments", "not_null"): 1}


def test_null_order_ids_do_not_match_each_other(spark):
    orders = [changed(ORDER, _0=None), changed(ORDER, _0=None)]
    _, mart = build(spark, orders=orders, payments=[changed(PAYMENT, _1=None)])
    assert flags(mart) == [{"is_payment_missing"}] * 2
