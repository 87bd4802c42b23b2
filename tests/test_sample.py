"""The whole chain over the sample: per order, per metric, per report and per check."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from sample import EXPECTED_ERRORS, EXPECTED_METRICS, make_inputs, sample_rows

from tallyline.operators.errors import error_rows
from tallyline.operators.golden import metric_differences, metric_distribution, order_differences
from tallyline.operators.rules import FLAGS, RULES
from tallyline.operators.staging import stage
from tallyline.plans.quality import quality_report, table_set
from tallyline.plans.reconcile import apply_rule, reconcile
from tallyline.plans.reports import error_details, error_type_summary
from tallyline.schemas import ERROR_COLUMNS, ORDER_COLUMNS


@pytest.fixture(scope="module")
def staged(spark):
    return stage(make_inputs(spark, sample_rows()))


@pytest.fixture(scope="module")
def mart(staged):
    return reconcile(staged).cache()


@pytest.fixture(scope="module")
def errors(mart):
    return error_rows(mart).cache()


def test_layout(mart, errors):
    types = {field.name: field.dataType.simpleString() for field in mart.schema}
    assert mart.columns == [*ORDER_COLUMNS, *FLAGS, "error_count", "reconciliation_status"]
    assert len(mart.columns) == 33
    assert types["fee_rate"] == "decimal(38,9)"
    assert types["ordered_at"] == types["paid_at"] == types["settled_at"] == "timestamp"
    assert {types[code] for code in FLAGS} == {"boolean"}
    assert types["error_count"] == types["expected_fee_amount"] == "bigint"
    assert errors.columns == ERROR_COLUMNS


def test_every_order(mart):
    rows = mart.collect()
    assert len(rows) == len({row["order_id"] for row in rows}) == 200
    for row in rows:
        raised = {code for code in FLAGS if row[code]}
        expected = EXPECTED_ERRORS.get(row["order_id"], set())
        assert raised == expected, row["order_id"]
        assert row["error_count"] == len(expected)
        assert row["reconciliation_status"] == ("ERROR" if expected else "MATCHED")


def test_rules_on_their_own(staged, mart):
    for rule in RULES:
        alone = {tuple(row) for row in apply_rule(staged, rule).collect()}
        assert alone == {tuple(row) for row in mart.select("order_id", rule.code).collect()}


def test_error_rows(errors):
    found = {}
    for row in errors.collect():
        found.setdefault(row["order_id"], set()).add(row["error_code"])
    assert found == EXPECTED_ERRORS
    reasons = {(row["error_code"], row["error_reason"]) for row in errors.collect()}
    assert reasons == {(rule.code, rule.error_reason) for rule in RULES}


def test_metrics(spark, mart, errors):
    actual = metric_distribution(mart, errors)
    assert {row["metric"]: row["actual_value"] for row in actual.collect()} == EXPECTED_METRICS
    expected = spark.createDataFrame(
        list(EXPECTED_METRICS.items()), "metric string, expected_value bigint"
    )
    assert metric_differences(expected, actual).isEmpty()
    wrong = expected.withColumn("expected_value", F.col("expected_value") + 1).union(
        spark.createDataFrame([("unknown", 1)], "metric string, expected_value bigint")
    )
    assert metric_differences(wrong, actual).count() == 17


def golden_orders(spark, orders):
    fields = ", ".join(f"expected_{code} boolean" for code in FLAGS)
    rows = []
    for order in orders:
        raised = EXPECTED_ERRORS.get(order, set())
        status = "ERROR" if raised else "MATCHED"
        rows.append((order, *[code in raised for code in FLAGS], len(raised), status))
    return spark.createDataFrame(
        rows,
        f"order_id string, {fields}, expected_error_count bigint, "
        "expected_reconciliation_status string",
    )


def test_golden_orders(spark, mart):
    first_eight = [f"O00{n}" for n in range(1, 9)]
    assert order_differences(golden_orders(spark, first_eight), mart).isEmpty()


def test_golden_orders_notice_each_kind_of_difference(spark, mart):
    expected = golden_orders(spark, ["O001", "O002", "O003", "X999"])
    expected = expected.withColumn(
        "expected_error_count",
        F.when(F.col("order_id") == "O002", 5).otherwise(F.col("expected_error_count")),
    ).withColumn(
        "expected_is_payment_missing",
        F.when(F.col("order_id") != "O003", F.col("expected_is_payment_missing")),
    )
    expected = expected.withColumn(
        "expected_is_payment_missing",
        F.when(F.col("order_id") == "O001", False).otherwise(F.col("expected_is_payment_missing")),
    )
    rows = {row["order_id"]: row for row in order_differences(expected, mart).collect()}
    assert set(rows) == {"O002", "O003", "X999"}
    assert rows["O002"]["error_count"] == 1
    assert rows["X999"]["reconciliation_status"] is None


def test_summary(errors):
    rows = error_type_summary(errors).orderBy("category_sort_order", "sort_order").collect()
    assert [row["sort_order"] for row in rows] == list(range(1, 13))
    assert [row["category_sort_order"] for row in rows] == [1] * 4 + [2] + [3] * 5 + [4] * 2
    assert {row["error_code"]: row["error_count"] for row in rows} == {
        code: EXPECTED_METRICS[code] for code in FLAGS
    }


def test_summary_keeps_types_without_errors(errors):
    only_one = errors.where("error_code = 'is_merchant_missing'")
    counts = {row["error_code"]: row["error_count"] for row in error_type_summary(only_one).collect()}
    assert len(counts) == 12
    assert sum(counts.values()) == counts["is_merchant_missing"] == 2


def test_details(errors, mart):
    details = error_details(errors, mart)
    assert details.columns == [
        "order_id", "payment_id", "settlement_id", "merchant_id", "error_reason", "order_amount",
        "payment_amount", "gross_amount", "expected_gross_amount", "actual_fee_amount",
        "expected_fee_amount", "net_amount", "expected_net_amount", "settlement_status",
        "ordered_at", "paid_at", "settled_at",
    ]
    rows = details.collect()
    order = errors.orderBy("order_id", "error_code").select("order_id", "error_reason").collect()
    assert [(row["order_id"], row["error_reason"]) for row in rows] == [tuple(r) for r in order]
    pending = {row["order_id"] for row in rows if row["settlement_status"] == "PENDING"}
    assert pending == {"O020", "O021", "O022"}
    assert all(row["expected_gross_amount"] == row["payment_amount"] for row in rows)


def test_all_checks_pass(staged, mart, errors):
    report = quality_report(table_set(staged, mart, errors)).collect()
    kinds = [row["check_name"] for row in report]
    assert {kind: kinds.count(kind) for kind in kinds} == {
        "not_null": 26, "unique": 6, "accepted_values": 3, "relationships": 2,
        "error_count": 1, "status": 1,
    }
    assert [row for row in report if row["failing_rows"]] == []
