"""Checks over input that breaks them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from sample import make_inputs, sample_rows

from tallyline.operators.checks import duplicate_keys, orphan_keys, unexpected_values
from tallyline.operators.errors import error_rows
from tallyline.operators.joins import JoinStats
from tallyline.operators.rules import FLAGS
from tallyline.operators.staging import stage
from tallyline.plans.quality import ERROR_MART, ORDER_MART, quality_report, row_report
from tallyline.plans.reconcile import reconcile


@pytest.fixture(scope="module")
def mart(spark):
    staged = stage(make_inputs(spark, sample_rows()))
    return reconcile(staged, JoinStats(merchants_fit=True)).cache()


def failing(report):
    return {
        (row["check_name"], row["column_name"]): row["failing_rows"]
        for row in report.collect()
        if row["failing_rows"]
    }


def test_wrong_count_and_verdict(mart):
    wrong = mart.withColumn("error_count", F.col("error_count") + 1)
    assert failing(row_report(ORDER_MART, wrong)) == {
        ("error_count", "error_count"): 200, ("status", "reconciliation_status"): 173,
    }
    turned = mart.withColumn("reconciliation_status", F.lit("MATCHED"))
    assert failing(row_report(ORDER_MART, turned)) == {("status", "reconciliation_status"): 27}


def test_nulls_and_unknown_values(mart):
    empty = mart.withColumns({code: F.lit(None).cast("boolean") for code in FLAGS}).withColumn(
        "reconciliation_status", F.lit("LATE")
    )
    found = failing(row_report(ORDER_MART, empty, ("not_null", "accepted_values")))
    assert found == {
        **{("not_null", code): 200 for code in FLAGS},
        ("accepted_values", "reconciliation_status"): 200,
    }


def test_error_mart_checks(mart):
    errors = error_rows(mart)
    broken = errors.withColumn("error_code", F.lit("is_odd")).withColumn(
        "order_id", F.concat(F.lit("Z"), "order_id")
    )
    report = quality_report({ORDER_MART: mart, ERROR_MART: broken})
    assert failing(report) == {
        ("accepted_values", "error_code"): 34, ("relationships", "order_id"): 34,
    }


def test_only_given_tables_are_checked(mart):
    names = {row["table_name"] for row in quality_report({ORDER_MART: mart}).collect()}
    assert names == {ORDER_MART}


def test_violations(spark):
    table = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert [tuple(row) for row in duplicate_keys(table, "k").collect()] == [("a", 2)]
    assert [tuple(row) for row in unexpected_values(table, "k", ["b"]).collect()] == [("a", 2)]
    parent = spark.createDataFrame([("b",), ("b",), (None,)], "p string")
    assert [tuple(row) for row in orphan_keys(table, "k", parent, "p").collect()] == [("a", 2)]
