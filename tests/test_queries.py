"""Registered queries against their SQL oracles, and the shape of their plans."""

from __future__ import annotations

import re

import __spark_entry__ as entry_points
import pytest
from compare import connect, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
CORPUS = entry_points._corpus("queries")  # tested with their package
QUERIES = {name: query for name, query in entry_points.queries().items() if name not in CORPUS}
ORACLES = {n: sql for n, sql in entry_points.oracle_sql().items() if n not in CORPUS}


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(oracle, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows, "an empty result proves nothing"


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500


def plan_of(table) -> str:
    return table._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["fct_payment_reconciliation", "messy_fct_reconciliation_errors"])
def test_marts_use_equality_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search("Cartesian|NestedLoop|Python|Pandas|ArrowEval", plan)


def test_filters_and_columns_reach_the_stored_tables(spark, tmp_path):
    from tallyline.operators.errors import error_rows
    from tallyline.operators.joins import successful_payments
    from tallyline.operators.staging import stage
    from tallyline.plans.reports import error_counts
    from tallyline.sources.derived import derived_inputs
    from tallyline.sources.warehouse import FolderWarehouse

    warehouse = FolderWarehouse(spark, str(tmp_path))
    staged = stage(derived_inputs(spark, SF_DIR))
    payments = warehouse.write("staging", "stg_payments", staged.payments)
    plan = plan_of(successful_payments(payments).select("order_id"))
    assert "EqualTo(payment_status,SUCCESS)" in plan
    assert "ReadSchema: struct<order_id:string,payment_status:string>" in plan

    mart = warehouse.write("marts", "orders", QUERIES["fct_payment_reconciliation"](spark, SF_DIR))
    plan = plan_of(error_counts(error_rows(mart)))
    assert "GreaterThan(error_count,0)" in plan
    read = plan.rsplit("ReadSchema:", 1)[1]
    assert "order_id" not in read.split("\n")[0]
