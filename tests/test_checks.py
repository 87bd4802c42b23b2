"""How checks and comparisons work: what they shuffle, scan and join."""

from __future__ import annotations

import random

import pytest
from compare import spark_rows
from pyspark.sql import functions as F
from sample import make_inputs, sample_rows

from tallyline.operators import golden
from tallyline.operators.checks import duplicate_keys, key_counts
from tallyline.operators.errors import error_rows
from tallyline.operators.golden import COMPARED, order_differences
from tallyline.operators.rules import FLAGS
from tallyline.operators.staging import stage
from tallyline.plans.build import build_marts
from tallyline.plans.quality import ORDER_MART, quality_report, watch_rows
from tallyline.plans.reconcile import reconcile
from tallyline.plans.reports import error_details
from tallyline.sources.warehouse import FolderWarehouse


@pytest.fixture(scope="module")
def mart(spark):
    return reconcile(stage(make_inputs(spark, sample_rows()))).cache()


def plan_of(table) -> str:
    return table._jdf.queryExecution().executedPlan().toString()


def shuffled_bytes(spark, action) -> int:
    """What all stages of an action write for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = total()
    action()
    return total() - before


def test_duplicates_by_two_passes(spark):
    rng = random.Random(1)
    keys = [f"k{rng.randrange(500)}" for _ in range(2000)] + ["hot"] * 5000 + [None] * 50
    table = spark.createDataFrame([(k, 1) for k in keys], "k string, h int").repartition(4)
    expected = key_counts(table, "k").where("n_records > 1")
    for limit in (1_000_000, 0):
        assert spark_rows(duplicate_keys(table, "k", limit)) == spark_rows(expected)
    assert duplicate_keys(table.where("k is null"), "k").isEmpty()


def test_keys_that_occur_once_are_not_shuffled(spark):
    table = spark.range(200_000, numPartitions=4).select(F.sha2(F.col("id").cast("string"), 512).alias("k"))
    table = table.unionAll(table.limit(3)).cache()
    table.count()
    by_key = shuffled_bytes(spark, lambda: key_counts(table, "k").where("n_records > 1").collect())
    by_hash = shuffled_bytes(spark, lambda: duplicate_keys(table, "k").collect())
    assert duplicate_keys(table, "k").count() == 3
    assert by_hash < by_key / 5


def expected_rows(mart):
    """The mart's own verdicts as expected ones: some changed, one order unknown, one without id."""
    kept = mart.select("order_id", *[F.col(c).alias(f"expected_{c}") for c in COMPARED])
    first = FLAGS[0]
    changed = kept.withColumn(f"expected_{first}", F.when(F.col("order_id") > "O190", ~F.col(f"expected_{first}")).otherwise(F.col(f"expected_{first}")))
    gone = kept.limit(1).withColumn("order_id", F.lit("X"))
    return changed.unionAll(gone).unionAll(gone.withColumn("order_id", F.lit(None).cast("string")))


def plain_differences(expected, mart) -> list:
    rows = {}
    for row in mart.select("order_id", *COMPARED).collect():
        rows.setdefault(row[0], []).append(tuple(row[1:]))
    out = []
    for order, *wanted in map(tuple, expected.collect()):
        found = rows.get(order, []) if order is not None else []
        out += [(order, *wanted, *f) for f in found if f != tuple(wanted)]
        if not found:
            out.append((order, *wanted, *[None] * len(COMPARED)))
    return sorted(out, key=str)


@pytest.mark.parametrize("short", [0, 1 << 40])
def test_golden_orders_with_repeated_and_missing_ones(spark, mart, monkeypatch, short):
    monkeypatch.setattr(golden, "SHORT_LIST_BYTES", short)
    often = mart.where("order_id = 'O020'")
    second = often.withColumn("error_count", F.col("error_count") + 1)
    rows = mart.unionAll(often).unionAll(second).unionAll(second).unionAll(mart.limit(3).withColumn("order_id", F.lit(None).cast("string")))
    expected = expected_rows(mart)
    expected = expected.unionAll(expected.where("order_id in ('O199', 'X')"))
    got = sorted((tuple(r) for r in order_differences(expected, rows).collect()), key=str)
    assert got == plain_differences(expected, rows) and len(got) > 10


def test_golden_orders_read_the_mart_once(spark, mart, tmp_path, monkeypatch):
    mart.write.parquet(f"{tmp_path}/mart")
    expected_rows(mart).write.parquet(f"{tmp_path}/expected")
    read = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("expected", "mart")]
    monkeypatch.setattr(golden, "SHORT_LIST_BYTES", 0)
    plan = plan_of(order_differences(*read))
    assert plan.count("FileScan") == 2 and "Join" not in plan


def test_details_take_one_join_with_a_row_an_order(spark, mart, tmp_path):
    rows = mart.unionAll(mart.where("order_id <= 'O005'")).unionAll(mart.where("order_id <= 'O003'").withColumn("settlement_status", F.lit("ODD")))
    rows.write.parquet(f"{tmp_path}/mart")
    often = spark.read.parquet(f"{tmp_path}/mart")
    errors = error_rows(often)
    got = error_details(errors, often)
    statuses = often.select("order_id", "settlement_status")
    expected = errors.join(statuses, "order_id", "left").select("order_id", "error_reason", "settlement_status")
    assert spark_rows(got.select("order_id", "error_reason", "settlement_status")) == spark_rows(expected)
    assert got.count() > errors.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    tables = sample_rows()
    tables["orders"].append((None, None, "x", "2026-07-01 10:00:00"))
    raw = make_inputs(spark, tables)
    marts = build_marts(FolderWarehouse(spark, str(tmp_path)), raw)
    assert marts.watched["stg_orders", "not_null", "order_id"] == 1
    row_kinds = ("not_null", "accepted_values", "error_count", "status")
    told = quality_report(marts.tables(), row_kinds, marts.watched)
    assert "FileScan" not in plan_of(told)
    assert spark_rows(told) == spark_rows(quality_report(marts.tables(), row_kinds))
    whole = quality_report(marts.tables(), watched=marts.watched)
    assert spark_rows(whole) == spark_rows(quality_report(marts.tables()))
    plan = whole._jdf.queryExecution().sparkPlan().toString()
    by_key = [line for line in plan.splitlines() if "HashAggregate(keys=[domain" in line and "partial" not in line]
    assert len(by_key) == 1


def test_watching_changes_nothing(spark, mart):
    watched, told = watch_rows(ORDER_MART, mart.withColumn("reconciliation_status", F.lit("LATE")))
    assert watched.schema == mart.schema and watched.count() == mart.count()
    assert told()[ORDER_MART, "accepted_values", "reconciliation_status"] == mart.count()
    same, told = watch_rows("other", mart)
    assert same is mart and told() == {}
