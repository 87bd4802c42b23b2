"""Skewed keys: the result must be whole, and the work must be split."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from brute_force import order_rows
from pyspark.sql import functions as F
from sample import make_inputs

from tallyline.operators.joins import JoinPolicy, JoinStats, left_join, measure_joins
from tallyline.operators.rules import FLAGS
from tallyline.operators.staging import stage
from tallyline.plans.reconcile import join_orders, join_orders_to_merchants, reconcile

EAGER = JoinPolicy(hot_rows=50, sample_fraction=1.0)


def final_plan(table):
    table.write.format("noop").mode("overwrite").save()
    table.collect()
    return table._jdf.queryExecution().executedPlan().toString()


def skewed_rows():
    """A third of the payments on one order, of the settlements on one batch, of the orders on one
    merchant; a third of the payments without a batch. Some values of every kind are wrong."""
    dice = random.Random(5)
    amounts = ["100", "100", "100", "90", "x", None]
    times = ["2026-07-01 10:00:00", "2026-07-01 11:00:00", "2026-07-02 00:00:00", "soon", None]
    merchants = [(f"M{n}", f"shop {n}", dice.choice(["0.03", "0.025", None])) for n in range(20)]
    merchants.append(("M1 ", "twin", "0.045"))
    orders = [
        (f"O{n}", "M1" if n % 3 == 0 else f" M{dice.randrange(25)}", dice.choice(amounts),
         dice.choice(times))
        for n in range(300)
    ] + [("O7", "M2", "100", times[0]), (None, "M2", "5", None)]
    payments = [
        (f"P{n}", "O7" if n % 3 == 0 else f"O{dice.randrange(320)} ", dice.choice(amounts),
         "failed" if n % 11 == 0 else " success",
         None if n % 3 == 1 else "B5" if n % 50 == 0 else f"B{dice.randrange(300)}",
         dice.choice(times))
        for n in range(600)
    ]
    settlements = [
        (f"S{n}", "B5" if n % 3 == 0 else f"B{dice.randrange(300)}",
         dice.choice(["M1", "M2", None]), dice.choice(amounts), dice.choice(["2", "3", "4", None]),
         dice.choice(["96", "97", "98", ""]), dice.choice(["Completed ", "pending", None]),
         dice.choice(times))
        for n in range(300)
    ] + [("S-", None, "M1", "100", "3", "97", "COMPLETED", None)]
    return {
        "merchants": merchants, "orders": orders, "payments": payments, "settlements": settlements
    }


@pytest.fixture(scope="module")
def skewed(spark):
    return stage(make_inputs(spark, skewed_rows()))


def test_crowded_sides_are_found(skewed):
    assert measure_joins(skewed, EAGER) == JoinStats(True, True, False, True)


def test_small_tables_have_no_hot_keys(skewed):
    assert measure_joins(skewed) == JoinStats(merchants_fit=True)


def test_a_master_over_the_limit_is_not_broadcast(skewed):
    assert not measure_joins(skewed, JoinPolicy(broadcast_bytes=100)).merchants_fit


@pytest.mark.parametrize(
    "stats",
    [
        JoinStats(hot_orders=True, hot_batches=True, merchants_fit=True),
        JoinStats(hot_orders=True, hot_batches=True, hot_merchants=True),
        JoinStats(hot_batches=True, hot_merchants=True),
        JoinStats(merchants_fit=False),
        JoinStats(merchants_fit=True),
    ],
)
def test_every_way_gives_the_mart_of_nested_loops(skewed, stats):
    found = Counter(
        (row["order_id"], row["payment_id"], row["settlement_id"], row["merchant_name"],
         row["expected_fee_amount"], frozenset(code for code in FLAGS if row[code]))
        for row in reconcile(skewed, stats).collect()
    )
    assert found == Counter(order_rows(skewed_rows()))
    assert set().union(*[key[-1] for key in found]) == set(FLAGS)


def test_left_join_equals_brute_force(spark):
    left_rows = [(k, i) for i, k in enumerate(["a", "a", "b", "c", None, None, "d"])]
    # Keys of the left that the right lacks, and the other way round, keep or lose their rows.
    right_rows = [(k, i) for i, k in enumerate(["a"] * 40 + ["b", "x", None, None] + ["e"] * 3)]
    expected = []
    for key, i in left_rows:
        matches = [j for k, j in right_rows if key is not None and k == key] or [None]
        expected += [(key, i, j) for j in matches]
    left = spark.createDataFrame(left_rows, "key string, i int")
    right = spark.createDataFrame(right_rows, "key string, j int")
    for split in (False, True):
        joined = left_join(left, right, "key", split)
        assert joined.columns == ["key", "i", "j"]
        assert sorted((tuple(row) for row in joined.collect()), key=str) == sorted(expected, key=str)


def test_a_split_join_reads_each_side_twice_at_most(spark, tmp_path):
    for side in ("left", "right"):
        spark.range(100).selectExpr("cast(id % 7 as string) as key", f"id as {side}").write.parquet(
            f"{tmp_path}/{side}"
        )
    left, right = (spark.read.parquet(f"{tmp_path}/{side}") for side in ("left", "right"))
    plan = left_join(left, right, "key", True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("/left") + plan.count("[key#") > 0
    assert plan.count("Relation [") <= 5  # left: inner, anti and null part; right: inner and keys


def test_a_join_stays_split_under_an_aggregation(spark, tiny_skew_limits):
    """Grouping by the join's key, as the check for duplicates does, would otherwise forbid it."""
    third = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    left, right = rows(spark, 9_000, third), rows(spark, 300, F.col("id").cast("string"))
    joined = left.join(right.withColumnRenamed("payload", "other"), "key", "left")
    counted = joined.groupBy("key").agg(F.count("*").alias("n"), F.max("payload"))
    assert "skew=true" in final_plan(counted)
    assert counted.where("n > 1").first()[:2] == ("hot", 3_000)


@pytest.fixture
def tiny_skew_limits(spark):
    """Let adaptive execution treat kilobytes as it treats hundreds of megabytes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def rows(spark, count, key):
    return spark.range(0, count, 1, 8).select(key.alias("key"), F.uuid().alias("payload"))


def test_many_right_rows_of_one_key_are_split(spark, tiny_skew_limits):
    third = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    right = rows(spark, 9_000, third)
    left = spark.range(0, 9_000, 1, 8).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("key")
    )
    plain, split = left_join(left, right, "key"), left_join(left, right, "key", True)
    assert "skew=true" not in final_plan(plain)
    assert "skew=true" in final_plan(split)
    assert split.count() == plain.count()


def test_null_batches_of_the_left_side_are_split(spark, tiny_skew_limits):
    """Payments without a batch share one null key, which adaptive execution can split."""
    third = F.when(F.col("id") % 3 != 0, F.col("id").cast("string"))
    joined = left_join(rows(spark, 9_000, third), rows(spark, 9_000, third), "key")
    assert "skew=true" in final_plan(joined)


def test_a_merchant_with_a_third_of_the_orders_is_split(spark, tiny_skew_limits):
    third = F.when(F.col("id") % 3 == 0, "M0").otherwise(F.col("id").cast("string"))
    orders = rows(spark, 9_000, third).withColumnRenamed("key", "merchant_id")
    merchants = spark.range(0, 9_000, 1, 8).select(
        F.concat(F.lit("M"), "id").alias("merchant_id"),
        F.lit("shop").alias("merchant_name"),
        F.lit(None).cast("decimal(18,9)").alias("fee_rate"),
    )
    assert "skew=true" in final_plan(join_orders_to_merchants(orders, merchants, JoinStats()))


def test_a_rule_joins_only_what_it_compares(skewed):
    def joins(sides):
        plan = join_orders(skewed, JoinStats(), sides)._jdf.queryExecution().optimizedPlan()
        return plan.toString().count("Join LeftOuter")

    assert joins({"payments"}) == joins({"merchants"}) == 1
    assert joins({"payments", "settlements"}) == 2
    assert joins({"payments", "settlements", "merchants"}) == 3
