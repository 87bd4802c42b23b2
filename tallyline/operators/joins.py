"""Left joins that stay parallel when one key holds a large part of a table.

Adaptive execution splits an oversized partition of a left join on its left side only. Rows that
pile up on the right side (many payments of one order, many settlements of one batch) would still
land in one task. An inner join is split on both sides, and a left join is an inner join and the left
rows without a match. So where statistics say that a key is crowded, the join is taken in these parts.
Both ways give the same rows whatever the statistics say; they choose the plan and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.schemas import Inputs


@dataclass(frozen=True)
class JoinPolicy:
    hot_rows: int = 2_000_000  # rows of one key that are too many for one task
    sample_fraction: float = 1 / 64  # part of the rows read to find such a key
    broadcast_bytes: int = 128 * 1024 * 1024  # largest merchant master that is broadcast


@dataclass(frozen=True)
class JoinStats:
    """What one pass over the join keys found: which right sides have a crowded key."""

    hot_orders: bool = False
    hot_batches: bool = False
    hot_merchants: bool = False
    merchants_fit: bool = False


def successful_payments(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("payment_status") == "SUCCESS")


def left_join(left: DataFrame, right: DataFrame, key: str, split: bool = False) -> DataFrame:
    """`left` left-joined to `right` on `key`; with `split`, as the inner join, the left rows whose
    key is not on the right, and those without a key, which need no shuffle."""
    if not split:
        return left.join(right, key, "left")
    keyed = left.where(F.col(key).isNotNull())
    known = right.where(F.col(key).isNotNull()).select(key).distinct()
    alone = keyed.join(known, key, "left_anti").unionByName(left.where(F.col(key).isNull()))
    return keyed.join(right, key, "inner").unionByName(alone, allowMissingColumns=True)


def _largest_group(table: DataFrame, key: str, tag: str, policy: JoinPolicy) -> DataFrame:
    """Rows of the key that has most, estimated from a sample. Counts combine map-side."""
    rows = table.where(F.col(key).isNotNull()).select(key)
    if policy.sample_fraction < 1:
        rows = rows.sample(fraction=policy.sample_fraction, seed=17)
    return rows.groupBy(key).count().agg(
        F.lit(tag).alias("tag"), F.coalesce(F.max("count"), F.lit(0)).alias("size")
    )


def _bytes_of(table: DataFrame) -> DataFrame:
    text = F.coalesce(F.octet_length("merchant_id"), F.lit(0)) + F.coalesce(
        F.octet_length("merchant_name"), F.lit(0)
    )
    per_row = 64  # hash table entry, row header and fee rate
    return table.agg(
        F.lit("bytes").alias("tag"), F.coalesce(F.sum(text + F.lit(per_row)), F.lit(0)).alias("size")
    )


def measure_joins(staged: Inputs, policy: JoinPolicy = JoinPolicy()) -> JoinStats:
    """One Spark job that sizes the merchant master and the largest group of each right side."""
    paid = successful_payments(staged.payments)
    found = (
        _largest_group(paid, "order_id", "orders", policy)
        .unionByName(_largest_group(staged.settlements, "settlement_batch_id", "batches", policy))
        .unionByName(_largest_group(staged.merchants, "merchant_id", "merchants", policy))
        .unionByName(_bytes_of(staged.merchants))
        .collect()  # four rows
    )
    size = {row["tag"]: row["size"] for row in found}
    least = max(1, int(policy.hot_rows * policy.sample_fraction))
    return JoinStats(
        hot_orders=size["orders"] >= least,
        hot_batches=size["batches"] >= least,
        hot_merchants=size["merchants"] >= least,
        merchants_fit=size["bytes"] <= policy.broadcast_bytes,
    )
