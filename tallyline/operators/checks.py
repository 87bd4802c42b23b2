"""Checks as DataFrames of violations. A check passes when its DataFrame is empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.rules import raised_flags, verdict
from tallyline.sources.warehouse import materialize


def missing_value(column: str) -> Column:
    return F.col(column).isNull()


def unexpected_value(column: str, accepted: Sequence[str]) -> Column:
    """A null value passes."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*accepted)


def wrong_error_count() -> Column:
    return F.col("error_count") != raised_flags()


def wrong_verdict() -> Column:
    return F.col("reconciliation_status") != verdict(F.col("error_count"))


def key_counts(table: DataFrame, key: str) -> DataFrame:
    """Rows per key value without nulls. Counts combine map-side, so a key that fills a third of
    the table costs one row per task."""
    return table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_records"))


def suspect_hashes(table: DataFrame, key: str) -> DataFrame:
    """Hashes that more than one row's key has. Eight bytes and a count stand for a key here, added up
    in each task first, so keys themselves stay where they are."""
    hashes = table.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"))
    return hashes.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("h")


def duplicate_keys(table: DataFrame, key: str, broadcast_hashes: int = 1_000_000) -> DataFrame:
    """Key values that occur more than once, with their number of rows.

    Two passes: the first finds the hashes that occur more than once, the second counts the keys that
    have one of these, exactly. So of keys that occur once only hashes are shuffled, apart from the
    very few whose hash another key shares. Up to `broadcast_hashes` hashes (16 MB) are broadcast, as
    counted; more are joined.
    """
    suspects = materialize(suspect_hashes(table, key), "suspect_hashes")
    if suspects.count() <= broadcast_hashes:
        suspects = F.broadcast(suspects)
    hashed = F.xxhash64(table[key]) == suspects["h"]
    keys = table.join(suspects, hashed, "left_semi")
    return key_counts(keys, key).where(F.col("n_records") > 1)


def unexpected_values(table: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Each value outside the accepted ones with its number of rows."""
    return (
        table.where(unexpected_value(column, accepted))
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent row, with their number of child rows.

    Both sides shrink to one row per key before the shuffle, and the join keeps the partitioning of
    the two counts. Counting the parents, where distinct keys would do, lets one query that also
    looks for duplicate parent keys shuffle them once.
    """
    parents = key_counts(parent, parent_key).select(
        F.col(parent_key).alias(child_key), F.col("n_records").alias("n_parents")
    )
    return (
        key_counts(child, child_key)
        .join(parents, child_key, "left")
        .where(F.col("n_parents").isNull())
        .drop("n_parents")
    )
