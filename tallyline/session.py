"""Spark session with the settings that the job relies on."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

LEAST_PARTITIONS = 16

SETTINGS = {
    # Text timestamps carry no zone; they are read as UTC wherever the job runs.
    "spark.sql.session.timeZone": "UTC",
    # A bad value must be told from an overflow, so nothing wraps round silently.
    "spark.sql.ansi.enabled": "true",
    # Skewed left sides and hot keys are split, and empty shuffle partitions merged, at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where what follows groups by its key, for one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Hash instead of sort where every partition of the build side is measured to be this small.
    # A hash table cannot spill, so the limit stays far below the memory of one task.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Do not look up the Python call site of every column expression while a plan is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def settings_for(input_bytes: int) -> dict[str, str]:
    """Split size and number of shuffle partitions for an input of this size.

    Adaptive execution merges shuffle partitions but never adds any, so the number has to start
    high. Every map task writes a block for every partition, though: with 128 MiB each, 100 TiB
    would make blocks of a hundred bytes. So tasks grow with the root of the input beyond 1 TiB,
    up to 1 GiB, which the sort-based joins and aggregations can spill.
    """
    growth = math.sqrt(max(1.0, input_bytes / 2**40))
    task_bytes = min(2**30, int(2**27 * growth))
    return {
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
        "spark.sql.shuffle.partitions": str(max(LEAST_PARTITIONS, math.ceil(input_bytes / task_bytes))),
    }


def planned_bytes(table: DataFrame) -> int | None:
    """What the optimizer takes a table's size to be, as it prints it; None if it does not know."""
    view = f"sized_{uuid4().hex}"
    table.createOrReplaceTempView(view)
    try:
        plan = table.sparkSession.sql(f"EXPLAIN COST SELECT * FROM {view}").first()[0]
    finally:
        table.sparkSession.catalog.dropTempView(view)
    found = re.search(r"sizeInBytes=([\d.]+(?:E[+-]?\d+)?) ?([KMGTPE]?)i?B", plan)
    if not found:
        return None
    size = int(float(found[1]) * 1024 ** " KMGTPE".index(found[2] or " "))
    return size if size < 2**62 else None


def size_tasks(tables: Iterable[DataFrame], input_bytes: int | None = None) -> dict[str, str]:
    """Set split size and shuffle partitions by the size of the input, given or measured.

    Takes no job: file sizes and table statistics are there once the tables are planned. Without any
    known size the settings stay as they are.
    """
    tables = list(tables)
    if input_bytes is None:
        sizes = [planned_bytes(table) for table in tables]
        input_bytes = None if None in sizes else sum(sizes)
    settings = {} if input_bytes is None else settings_for(input_bytes)
    for key, value in settings.items():
        tables[0].sparkSession.conf.set(key, value)
    return settings


@contextmanager
def finer_tasks(spark: SparkSession, parts: int = 4) -> Iterator[None]:
    """Cut splits and merged shuffle partitions so many times smaller within the block.

    For steps whose tasks compute or write far more than they read. Of these, a few tasks more than
    there are cores would take twice as long as one a core.
    """
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {key: spark.conf.get(key) for key in keys}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, size in before.items():
        spark.conf.set(key, str(max(1, in_bytes(size) // parts)))
    try:
        yield
    finally:
        for key, size in before.items():
            spark.conf.set(key, size)


@contextmanager
def splits_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Read files in splits of so many bytes at most within the block, for steps that hold a split in memory."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(key, str(min(most, in_bytes(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_session(
    name: str = "tallyline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
