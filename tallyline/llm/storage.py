"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm.textbytes import release_memory
from tallyline.sources import warehouse

#: Bytes of an Arrow batch and of a row group of stored tables. Both are held in memory once a task.
BATCH_BYTES, ROW_GROUP_BYTES = 8 << 20, 16 << 20

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get texts a few megabytes at a time."""
    spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again; cuts the lineage.

    compression is the session's unless given. warehouse.clear_scratch() removes what was written, at the latest at exit.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = warehouse.scratch_path(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path, compression=compression)
    gc.collect()  # models and plans of earlier steps
    release_memory()
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows that make() gives, stored, without the tables that it stored on the way."""
    with warehouse.scratch_of_its_own() as used:
        out = stored(make(), name)
    for folder in used[:-1]:
        warehouse.remove_folder(folder, out.sparkSession)
    return out
