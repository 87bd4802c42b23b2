"""Readers for the four raw tables. Files stay untyped: every raw column is text."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.golden import Golden
from tallyline.operators.rules import FLAGS
from tallyline.schemas import RAW_COLUMNS, Inputs, raw_schema
from tallyline.sources.records import read_records


BAD_LINE = "bad_line"


def _csv(spark: SparkSession, multi_line: bool, header: bool = True) -> DataFrameReader:
    return (
        spark.read.option("header", header)
        .option("enforceSchema", False)  # fail if the header names other columns
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnPruning", False)  # else a line is only parsed as far as a query needs it
    )


def read_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """UTF-8 with a header line. A line with too few or too many fields fails the read.

    Lines are not joined, so that large files stay splittable; a quoted line break then makes two
    bad lines. With multi_line they are joined, and each file is read by one task;
    records.read_records gives the same rows by many.
    """
    reader = _csv(spark, multi_line).schema(raw_schema(table))
    return reader.option("mode", "FAILFAST").csv(path)


def read_csv_lines(
    spark: SparkSession, path: str, table: str, multi_line: bool = False, header: bool = True
) -> DataFrame:
    """As read_csv, but bad lines stay: bad_line has their text, and is null for good ones.

    Store the lines before bad_lines() reads them; Spark refuses to parse a file for these alone.
    """
    schema = T.StructType([*raw_schema(table), T.StructField(BAD_LINE, T.StringType())])
    reader = _csv(spark, multi_line, header).schema(schema)
    return reader.option("columnNameOfCorruptRecord", BAD_LINE).csv(path)


def good_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def bad_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(BAD_LINE).isNotNull()).select(BAD_LINE)


def read_csv_folder(
    spark: SparkSession, folder: str, multi_line: bool = False, whole_files: bool = False
) -> Inputs:
    """`folder` holds merchants.csv, orders.csv, payments.csv and settlements.csv.

    Each may be one file or a folder of part files. With multi_line, quoted line breaks are data, and
    files are still split over tasks; with whole_files too, Spark reads each by one task.
    """

    def read(name: str) -> DataFrame:
        path = f"{folder}/{name}.csv"
        split = multi_line and not whole_files
        return read_records(spark, path, name) if split else read_csv(spark, path, name, multi_line)

    return Inputs(**{name: read(name) for name in RAW_COLUMNS})


def read_parquet_folder(spark: SparkSession, folder: str) -> Inputs:
    return Inputs(
        **{
            name: spark.read.parquet(f"{folder}/{name}.parquet").select(columns)
            for name, columns in RAW_COLUMNS.items()
        }
    )


def read_namespace(spark: SparkSession, namespace: str = "raw") -> Inputs:
    """Raw tables that the session catalog already knows."""
    return Inputs(
        **{
            name: spark.table(f"{namespace}.{name}").select(columns)
            for name, columns in RAW_COLUMNS.items()
        }
    )


def read_golden_folder(spark: SparkSession, folder: str) -> Golden:
    """Expected results, typed: `orders.csv` with order_id, the expected twelve flags, count and
    status, and `metrics.csv` with metric and expected_value."""
    flags = ", ".join(f"expected_{code} boolean" for code in FLAGS)
    orders = (
        f"order_id string, {flags}, expected_error_count bigint, "
        "expected_reconciliation_status string"
    )

    def read(name: str, schema: str) -> DataFrame:
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        return reader.option("mode", "FAILFAST").csv(f"{folder}/{name}.csv")

    return Golden(read("orders", orders), read("metrics", "metric string, expected_value bigint"))
