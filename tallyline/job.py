"""Command line job: load the four raw tables, rebuild every layer and report, check, and publish.

    spark-submit --py-files tallyline.zip tallyline/job.py --raw /data/raw --out /data/mart
    python -m tallyline.job --master 'local[8]' --raw data/raw --format csv --out data/mart

All layers and both reports are published together, whatever the checks say. Exit code 1 means that a
check failed. Anomalies of single orders are results, not failures.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyline.plans.build import build_marts, check_marts, load_raw, write_reports
from tallyline.plans.quality import ORDER_MART
from tallyline.session import open_session, size_tasks
from tallyline.sources.raw import (
    read_csv_folder,
    read_golden_folder,
    read_namespace,
    read_parquet_folder,
)
from tallyline.sources.warehouse import CatalogWarehouse, FolderWarehouse

READERS = {"csv": read_csv_folder, "parquet": read_parquet_folder, "table": read_namespace}


def parse(arguments: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Reconcile orders, payments and settlements")
    parser.add_argument("--raw", required=True, help="folder of raw files, or namespace of tables")
    parser.add_argument("--format", choices=sorted(READERS), default="csv")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="folder to write the layers to, as parquet")
    target.add_argument("--catalog", action="store_true", help="write catalog tables instead")
    parser.add_argument("--prefix", default="", help="prefix of the catalog namespaces")
    parser.add_argument("--keep-raw", action="store_true", help="also store the raw tables")
    parser.add_argument(
        "--resume", action="store_true", help="go on with the run that broke off last, if any"
    )
    parser.add_argument(
        "--keep-hours", type=float, default=24, help="how long a replaced version stays readable"
    )
    parser.add_argument("--golden", help="folder with expected orders.csv and metrics.csv")
    parser.add_argument("--master", help="Spark master, if spark-submit does not set it")
    parser.add_argument(
        "--input-gib", type=int, help="size of the input to size tasks by, if not the measured one"
    )
    parser.add_argument(
        "--multi-line", action="store_true", help="quoted line breaks in CSV are data"
    )
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: argparse.Namespace) -> bool:
    """True if every check passed."""
    kind, place = (CatalogWarehouse, options.prefix) if options.catalog else (FolderWarehouse, options.out)
    keep = options.keep_hours * 3600
    warehouse = kind.resumed(spark, place, keep=keep) if options.resume else kind(spark, place, keep=keep)
    joined = {"multi_line": True} if options.multi_line and options.format == "csv" else {}
    read = lambda: READERS[options.format](spark, options.raw, **joined)
    given = options.input_gib << 30 if options.input_gib else None
    size_tasks([table for _, table in read().items()], given)
    raw = read()  # planned anew, with the split size that fits
    if options.keep_raw:
        raw = load_raw(warehouse, raw)
    marts = build_marts(warehouse, raw)
    golden = read_golden_folder(spark, options.golden) if options.golden else None
    report = check_marts(warehouse, marts, golden)
    failures = report.where(F.col("failing_rows") > 0).collect()  # one row per check at most
    for row in failures:
        print(
            f"failed: {row['check_name']} on {row['table_name']}.{row['column_name']}: "
            f"{row['failing_rows']}",
            file=sys.stderr,
        )
    doubtful = {
        row["check_name"]
        for row in failures
        if (row["table_name"], row["column_name"]) == (ORDER_MART, "order_id")
    }
    write_reports(warehouse, marts, unique=not doubtful & {"unique", "not_null"})
    warehouse.publish()
    return not failures


def main(arguments: Sequence[str] | None = None) -> int:
    options = parse(sys.argv[1:] if arguments is None else arguments)
    spark = open_session("reconciliation", options.master)
    return 0 if run(spark, options) else 1


if __name__ == "__main__":
    raise SystemExit(main())
