"""Entry points of the driver: a flagship query, all registered queries and their SQL oracles."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import partial
from importlib import import_module
from importlib.util import find_spec
from pathlib import Path
from uuid import uuid4

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from recon_oracle import oracles  # noqa: E402
from tallyline.operators.checks import (  # noqa: E402
    duplicate_keys,
    orphan_keys,
    unexpected_values,
)
from tallyline.operators.errors import error_rows, unpivot_flags  # noqa: E402
from tallyline.operators.golden import (  # noqa: E402
    metric_differences,
    metric_distribution,
    order_differences,
)
from tallyline.operators.joins import (  # noqa: E402
    JoinStats,
    measure_joins,
    successful_payments,
)
from tallyline.operators.rules import FLAGS, RULES, Rule  # noqa: E402
from tallyline.operators.staging import STAGES, stage  # noqa: E402
from tallyline.plans.build import build_marts, load_raw  # noqa: E402
from tallyline.plans.quality import (  # noqa: E402
    ACCEPTED_VALUES,
    ORDER_MART,
    quality_report,
    table_set,
)
from tallyline.plans.reconcile import (  # noqa: E402
    apply_rule,
    join_orders_to_merchants,
    join_orders_to_payments,
    join_payments_to_settlements,
    joined_orders,
    reconcile,
)
from tallyline.plans.reports import error_counts, error_details, error_type_summary  # noqa: E402
from tallyline.schemas import RAW_COLUMNS, Inputs  # noqa: E402
from tallyline.sources.derived import (  # noqa: E402
    derived_inputs,
    expected_verdicts,
    messy_inputs,
)
from tallyline.sources.raw import (  # noqa: E402
    bad_lines,
    good_lines,
    read_csv,
    read_csv_lines,
    read_golden_folder,
    read_namespace,
    read_parquet_folder,
)
from tallyline.sources.records import read_records  # noqa: E402
from tallyline.sources.warehouse import (  # noqa: E402
    CatalogWarehouse,
    FolderWarehouse,
    materialize,
    scratch_path,
)

Query = Callable[[SparkSession, str], DataFrame]
Source = Callable[[SparkSession, str], Inputs]

FLAGSHIP_DIR = "/root/testdata/sf0.001"

_known_stats: dict[tuple, JoinStats] = {}


def _stats(spark: SparkSession, sf_dir: str, source: Source) -> JoinStats:
    """Join statistics of one input set, gathered once per application like table statistics."""
    key = (spark.sparkContext.applicationId, sf_dir, source.__name__)
    if key not in _known_stats:
        _known_stats[key] = measure_joins(stage(source(spark, sf_dir)))
    return _known_stats[key]


def _zoneless(table: DataFrame) -> DataFrame:
    """Timestamps that were read from text, as the wall-clock time of that text."""
    zoned = [f.name for f in table.schema if isinstance(f.dataType, T.TimestampType)]
    return table.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _staged(name: str, spark: SparkSession, sf_dir: str, source: Source = derived_inputs):
    return STAGES[name](getattr(source(spark, sf_dir), name))


def _from_staged(use: Callable[..., DataFrame], source: Source = derived_inputs) -> Query:
    """A query over the staged inputs and their join statistics."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staged = stage(source(spark, sf_dir))
        return _zoneless(use(staged, _stats(spark, sf_dir, source)))

    return query


def _from_mart(use: Callable[[DataFrame], DataFrame], source: Source = derived_inputs) -> Query:
    """A query that reads the order mart once, so the mart stays part of its plan."""
    return _from_staged(lambda staged, stats: use(reconcile(staged, stats)), source)


def _from_stored_mart(
    use: Callable[[Inputs, DataFrame], DataFrame], source: Source = derived_inputs
) -> Query:
    """A query that reads the order mart several times, so it is stored first."""
    return _from_staged(
        lambda staged, stats: use(staged, materialize(reconcile(staged, stats), "order_mart")),
        source,
    )


def _details(staged: Inputs, mart: DataFrame) -> DataFrame:
    return error_details(error_rows(mart), mart)


def _metrics(staged: Inputs, mart: DataFrame) -> DataFrame:
    return metric_distribution(mart, error_rows(mart))


def _report(*kinds: str) -> Callable[[Inputs, DataFrame], DataFrame]:
    return lambda staged, mart: quality_report(table_set(staged, mart, error_rows(mart)), kinds)


def _whole_report(source: Source, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check over a stored warehouse, as the job runs them."""
    warehouse = FolderWarehouse(spark, scratch_path(spark, "warehouse"))
    marts = build_marts(warehouse, source(spark, sf_dir))
    return quality_report(marts.tables(), watched=marts.watched)


def _golden_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    use = _from_stored_mart(
        lambda staged, mart: order_differences(expected_verdicts(spark, sf_dir), mart)
    )
    return use(spark, sf_dir)


def _golden_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = expected_verdicts(spark, sf_dir)
    status = F.col("expected_reconciliation_status")
    counted = verdicts.agg(
        F.count("*").alias("total_orders"),
        F.count_if(status == "MATCHED").alias("matched_orders"),
        F.count_if(status == "ERROR").alias("error_orders"),
        *[F.count_if(F.col(f"expected_{code}")).alias(code) for code in FLAGS],
        F.sum("expected_error_count").alias("error_detail_rows"),
    )
    expected = counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), F.col(name).alias("expected_value"))
                    for name in counted.columns
                ]
            )
        )
    )
    use = _from_stored_mart(
        lambda staged, mart: metric_differences(expected, _metrics(staged, mart))
    )
    return use(spark, sf_dir)


def _reload_csv(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one raw table as CSV, load it back as text and stage it."""
    table = getattr(derived_inputs(spark, sf_dir), name)
    location = scratch_path(spark, f"{name}.csv")
    text = table.select([F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[name]])
    text.write.csv(
        location, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return _zoneless(STAGES[name](read_csv(spark, location, name)))


def _rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the whole warehouse twice over the same folder and report from what is stored."""
    warehouse = FolderWarehouse(spark, scratch_path(spark, "warehouse"))
    raw = derived_inputs(spark, sf_dir)
    build_marts(warehouse, raw)
    marts = build_marts(warehouse, raw)
    return error_type_summary(marts.errors)


def _catalog_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the order mart as a catalog table, publish it, and read it by its absolute name."""
    prefix = f"trip_{uuid4().hex}_"
    warehouse = CatalogWarehouse(spark, prefix, scratch_path(spark, "catalog"))
    staged = stage(derived_inputs(spark, sf_dir))
    warehouse.write("marts", ORDER_MART, reconcile(staged, _stats(spark, sf_dir, derived_inputs)))
    warehouse.publish()
    return _zoneless(spark.table(f"spark_catalog.{prefix}marts.{ORDER_MART}"))


def _reload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write merchants whose names have line breaks, quotes and commas, and read them by records."""
    location = scratch_path(spark, "records.csv")
    merchants = derived_inputs(spark, sf_dir).merchants
    broken = F.concat("merchant_name", F.lit('\n"'), "merchant_id", F.lit('",\n\n'))
    written = merchants.select("merchant_id", broken.alias("merchant_name"), F.lit("0.1").alias("fee_rate"))
    plain = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    written.write.csv(location, header=True, **plain)
    return read_records(spark, location, "merchants")


def _reload_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw tables as a folder of parquet and stage its payments."""
    folder = scratch_path(spark, "raw")
    for name, table in derived_inputs(spark, sf_dir).items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return _zoneless(stage(read_parquet_folder(spark, folder)).payments)


def _reload_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep the raw tables in the catalog, publish them and stage the orders by their names."""
    prefix = f"raw_{uuid4().hex}_"
    warehouse = CatalogWarehouse(spark, prefix, scratch_path(spark, "catalog"))
    load_raw(warehouse, derived_inputs(spark, sf_dir))
    warehouse.publish()
    return _zoneless(stage(read_namespace(spark, f"{prefix}raw")).orders)


def _reload_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write expected results as CSV and read them typed."""
    folder = scratch_path(spark, "golden")
    expected_verdicts(spark, sf_dir).write.csv(f"{folder}/orders.csv", header=True)
    metrics = spark.createDataFrame([("total_orders", 1)], "metric string, expected_value bigint")
    metrics.write.csv(f"{folder}/metrics.csv", header=True)
    return read_golden_folder(spark, folder).orders


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish settlements, hold that version, and read it after two later publications."""
    root = scratch_path(spark, "held")
    held = None
    for rows in ("true", "false", "gross_amount > 0"):
        warehouse = FolderWarehouse(spark, root, keep=0.0)
        settlements = stage(derived_inputs(spark, sf_dir)).settlements
        warehouse.write("staging", "stg_settlements", settlements.where(rows))
        warehouse.publish()
        held = held or warehouse.snapshot()
    return _zoneless(held.read("staging", "stg_settlements"))


def _damaged_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a file of merchants, of which some are too short, too long or broken in two."""
    location = scratch_path(spark, "damaged.csv")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    line = (
        "case when c_custkey % 7 = 1 then 'M' || c_custkey || ',' || c_name "
        "when c_custkey % 7 = 2 then 'M' || c_custkey || ',' || c_name || ',1,000' "
        "when c_custkey % 7 = 3 then 'M' || c_custkey || ',half' || char(10) || 'B' || c_custkey || ',0.1' "
        "else 'M' || c_custkey || ',\"' || c_name || ', \"\"x\"\"\",0.03' end as value"
    )
    customers.selectExpr(line).write.option("header", False).text(location)
    return materialize(read_csv_lines(spark, location, "merchants", header=False), "lines")


def _rule(rule: Rule) -> Query:
    return _from_staged(lambda staged, stats: apply_rule(staged, rule, stats))


def _corpus(kind: str) -> dict:
    """Queries or SQL of the corpus operators and their pipeline, which may be absent."""
    found = {}
    if find_spec("tallyline.llm"):
        found |= getattr(import_module("tallyline.llm.queries"), f"llm_{kind}")()
    if find_spec("tallyline.llm") and find_spec("corpus_pipeline"):
        pipeline = import_module("corpus_pipeline")
        found |= {"queries": {"pipeline": pipeline.run}, "oracles": {}}[kind]
    return found


def entry(spark: SparkSession) -> DataFrame:
    """The order mart over the smallest test data."""
    return queries()["fct_payment_reconciliation"](spark, FLAGSHIP_DIR)


def queries() -> dict[str, Query]:
    messy = messy_inputs
    statuses = ACCEPTED_VALUES["stg_payments"]["payment_status"]
    return {
        **{f"stg_{name}": partial(_staged, name) for name in STAGES},
        **{f"reload_csv_{name}": partial(_reload_csv, name) for name in STAGES},
        "clean_text_status": _from_staged(
            lambda staged, stats: staged.payments.select(
                "payment_id", "order_id", "payment_status", "settlement_batch_id"
            ),
            messy,
        ),
        "safe_casts": _from_staged(
            lambda staged, stats: staged.orders.select("order_id", "order_amount", "ordered_at"),
            messy,
        ),
        "safe_rates": _from_staged(lambda staged, stats: staged.merchants, messy),
        "successful_payments": _from_staged(
            lambda staged, stats: successful_payments(staged.payments)
        ),
        "join_order_payment": _from_staged(
            lambda staged, stats: join_orders_to_payments(staged.orders, staged.payments, stats)
        ),
        "join_order_merchant": _from_staged(
            lambda staged, stats: join_orders_to_merchants(staged.orders, staged.merchants, stats)
        ),
        "join_payment_settlement": _from_staged(
            lambda staged, stats: join_payments_to_settlements(
                staged.payments, staged.settlements, stats
            )
        ),
        "joined_orders": _from_staged(joined_orders),
        "expected_amounts": _from_staged(
            lambda staged, stats: joined_orders(staged, stats).select(
                "order_id",
                "payment_amount",
                "fee_rate",
                "expected_fee_amount",
                "expected_net_amount",
            )
        ),
        **{f"rule_{rule.code}": _rule(rule) for rule in RULES},
        "error_count_status": _from_mart(
            lambda mart: mart.select("order_id", "error_count", "reconciliation_status")
        ),
        "fct_payment_reconciliation": _from_mart(lambda mart: mart),
        "unpivot_flags": _from_mart(lambda mart: unpivot_flags(mart, ["order_id"])),
        "fct_reconciliation_errors": _from_mart(error_rows),
        "error_counts": _from_mart(lambda mart: error_counts(error_rows(mart))),
        "error_type_summary": _from_mart(lambda mart: error_type_summary(error_rows(mart))),
        "reconciliation_error_details": _from_stored_mart(_details),
        "metric_distribution": _from_stored_mart(_metrics),
        "golden_order_diff": _golden_orders,
        "golden_metric_diff": _golden_metrics,
        "check_not_null": _from_stored_mart(_report("not_null")),
        "check_unique": _from_stored_mart(_report("unique")),
        "check_accepted_values": _from_stored_mart(_report("accepted_values")),
        "check_relationships": _from_stored_mart(_report("relationships")),
        "check_error_count": _from_mart(
            lambda mart: quality_report({ORDER_MART: mart}, ("error_count",))
        ),
        "check_status": _from_mart(
            lambda mart: quality_report({ORDER_MART: mart}, ("status",))
        ),
        "quality_report": partial(_whole_report, derived_inputs),
        "rebuild_warehouse": _rebuild,
        "catalog_round_trip": _catalog_round_trip,
        "reload_records_merchants": _reload_records,
        "reload_parquet_payments": _reload_parquet,
        "reload_namespace_orders": _reload_namespace,
        "reload_golden_orders": _reload_golden,
        "snapshot_settlements": _snapshot,
        "csv_good_lines": lambda spark, sf_dir: good_lines(_damaged_csv(spark, sf_dir)),
        "csv_bad_lines": lambda spark, sf_dir: bad_lines(_damaged_csv(spark, sf_dir)),
        "messy_fct_payment_reconciliation": _from_mart(lambda mart: mart, messy),
        "messy_fct_reconciliation_errors": _from_mart(error_rows, messy),
        "messy_error_type_summary": _from_mart(
            lambda mart: error_type_summary(error_rows(mart)), messy
        ),
        "messy_metric_distribution": _from_stored_mart(_metrics, messy),
        "messy_quality_report": partial(_whole_report, messy),
        "messy_duplicate_orders": _from_stored_mart(
            lambda staged, mart: duplicate_keys(mart, "order_id"), messy
        ),
        "messy_unexpected_statuses": _from_staged(
            lambda staged, stats: unexpected_values(staged.payments, "payment_status", statuses),
            messy,
        ),
        "messy_orphan_payments": _from_staged(
            lambda staged, stats: orphan_keys(
                staged.payments, "order_id", staged.orders, "order_id"
            ),
            messy,
        ),
        **_corpus("queries"),
    }


def oracle_sql() -> dict[str, str]:
    return {**oracles(), **_corpus("oracles")}
