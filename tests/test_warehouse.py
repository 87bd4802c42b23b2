"""Sources, sinks and the job, from CSV files to stored reports."""

from __future__ import annotations

import csv
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from compare import spark_rows
from sample import EXPECTED_ERRORS, EXPECTED_METRICS, make_inputs, sample_rows

from tallyline import job
from tallyline.operators.rules import FLAGS
from tallyline.operators.errors import error_rows
from tallyline.operators.staging import stage
from tallyline.plans import build
from tallyline.plans.build import build_marts, check_marts, load_raw
from tallyline.plans.quality import ERROR_MART, ORDER_MART
from tallyline.plans.reconcile import reconcile
from tallyline.plans.reports import error_details, error_type_summary
from tallyline.schemas import RAW_COLUMNS
from tallyline.session import finer_tasks, planned_bytes, settings_for, size_tasks
from tallyline.sources import raw as sources
from tallyline.sources import warehouse as stores
from tallyline.sources.warehouse import (
    CatalogWarehouse,
    FolderWarehouse,
    clear_scratch,
    materialize,
    register_views,
    remove_folder,
    scratch_path,
    shared_folder,
)


def write_csv(folder: Path, tables: dict[str, list[tuple]]) -> str:
    for name, rows in tables.items():
        with open(folder / f"{name}.csv", "w", encoding="utf-8", newline="") as file:
            writer = csv.writer(file, lineterminator="\n")
            writer.writerow(RAW_COLUMNS[name])
            writer.writerows([["" if v is None else v for v in row] for row in rows])
    return str(folder)


def test_csv_is_read_unmodified(spark, tmp_path):
    rows = [("M1", ' a "b", c ', "x"), ("M2", "みどり商店", ""), (" ", "", "0.1")]
    folder = write_csv(tmp_path, {"merchants": rows})
    table = sources.read_csv(spark, f"{folder}/merchants.csv", "merchants")
    assert [field.dataType.simpleString() for field in table.schema] == ["string"] * 3
    assert sorted(tuple(row) for row in table.collect()) == [
        (" ", None, "0.1"), ("M1", ' a "b", c ', "x"), ("M2", "みどり商店", None),
    ]


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "merchants.csv").write_text("merchant_name,merchant_id,fee_rate\na,b,1\n")
    with pytest.raises(Exception, match="header"):
        sources.read_csv(spark, str(tmp_path / "merchants.csv"), "merchants").collect()


def test_every_source_gives_the_same_mart(spark, tmp_path):
    raw = make_inputs(spark, sample_rows())
    expected = spark_rows(reconcile(stage(raw)))
    folder = write_csv(tmp_path, sample_rows())
    assert spark_rows(reconcile(stage(sources.read_csv_folder(spark, folder)))) == expected
    for name, table in raw.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    assert spark_rows(reconcile(stage(sources.read_parquet_folder(spark, folder)))) == expected
    catalog = CatalogWarehouse(spark, "a_")
    load_raw(catalog, raw)
    catalog.publish()
    assert spark_rows(reconcile(stage(sources.read_namespace(spark, "a_raw")))) == expected


def test_rebuild_replaces_everything_with_the_same(spark, tmp_path):
    warehouse = FolderWarehouse(spark, str(tmp_path))
    raw = make_inputs(spark, sample_rows())
    first = build_marts(warehouse, raw)
    kept = spark_rows(first.orders), spark_rows(first.errors)
    second = build_marts(warehouse, raw)
    assert (spark_rows(second.orders), spark_rows(second.errors)) == kept
    assert second.orders.count() == EXPECTED_METRICS["total_orders"]
    assert second.errors.count() == EXPECTED_METRICS["error_detail_rows"]
    assert check_marts(warehouse, second).where("failing_rows > 0").isEmpty()


def test_staging_can_be_used_as_views(spark):
    register_views(stage(make_inputs(spark, sample_rows())).tables())
    found = spark.sql(
        "SELECT count(*) FROM stg_orders LEFT ANTI JOIN stg_payments USING (order_id)"
    ).first()
    assert found[0] == 3


def test_materialized_tables_keep_rows_and_schema(spark):
    table = spark.range(10).selectExpr("id", "cast(id as decimal(18,9)) as rate")
    stored = materialize(table, "numbers")
    assert stored.dtypes == table.dtypes  # files read back as nullable
    assert spark_rows(stored) == spark_rows(table)
    assert all(path.startswith(f"file://{shared_folder(spark)}") for path in stored.inputFiles())


def test_job_from_csv_to_reports(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_csv(folder, sample_rows())
    out = str(tmp_path / "out")
    assert job.run(spark, job.parse(["--raw", str(folder), "--out", out, "--keep-raw"]))
    stored = FolderWarehouse(spark, out)
    assert stored.read("reports", "error_type_summary").count() == 12
    assert stored.read("reports", "error_details").count() == 34
    assert stored.read("raw", "orders").count() == 200
    assert stored.read("checks", "quality_report").count() == 39


def test_job_with_a_failed_check_publishes_reports_that_fit_the_marts(spark, tmp_path, capsys):
    folder = tmp_path / "raw"
    folder.mkdir()
    tables = sample_rows()
    tables["orders"].append(tables["orders"][0])
    write_csv(folder, tables)
    out = str(tmp_path / "out")
    assert not job.run(spark, job.parse(["--raw", str(folder), "--out", out]))
    assert "unique on stg_orders.order_id: 1" in capsys.readouterr().err
    stored = FolderWarehouse(spark, out)
    marts = [stored.read("marts", name) for name in (ORDER_MART, ERROR_MART)]
    assert spark_rows(stored.read("reports", "error_details")) == spark_rows(error_details(marts[1], marts[0]))
    assert spark_rows(stored.read("reports", "error_type_summary")) == spark_rows(error_type_summary(marts[1]))


def test_details_are_the_same_with_and_without_the_join(spark):
    mart = reconcile(stage(make_inputs(spark, sample_rows()))).cache()
    joined, own = (error_details(error_rows(mart), mart, unique) for unique in (False, True))
    assert spark_rows(joined) == spark_rows(own)


def test_a_run_that_breaks_off_leaves_everything_as_it_was(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    out = str(tmp_path / "out")
    options = job.parse(["--raw", write_csv(raw, sample_rows()), "--out", out])
    job.run(spark, options)
    names = [("marts", ORDER_MART), ("marts", ERROR_MART), ("reports", "error_details")]
    before = [spark_rows(FolderWarehouse(spark, out).read(*name)) for name in names]
    tables = sample_rows()
    tables["payments"] = tables["payments"][:5]
    write_csv(raw, tables)
    with monkeypatch.context() as patch:
        patch.setattr(build, "error_rows", lambda mart: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run(spark, options)
    assert [spark_rows(FolderWarehouse(spark, out).read(*name)) for name in names] == before
    job.run(spark, options)
    assert [spark_rows(FolderWarehouse(spark, out).read(*name)) for name in names] != before


def folder(spark, tmp_path, keep=0.0):
    return FolderWarehouse(spark, str(tmp_path), keep=keep)


def catalog(spark, tmp_path, keep=0.0):
    return CatalogWarehouse(spark, f"w{abs(hash(str(tmp_path)))}_", keep=keep)


def located(spark, tmp_path, keep=0.0):
    return CatalogWarehouse(spark, f"l{abs(hash(str(tmp_path)))}_", str(tmp_path), keep=keep)


def stored_versions(warehouse, tmp_path):
    if isinstance(warehouse, FolderWarehouse):
        return {p.name for p in (tmp_path / "versions").iterdir()}
    rows = warehouse.spark.sql(f"SHOW PARTITIONS {warehouse.prefix}layer.t_versions").collect()
    return {row[0].removeprefix("version=") for row in rows}


@pytest.mark.parametrize("kind", [folder, catalog, located])
def test_old_versions_go(spark, tmp_path, kind):
    for n in range(4):
        warehouse = kind(spark, tmp_path)
        warehouse.write("layer", "t", spark.range(n))
        warehouse.publish()
        assert warehouse.read("layer", "t").count() == n
    assert len(stored_versions(warehouse, tmp_path)) == 2
    if kind is located:
        assert len(list(tmp_path.glob("*layer/t_versions/version=*"))) == 2
    with pytest.raises(LookupError):
        FolderWarehouse(spark, str(tmp_path / "none")).read("layer", "t")


@pytest.mark.parametrize("kind", [folder, catalog])
def test_replaced_versions_stay_for_their_time(spark, tmp_path, kind):
    for n in range(4):
        warehouse = kind(spark, tmp_path, 3600.0)
        warehouse.write("layer", "t", spark.range(n))
        warehouse.publish()
    assert len(stored_versions(warehouse, tmp_path)) == 4


@pytest.mark.parametrize("kind", [folder, catalog, located])
def test_a_snapshot_reads_through_publications(spark, tmp_path, kind):
    for n in (3, 4, 5, 6, 7):
        warehouse = kind(spark, tmp_path)
        warehouse.write("layer", "t", spark.range(n))
        warehouse.write("other", "u", spark.range(n))
        warehouse.publish()
        if n == 3:
            held = warehouse.snapshot()
            reader = held.read("layer", "t")
    assert [held.read(*name).count() for name in (("layer", "t"), ("other", "u"))] == [3, 3]
    assert reader.count() == 3
    assert len(stored_versions(warehouse, tmp_path)) == 3
    held.release()
    last = kind(spark, tmp_path)
    last.write("layer", "t", spark.range(8))
    last.publish()
    assert held.version not in stored_versions(last, tmp_path)
    over = last.snapshot(hold=-1.0)  # its time is over at once
    assert over.version not in last.held()
    with pytest.raises(LookupError):
        kind(spark, tmp_path / "none").snapshot()


@pytest.mark.parametrize("fails_at", ["second view", "pointer"])
def test_a_crash_while_publishing_leaves_one_version(spark, tmp_path, monkeypatch, fails_at):
    """New columns make all views change; the run dies between two of them, or before the switch."""
    first = catalog(spark, tmp_path)
    for layer in ("a", "b", "c"):
        first.write(layer, "t", spark.range(2).selectExpr("id", "1 as n"))
    first.publish()
    second = catalog(spark, tmp_path)
    for layer in ("a", "b", "c"):
        second.write(layer, "t", spark.range(5).selectExpr("id", "2 as n", "'x' as more"))
    real, calls = CatalogWarehouse.show, []

    def show(self, *told):
        calls.append(told)
        if fails_at == "second view" and len(calls) == 2:
            raise RuntimeError("killed")
        real(self, *told)

    def log(self, name, *values):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(CatalogWarehouse, "show", show)
        if fails_at == "pointer":
            patch.setattr(CatalogWarehouse, "_log", log)
        with pytest.raises(RuntimeError):
            second.publish()
    assert [sorted(tuple(r[:2]) for r in second.read(layer, "t").collect()) for layer in ("a", "b", "c")] == [[(0, 1), (1, 1)]] * 3
    second.publish()
    assert [second.read(layer, "t").where("n = 2 AND more = 'x'").count() for layer in ("a", "b", "c")] == [5] * 3


def test_a_view_reads_the_files_of_one_version(spark, tmp_path):
    warehouse = catalog(spark, tmp_path)
    warehouse.write("layer", "t", spark.range(2))
    warehouse.publish()
    plan = warehouse.read("layer", "t")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan and "Subquery" in plan
    with pytest.raises(Exception, match="(?i)cast|type"):
        catalog(spark, tmp_path).write("layer", "t", spark.createDataFrame([("x",)], "id string")).collect()


@pytest.mark.parametrize("kind", [folder, catalog])
def test_a_killed_run_leaves_nothing_after_the_next_one(spark, tmp_path, kind):
    for n in (1, 2):
        warehouse = kind(spark, tmp_path)
        warehouse.write("layer", "t", spark.range(n))
        warehouse.publish()
    killed = kind(spark, tmp_path)
    killed.write("layer", "t", spark.range(9))
    assert killed.version in stored_versions(killed, tmp_path)
    warehouse = kind(spark, tmp_path)
    assert warehouse.unfinished() == killed.version
    warehouse.write("layer", "t", spark.range(3))
    warehouse.publish()
    assert warehouse.read("layer", "t").count() == 3 and warehouse.unfinished() is None
    assert killed.version not in stored_versions(warehouse, tmp_path) and killed.version not in warehouse.runs()


@pytest.mark.parametrize("to", ["folder", "catalog"])
def test_a_run_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch, to):
    (tmp_path / "raw").mkdir()
    target = ["--out", str(tmp_path / "out")] if to == "folder" else ["--catalog", "--prefix", "r_"]
    options = ["--raw", write_csv(tmp_path / "raw", sample_rows()), *target]
    with monkeypatch.context() as patch:
        patch.setattr(build, "error_rows", lambda mart: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run(spark, job.parse(options))
    kind = FolderWarehouse if to == "folder" else CatalogWarehouse
    place = str(tmp_path / "out") if to == "folder" else "r_"
    broken = kind(spark, place).unfinished()
    written, real = [], kind.write
    with monkeypatch.context() as patch:
        patch.setattr(kind, "write", lambda self, layer, name, table: written.append(layer) or real(self, layer, name, table))
        assert job.run(spark, job.parse([*options, "--resume"]))
    assert "staging" not in written and {"marts", "checks", "reports"} <= set(written)
    warehouse = kind(spark, place)
    assert warehouse.published() == broken and warehouse.unfinished() is None
    assert warehouse.read("reports", "error_details").count() == 34


def test_a_store_that_only_spark_knows(spark, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.shop.link./w", f"file://{tmp_path}")
    for n in range(4):
        warehouse = FolderWarehouse(spark, "viewfs://shop/w/out", keep=0.0)
        warehouse.write("layer", "t", spark.range(n))
        warehouse.publish()
    assert warehouse.read("layer", "t").count() == 3
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2


def test_a_removal_that_fails_is_told(spark):
    with pytest.warns(UserWarning, match="could not remove"):
        assert not remove_folder("nosuchstore://x/y", spark)


def test_tasks_follow_the_measured_size(spark, tmp_path):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")
    before = {key: spark.conf.get(key) for key in keys}
    spark.range(200_000).selectExpr("id", "uuid() as u").write.parquet(f"{tmp_path}/t")
    spark.read.parquet(f"{tmp_path}/t").write.mode("overwrite").saveAsTable("sized")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    try:
        for table in (spark.read.parquet(f"{tmp_path}/t"), spark.table("sized")):
            assert abs(planned_bytes(table) - size) < 0.05 * size
            assert size_tasks([table]) == settings_for(planned_bytes(table))
            assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
        size_tasks([table], 1 << 40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_scratch_tables_leave_no_folder(spark):
    first, second = (Path(scratch_path(spark, "t")).parent for _ in range(2))
    materialize(spark.range(3), "numbers")
    spark.range(3).write.parquet(f"{first}/t")
    clear_scratch()
    assert not first.exists() and not second.exists()
    assert not [p for p in Path(shared_folder(spark)).iterdir() if p.name.startswith("tallyline-")]


def test_bad_lines_fail_or_are_told(spark, tmp_path):
    path = tmp_path / "merchants.csv"
    good, bad = ['M1,"a ""b"", c",0.1', "M2,b,"], ["M3,short", "M4,long,1,000"]
    path.write_text("\n".join(["merchant_id,merchant_name,fee_rate", *good, *bad]) + "\n")
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_csv(spark, str(path), "merchants").select("merchant_id").collect()
    lines = sources.read_csv_lines(spark, str(path), "merchants").cache()
    assert [tuple(r) for r in sources.good_lines(lines).collect()] == [("M1", 'a "b", c', "0.1"), ("M2", "b", None)]
    assert [r[0] for r in sources.bad_lines(lines).collect()] == bad
    path.write_text('merchant_id,merchant_name,fee_rate\nM1,"two\nlines",0.1\n')
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_csv(spark, str(path), "merchants").collect()
    assert sources.read_csv(spark, str(path), "merchants", multi_line=True).first()[1] == "two\nlines"


def write_golden(folder: Path, total: int) -> str:
    folder.mkdir()
    rows = [["order_id", *[f"expected_{c}" for c in FLAGS], "expected_error_count",
             "expected_reconciliation_status"]]
    for order in [f"O00{n}" for n in range(1, 9)]:
        raised = EXPECTED_ERRORS.get(order, set())
        flags = ["true" if code in raised else "false" for code in FLAGS]
        rows.append([order, *flags, len(raised), "ERROR" if raised else "MATCHED"])
    metrics = [["metric", "expected_value"], *{**EXPECTED_METRICS, "total_orders": total}.items()]
    for name, lines in (("orders", rows), ("metrics", metrics)):
        with open(folder / f"{name}.csv", "w", newline="") as file:
            csv.writer(file, lineterminator="\n").writerows(lines)
    return str(folder)


def test_job_compares_with_expected_results(spark, tmp_path, capsys):
    (tmp_path / "raw").mkdir()
    folder = write_csv(tmp_path / "raw", sample_rows())
    out = str(tmp_path / "out")
    for total, passed in ((200, True), (201, False)):
        golden = write_golden(tmp_path / f"golden{total}", total)
        options = job.parse(["--raw", folder, "--out", out, "--golden", golden])
        assert job.run(spark, options) is passed
        assert FolderWarehouse(spark, out).read("checks", "quality_report").count() == 41
    assert "golden_metrics on fct_payment_reconciliation.metric: 1" in capsys.readouterr().err


def test_job_into_the_catalog(spark, tmp_path):
    folder = write_csv(tmp_path, sample_rows())
    options = job.parse(["--raw", folder, "--catalog", "--prefix", "b_"])
    assert job.run(spark, options)
    assert spark.table("b_marts.fct_payment_reconciliation").count() == 200
    assert spark.table("b_staging.stg_payments").count() == len(sample_rows()["payments"])
    assert spark.table("b_reports.error_type_summary").count() == 12


@pytest.mark.parametrize(
    ("size", "task", "partitions"),
    [(1 << 20, 1 << 27, 16), (64 << 30, 1 << 27, 512), (1 << 40, 1 << 27, 8192), (100 << 40, 1 << 30, 102_400)],
)
def test_tasks_follow_the_input(size, task, partitions):
    assert settings_for(size) == {
        "spark.sql.files.maxPartitionBytes": str(task),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def test_stored_tables_are_cheap_to_write(spark, tmp_path, monkeypatch):
    """No 12-byte moments, no dictionaries of ids, and files that are dealt evenly to tasks."""
    monkeypatch.setitem(stores.PARQUET, "maxRecordsPerFile", "40")
    rows = spark.range(0, 100, 1, 1).selectExpr("'O' || id as order_id", "timestamp_micros(id) as paid_at")
    folder = FolderWarehouse(spark, str(tmp_path))
    catalog = CatalogWarehouse(spark, "cheap_", str(tmp_path / "catalog"))
    catalog_rows = catalog.write("staging", "rows", rows)
    for stored in (folder.write("staging", "rows", rows), materialize(rows, "rows"), catalog_rows):
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
        files = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata for f in stored.inputFiles()]
        assert sorted(f.num_rows for f in files) == [20, 40, 40]
        for column in (f.row_group(0).column(k) for f in files for k in range(2)):
            assert column.compression == "ZSTD"
            assert not column.has_dictionary_page
            assert column.physical_type in ("BYTE_ARRAY", "INT64")


def test_finer_tasks_for_a_while(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(key) for key in keys]
    with pytest.raises(ZeroDivisionError), finer_tasks(spark):
        assert [spark.conf.get(key) for key in keys] == [str(32 << 20), str(16 << 20)]
        raise ZeroDivisionError
    assert [spark.conf.get(key) for key in keys] == before
