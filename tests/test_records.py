"""Records with quoted line breaks, against Spark's reader with a task a file."""

from __future__ import annotations

import csv
import random

import pytest
from compare import spark_rows

from tallyline.sources.raw import read_csv, read_csv_folder
from tallyline.sources.records import read_records, records

HEADER = ["merchant_id", "merchant_name", "fee_rate"]


def merchants(seed: int, n: int) -> list[list]:
    rng = random.Random(seed)
    parts = ["a", "b c", "\n", "\r\n", '"', ",", "\n\n", "é", " ", "x\ny", '"\n"', "日本"]
    return [[f"M{k}", "".join(rng.choices(parts, k=rng.choice([0, 1, 5, 40]))), rng.choice(["0.1", "", " 2 "])] for k in range(n)]


def written(path, rows, end="\n", header=HEADER) -> str:
    with open(path, "w", encoding="utf-8", newline="") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "997", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_the_same_rows_as_one_task_a_file(spark, tmp_path, small_splits, end):
    path = written(tmp_path / "merchants.csv", merchants(1, 900), end)
    got = read_records(spark, path, "merchants")
    assert spark_rows(got) == spark_rows(read_csv(spark, path, "merchants", multi_line=True))
    assert got.count() == 900
    tasks = spark.read.text(path).rdd.getNumPartitions()
    assert tasks > 20


def test_records_longer_than_many_splits_and_files_in_a_folder(spark, tmp_path, small_splits):
    folder = tmp_path / "merchants.csv"
    folder.mkdir()
    long = ["L", "line\n" * 3000 + '"', "1"]
    written(folder / "a.csv", [*merchants(2, 30), long, *merchants(3, 30)])
    written(folder / "b.csv", [long])
    written(folder / "c.csv", [])
    (folder / "d.csv").write_text("merchant_id,merchant_name,fee_rate\n\nM1,a,\n\nM2,b,1")
    got = spark_rows(read_records(spark, str(folder), "merchants"))
    assert got == spark_rows(read_csv(spark, str(folder), "merchants", multi_line=True))
    assert records(spark, str(folder)).where("header").count() == 4


def test_bad_files_fail(spark, tmp_path, small_splits):
    with pytest.raises(Exception, match="header names other columns"):
        read_records(spark, written(tmp_path / "a.csv", [], header=["x", "y", "z"]), "merchants").collect()
    for row in (["M3", "short"], ["M4", "long", "1", "000"]):
        path = written(tmp_path / f"{row[0]}.csv", [*merchants(4, 5), row])
        with pytest.raises(Exception, match="(?i)malformed"):
            read_records(spark, path, "merchants").select("merchant_id").collect()
    (tmp_path / "open.csv").write_text('merchant_id,merchant_name,fee_rate\nM1,"never closed,1\nM2,b,2\n')
    with pytest.raises(Exception, match="never closed"):
        read_records(spark, str(tmp_path / "open.csv"), "merchants").collect()


def test_a_folder_of_tables(spark, tmp_path):
    from sample import sample_rows
    from test_warehouse import write_csv

    rows = sample_rows()
    rows["merchants"] = [(i, f"two\nlines {n}", r) for i, n, r in rows["merchants"]]
    folder = write_csv(tmp_path, rows)
    split, whole = (read_csv_folder(spark, folder, **how) for how in ({"multi_line": True}, {"multi_line": True, "whole_files": True}))
    for (name, one), (_, other) in zip(split.items(), whole.items(), strict=True):
        assert spark_rows(one) == spark_rows(other), name
