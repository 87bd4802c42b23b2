"""The contract columns that SQL can tell, over awkward rows and over a given table."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tallyline.llm.queries import llm_oracles, llm_queries

from .cases import SCHEMA, documents

URLS = [
    None, "", "no mark", "://", "http://", "http://ORG", "http://org/", "http://a.Org/x?y#z", "http://borg/x",
    "https://example.org/es/1", "https://EXAMPLE.org/en/12", "https://www.example.org/en/2", "http://example.org",
    "http://x.com/fr/", "http://x.com/de/a://b", "http://x.com/DE/", "a://b://com/fr/", "http://com?/fr/", "x\n://com/fr/\ny",
]
NAMES = ["base_counts", "base_licenses", "url_rules"]


def rows_of_both(spark, folder: str, name: str) -> tuple[Counter, Counter]:
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        files = f"{folder}/{table}.parquet"
        connection.read_parquet(files if folder.startswith("/root") else f"{files}/*.parquet").create_view(table)
    expected = connection.sql(llm_oracles()[name])
    got = llm_queries()[name](spark, folder).select(*expected.columns)
    return Counter(map(tuple, got.collect())), Counter(expected.fetchall())


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory) -> str:
    folder = str(tmp_path_factory.mktemp("awkward"))
    phrases = "Cc by NC under the MIT license; under the mit license cc by\nnc apache license, version 2 3"
    lines = "a b\n\n \na b\r\na b\n" + "one two three four five six seven eight " * 3
    rows = [*documents(), (300, phrases, "en", "a", 0), (301, lines, None, "a", 0), (302, phrases * 3, "en", "a", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    pages = [(k % 17, url) for k, url in enumerate(URLS)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, awkward, name):
    got, expected = rows_of_both(spark, awkward, name)
    assert got == expected and got


@pytest.mark.parametrize("name", NAMES)
def test_given_tables(spark, name):
    got, expected = rows_of_both(spark, "/root/testdata/sf0.001", name)
    assert got == expected and got
