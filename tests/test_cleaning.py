from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import cleaning
from tallyline.functions.money import expected_fee, expected_net


def values(spark, rows, expression, schema="v string"):
    table = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [row[0] for row in table.select(expression).collect()]


def test_text_loses_every_kind_of_surrounding_whitespace(spark):
    spaces = [chr(c) for c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000)]
    rows = [f"{s}{s}a b　c{s}" for s in spaces] + ["", " ", "　\t", None, "青葉　ストア", "x"]
    expected = ["a b　c"] * len(spaces) + ["", "", "", None, "青葉　ストア", "x"]
    assert values(spark, rows, cleaning.clean_text(F.col("v"))) == expected


def test_text_loses_whitespace_at_one_end_only(spark):
    ends = [*cleaning.WHITESPACE, "\r\n", "\n\n", "\n ", " \n"]
    for rows in ([f"M1{e}" for e in ends], [f"{e}M1" for e in ends], [f"a\nb{e}" for e in ends]):
        expected = ["a\nb" if "a" in r else "M1" for r in rows]
        assert values(spark, rows, cleaning.clean_text(F.col("v"))) == expected


def test_text_is_cleaned_without_a_pattern(spark):
    """Also where the first or last character is next to the printable ones."""
    rows = ["!", "~", "\x7f", "é", " !é~ ", "\tM1", "é ", "\x1fM1\x1f", "M1\x7f\u3000", "a\nb ", "😀\t"]
    clean = cleaning.clean_text(F.col("v"))
    assert values(spark, rows, clean) == [r.strip("".join(cleaning.WHITESPACE)) for r in rows]
    plan = spark.createDataFrame([("x",)], "v string").select(clean)._jdf.queryExecution().toString()
    assert "RLIKE" not in plan


def test_typed_fractions_are_rounded(spark):
    rows = [12.7, 12.5, -12.5, 12.4, None, float("nan"), 1e30]
    amount = cleaning.safe_amount(F.col("v"), T.DoubleType())
    assert values(spark, [(r,) for r in rows], amount, "v double") == [13, 13, -13, 12] + [None] * 3
    rows = [Decimal("0.5"), Decimal("2.49"), Decimal("-1.50")]
    amount = cleaning.safe_amount(F.col("v"), T.DecimalType(9, 2))
    assert values(spark, [(r,) for r in rows], amount, "v decimal(9,2)") == [1, 2, -2]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2026-03-08 02:30:00", "2026-11-01 01:30:00.123456", "1969-12-31 23:59:59.5",
             "2026-07-01", "2026-07-01T10:00:00+09:00", "2026-07-01 10:00:00Z", "2026-13-45"]
    moments = ["2026-03-08T02:30:00", "2026-11-01T01:30:00.123456", "1969-12-31T23:59:59.5",
               "2026-07-01T00:00:00", "2026-07-01T01:00:00", "2026-07-01T10:00:00"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = values(spark, texts, F.unix_micros(cleaning.safe_timestamp(F.col("v"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    start = datetime(1970, 1, 1)
    whole = [datetime.fromisoformat(m) - start for m in moments]
    assert found == [w // timedelta(microseconds=1) for w in whole] + [None]


def test_whitespace_that_is_no_space_stays(spark):
    rows = ["\u200bx\u200b", "\ufeffx"]
    assert values(spark, rows, cleaning.clean_text(F.col("v"))) == rows


def test_long_inner_runs_are_trimmed_in_linear_time(spark):
    text = ("a" + " " * 200_000) * 5 + "b"
    assert values(spark, [text + "  "], cleaning.clean_text(F.col("v"))) == [text]


def test_status_and_blank(spark):
    assert values(spark, [" success ", "Completed", None], cleaning.clean_status(F.col("v"))) == [
        "SUCCESS", "COMPLETED", None,
    ]
    assert values(spark, ["", "  ", "　", " B1 ", None], cleaning.blank_to_null(F.col("v"))) == [
        None, None, None, "B1", None,
    ]


def test_amounts_that_do_not_cast_are_null(spark):
    rows = ["12", "-3", "abc", "12.5", "", None, "9223372036854775808", "1e3", "1,000"]
    assert values(spark, rows, cleaning.safe_amount(F.col("v"))) == [12, -3] + [None] * 7


def test_rates(spark):
    rows = ["0.03", "3%", "", None, "0.0333333333333", "0.0000000005"]
    assert values(spark, rows, cleaning.safe_rate(F.col("v"))) == [
        Decimal("0.03"), None, None, None, Decimal("0.033333333"), Decimal("0.000000001"),
    ]


def test_timestamps_need_a_full_date(spark):
    rows = {
        "2026-07-01 10:00:00": datetime(2026, 7, 1, 10),
        "2026-7-1": datetime(2026, 7, 1),
        "2026-07-01T10:00:00+09:00": datetime(2026, 7, 1, 1),
        "2026-07-01 10:00:00.5": datetime(2026, 7, 1, 10, 0, 0, 500000),
        "2026": None,
        "2026-07": None,
        "10:30": None,
        "T10:30": None,
        "2026-13-01": None,
        "2026-02-30": None,
        "soon": None,
        "": None,
        None: None,
    }
    moment = cleaning.safe_timestamp(F.col("v")).cast("timestamp_ntz")
    assert values(spark, list(rows), moment) == list(rows.values())


@pytest.mark.parametrize(
    ("amount", "rate", "fee"),
    [
        (100, "0.025", 3),  # 2.5 goes up
        (100, "0.035", 4),  # 3.5 goes up
        (-100, "0.025", -3),  # away from zero
        (5, "0.099999999", 0),  # 0.499999995 must not become 0.5 first
        (2**63 - 1, "0.999999999", 9223372027631403770),
        (2**63 - 1, "2", None),  # beyond bigint
        (100, "12345678901.5", 1234567890150),
        (-3, "1000000000.5", -3000000002),  # -3000000001.5, away from zero
        (0, "99999999999999999999999999999.5", 0),
        (1, "99999999999999999999999999999.5", None),
        (7, "-2.5", -18),
        (100, None, None),
        (None, "0.03", None),
    ],
)
def test_expected_fee(spark, amount, rate, fee):
    value = Decimal(rate) if rate else None
    found = values(
        spark, [(amount, value)], expected_fee(F.col("a"), F.col("r")), "a bigint, r decimal(38,9)"
    )
    assert found == [fee]


def test_expected_net(spark):
    rows = [(100, 3), (100, None), (-(2**63), 1)]
    assert values(spark, rows, expected_net(F.col("a"), F.col("f")), "a bigint, f bigint") == [
        97, None, None,
    ]
