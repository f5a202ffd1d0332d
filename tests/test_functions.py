"""Scalar functions: extraction, normalisation, text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revspine.functions import (first_item, fmt_axis_k, fmt_currency, fmt_delta, fmt_pct, interval_count,
                                monthly_cents, trend, ts_utc)


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_ts_utc_epoch_iso_and_null(spark):
    got = _one(spark, ts_utc("t"), "t string",
               [("1700000000",), ("2024-01-01T00:00:00+00:00",), ("2024-01-01T02:00:00+02:00",), (None,)])
    assert got == [dt.datetime(2023, 11, 14, 22, 13, 20), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), None]


def test_first_item_empty_and_null(spark):
    got = _one(spark, first_item("a"), "a array<int>", [([],), (None,), ([7, 8],)])
    assert got == [None, None, 7]


def test_interval_count_default_only_with_recurring(spark):
    got = _one(spark, interval_count("r"), "r struct<interval:string, interval_count:bigint>",
               [(None,), (("month", None),), (("year", 3),)])
    assert got == [None, 1, 3]


CENTS_ROWS = [  # plan_amount, quantity, interval, interval_count
    (79000, 1, "year", 1), (1550, 1, "week", 2), (333, 1, "day", 1), (7900, 1, "month", None),
    (5000, 2, "quarter", None), (1001, 1, "year", 1), (2900, 3, "month", 1),
]


@pytest.mark.parametrize("mode,expected", [
    ("full", [6583, 3358, 10136, None, 10000, 83, 8700]),
    ("view", [6583, 1550, 333, None, 10000, 83, 8700]),
    ("api", [6583, 1550, 333, 7900, 10000, 83, 8700]),
])
def test_monthly_cents_modes(spark, mode, expected):
    got = _one(spark, monthly_cents(mode), "plan_amount long, quantity long, plan_interval string, "
               "plan_interval_count long", CENTS_ROWS)
    assert got == expected


def test_monthly_cents_zero_interval_raises(spark):
    df = spark.createDataFrame([(1000, 1, "month", 0)], "plan_amount long, quantity long, plan_interval string, "
                               "plan_interval_count long")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(monthly_cents("full")).collect()


def test_text_formats(spark):
    rows = [(7680.0,), (-1234.5,), (0.0,), (-0.04,), (None,), (1234567.49,)]
    df = spark.createDataFrame(rows, "x double")
    got = df.select(fmt_currency("x"), fmt_pct("x"), trend("x"), fmt_axis_k("x")).collect()
    assert [tuple(r) for r in got] == [
        ("$7,680", "+7680.0%", "up", "$8k"),
        ("-$1,235", "-1234.5%", "down", "$-1k"),
        ("$0", "0.0%", "up", "$0k"),
        ("-$0", "-0.0%", "down", "$0k"),
        (None, "—", "none", None),
        ("$1,234,567", "+1234567.5%", "up", "$1235k"),
    ]
    d = spark.createDataFrame([(3,), (0,), (-2,), (None,)], "d long").select(fmt_delta("d")).collect()
    assert [r[0] for r in d] == ["+3 from last month", "+0 from last month", "-2 from last month", None]


def test_round_half_away_from_zero(spark):
    got = spark.range(1).select(F.round(F.lit(2.5)), F.round(F.lit(-2.5))).first()
    assert tuple(got) == (3.0, -3.0)


def test_queries_force_utc_session(spark):
    """Calendar dates are taken in UTC whatever zone the caller's session uses."""
    from __spark_entry__ import queries
    q = queries()["monthly_mrr_api"]
    utc = [tuple(r) for r in q(spark, "/root/testdata/sf0.001").collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = [tuple(r) for r in q(spark, "/root/testdata/sf0.001").collect()]
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == utc


def test_calendar_helpers(spark):
    from revspine.functions import index_month, month_index, month_of, month_text, next_month, utc_date
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59, 59),), (dt.datetime(1999, 12, 1),)], "t timestamp")
    rows = df.select(utc_date("t").alias("d")).select(
        month_of("d").alias("m"), next_month(month_of("d")).alias("n"), month_text("d").alias("txt"),
        index_month(month_index("d")).alias("back"), month_index("d").alias("i")).collect()
    assert [tuple(r) for r in rows] == [
        (dt.date(2024, 1, 1), dt.date(2024, 2, 1), "2024-01", dt.date(2024, 1, 1), 2024 * 12),
        (dt.date(1999, 12, 1), dt.date(2000, 1, 1), "1999-12", dt.date(1999, 12, 1), 1999 * 12 + 11)]
