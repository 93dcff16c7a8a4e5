"""Column helpers: boundary-counting diffs, money rounding, cost branches."""

import datetime as dt

from pyspark.sql import functions as F

from recurra.config import FX_TO_USD
from recurra.functions import (
    hour_boundaries,
    month_boundaries,
    round_half_away,
    round_units,
    to_micros,
)
from recurra.operators.rollforward import classify
from recurra.operators.staging import annualized_cost, fx_rate, term_bucket


def ts(s):
    return dt.datetime.fromisoformat(s)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_month_boundaries_count_crossings(spark):
    rows = [(ts("2000-01-31 00:00:00"), ts("2000-02-01 00:00:00")),
            (ts("2000-01-01 00:00:00"), ts("2000-01-31 23:00:00")),
            (ts("1999-12-15 00:00:00"), ts("2001-01-14 00:00:00")),
            (ts("2000-03-01 00:00:00"), ts("2000-02-01 00:00:00"))]
    got = one(spark, rows, "s timestamp_ntz, e timestamp_ntz", month_boundaries("s", "e"))
    assert got == [1, 0, 13, -1]


def test_hour_boundaries_truncate_to_hour(spark):
    rows = [(ts("2000-01-01 05:59:00"), ts("2000-01-01 06:01:00")),
            (ts("2000-01-01 05:00:00"), ts("2000-01-02 04:59:59"))]
    got = one(spark, rows, "s timestamp_ntz, e timestamp_ntz", hour_boundaries("s", "e"))
    assert got == [1, 23]


def test_micros_and_rounding(spark):
    rows = [(1.0000005,), (2.4999994,), (0.0,)]
    got = one(spark, rows, "x double", to_micros(F.col("x")))
    assert got == [1000001, 2499999, 0]
    u = one(spark, [(12345675,), (12345674,), (-15,)], "u long", round_units(F.col("u"), 5))
    assert u == [1234568, 1234567, -2]
    r = one(spark, [(2.5,), (-2.5,), (2.4,)], "x double", round_half_away(F.col("x")))
    assert r == [3.0, -3.0, 2.0]


def test_fx_rate_normalises_code(spark):
    rows = [(" aud ",), ("USD",), ("XXX",), (None,)]
    got = one(spark, rows, "c string", fx_rate("c", FX_TO_USD))
    assert got == [FX_TO_USD["AUD"], 1.0, 1.0, 1.0]


def test_annualized_cost_branches(spark):
    schema = "a double, s timestamp_ntz, e timestamp_ntz"
    rows = [
        (100.0, ts("2000-01-15 03:00:00"), ts("2001-01-15 07:00:00")),  # same day: 12 months
        (100.0, ts("2000-01-15 00:00:00"), ts("2000-01-15 00:00:00")),  # same day, 0 months -> /1
        (100.0, ts("2000-01-15 00:00:00"), ts("2000-02-20 00:00:00")),  # 36 days
        (100.0, ts("2000-01-15 00:00:00"), ts("2000-01-14 00:00:00")),  # reversed -> 0
        (100.0, ts("2000-01-15 00:00:00"), ts("2000-01-16 00:30:00")),  # 24 hours -> 1 day
        (100.0, ts("2000-01-15 10:00:00"), ts("2000-01-16 09:00:00")),  # 23 hours -> no whole day
        (None, ts("2000-01-15 00:00:00"), ts("2001-01-15 00:00:00")),
    ]
    got = one(spark, rows, schema, annualized_cost("a", "s", "e", F.lit(1.0)))
    assert got[0] == 12 * 100.0 / 12
    assert got[1] == 12 * 100.0
    assert got[2] == 365 * 100.0 / 36
    assert got[3] == 0.0
    assert got[4] == 365 * 100.0
    assert got[5] is None
    assert got[6] is None


def test_term_bucket(spark):
    rows = [(ts("2000-01-01 00:00:00"), ts("2000-02-01 00:00:00")),
            (ts("2000-01-01 00:00:00"), ts("2000-02-02 00:00:00")),
            (ts("2001-01-01 00:00:00"), ts("2002-01-06 00:00:00")),  # 370 days
            (ts("2001-01-01 00:00:00"), ts("2002-01-07 00:00:00")),  # 371 days
            (ts("2000-01-02 00:00:00"), ts("2000-01-01 00:00:00"))]
    got = one(spark, rows, "s timestamp_ntz, e timestamp_ntz", term_bucket("s", "e"))
    assert got == ["Monthly", "Yearly", "Yearly", "Three Year", None]


def test_classify_rule_order(spark):
    d = dt.date
    schema = "arr long, prev long, chg long, m date, ce date"
    rows = [
        (5, None, 5, d(2000, 1, 31), d(2000, 6, 15)),  # New
        (0, 5, -5, d(2000, 6, 30), d(2000, 6, 15)),  # Churn at span end
        (None, 5, -5, d(2000, 3, 31), d(2000, 6, 15)),  # Churn (gap)
        (5, 5, 0, d(2000, 3, 31), d(2000, 6, 15)),  # ForEx
        (None, None, 0, d(2000, 3, 31), None),  # '-'
        (3, 5, -2, d(2000, 3, 31), d(2000, 6, 15)),  # Downgrade
        (7, 5, 2, d(2000, 3, 31), d(2000, 6, 15)),  # Upgrade
        (-1, 5, -6, d(2000, 3, 31), d(2000, 6, 15)),  # Downgrade via negative
    ]
    got = one(spark, rows, schema, classify(F.col("arr"), F.col("prev"), F.col("chg"), F.col("m"), F.col("ce")))
    assert got == ["New", "Churn", "Churn", "ForEx", "-", "Downgrade", "Upgrade", "Downgrade"]
