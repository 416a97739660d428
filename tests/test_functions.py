import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from storecast.functions import (
    clip_low,
    parse_iso,
    pct_change,
    portable_hash,
    repair_date,
    round_half_even,
    round_to_multiple,
    share_pct,
)
from storecast.operators.features import calendar_features

DAY = dt.date(2025, 1, 5)
DATES = [
    ("2025-01-05", DAY),
    ("2025-1-5", DAY),
    ("05/01/2025", DAY),
    ("5/1/2025", DAY),
    ("2025/01/05", None),
    ("", None),
    (None, None),
    ("2025-13-01", None),
    ("2025-02-30", None),
    ("2025-01-05 00:00:00", None),
    (" 2025-01-05", None),
    ("25-1-5", None),
    ("12025-1-5", None),
]


def test_dates_in_both_layouts(spark):
    rows = spark.createDataFrame([(t,) for t, _ in DATES], "t string")
    found = {r.t: r.d for r in rows.select("t", repair_date(F.col("t")).alias("d")).collect()}
    assert found == dict(DATES)


def test_profiling_accepts_only_iso(spark):
    rows = spark.createDataFrame([("05/01/2025",), ("2025-01-05",)], "t string")
    parsed = {r.t: r.d for r in rows.select("t", parse_iso(F.col("t")).alias("d")).collect()}
    assert parsed == {"05/01/2025": None, "2025-01-05": DAY}


def test_rounding_equals_numpy(spark):
    values = [0.25, 1.015, 2.675, 1.005, 2.5, -2.5, 0.125, 1e6 + 0.005, 3.14159]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2):
        got = [r[0] for r in rows.select(round_half_even(F.col("x"), digits)).collect()]
        assert got == [float(np.round(v, digits)) for v in values]


def test_round_to_multiple(spark):
    rows = spark.createDataFrame([(70.028,), (2.1,), (12.5,), (17.5,)], "x double")
    got = [r[0] for r in rows.select(round_to_multiple(F.col("x"), 5)).collect()]
    assert got == [70.0, 0.0, 10.0, 20.0]


def test_ratios_are_null_where_undefined(spark):
    rows = spark.createDataFrame([(100.0, 132.4), (0.0, 5.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in rows.select(pct_change(F.col("a"), F.col("b"))).collect()] == [
        32.4,
        None,
        None,
    ]
    assert [r[0] for r in rows.select(share_pct(F.col("b"), F.col("a"))).collect()][1:] == [
        None,
        None,
    ]


def test_clip_keeps_null(spark):
    rows = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x double")
    assert [r[0] for r in rows.select(clip_low(F.col("x"))).collect()] == [None, 0.0, 2.0]


@pytest.mark.parametrize("key", [0, 1, 7, 2**31 - 1, 2**40 + 3])
def test_portable_hash(spark, key):
    got = spark.range(1).select(portable_hash(F.lit(key))).first()[0]
    assert got == (key % 2**31) * 2654435761 % 2**32


def test_calendar(spark):
    days = [dt.date(2025, 1, 6), dt.date(2025, 1, 11), dt.date(2025, 10, 12)]
    rows = spark.createDataFrame([(d,) for d in days], "order_date date")
    got = [tuple(r[1:]) for r in calendar_features(rows).collect()]
    assert got == [(0, 1, 0, 0), (5, 1, 1, 0), (6, 10, 1, 1)]
