from __future__ import annotations

import datetime as dt
import hashlib
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hrflow.functions import (
    band,
    business_days,
    day_diff,
    hours_between,
    iso_timestamp,
    rank_in,
    round_away,
    safe_ratio,
    surrogate_key,
    surrogate_key_if,
    trailing,
)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_surrogate_key_text(spark):
    df = spark.createDataFrame([("W1", dt.date(2024, 1, 2)), (None, None)], "w string, d date")
    got = [tuple(r) for r in df.select(surrogate_key("w", "d"), surrogate_key_if("w")).collect()]
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert got == [(md5("W1|2024-01-02"), md5("W1")), (md5("_NULL_|_NULL_"), None)]


def test_day_diff_counts_midnights(spark):
    a, b = F.lit("2024-01-01 23:00:00").cast("timestamp"), F.lit("2024-01-02 01:00:00").cast("timestamp")
    assert tuple(one(spark, day_diff(a, b), day_diff(b, a), hours_between(a, b))) == (1, -1, 2.0)


def test_iso_timestamp(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+02:00",), ("no",), (None,), ("T12:30",), ("12:30",), ("2024-01-01",)], "t string")
    got = [r[0] for r in df.select(iso_timestamp("t").cast("string")).collect()]
    assert got == ["2024-01-01 10:00:00", "2024-01-01 08:00:00", None, None, None, None, "2024-01-01 00:00:00"]


def test_round_away_is_binary(spark):
    values = [1.005, 2.5, -2.5, 0.125, -0.05, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(round_away(F.col("x"), 2)).collect()] == [1.0, 2.5, -2.5, 0.13, -0.05, None]
    assert [r[0] for r in df.select(round_away(F.col("x"), 0)).collect()][:3] == [1.0, 3.0, -3.0]


def test_safe_ratio_and_band(spark):
    assert tuple(one(spark, safe_ratio(F.lit(1), F.lit(3), 3), safe_ratio(F.lit(1), F.lit(0)))) == (0.333, None)
    df = spark.createDataFrame([(1,), (10,), (99,), (None,)], "x int")
    assert [r[0] for r in df.select(band(F.col("x"), [10, 50], ["a", "b", "c"])).collect()] == ["a", "b", "c", "c"]
    assert [r[0] for r in df.select(rank_in(F.col("x").cast("string"), ["99", "1"])).collect()] == [2, None, 1, None]


def test_trailing_bounds(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-31', interval 1 day)) as d")
    anchor = F.lit(dt.date(2024, 3, 31))
    assert days.where(trailing("d", anchor, 13)).count() == 14
    assert days.where(trailing("d", anchor, 1, "month")).agg(F.min("d")).first()[0] == dt.date(2024, 2, 29)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=1, max_size=200))
def test_round_away_matches_scaling(spark, xs):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(round_away(F.col("x"), 3)).collect()]
    assert got == [math.floor(x * 1000 + 0.5) / 1000 for x in xs]


def test_business_days_counts_weekdays(spark):
    days = [dt.date(2023, 12, 20) + dt.timedelta(i) for i in range(25)]
    pairs = [(a, b) for a in days for b in days]
    weekdays = lambda a, b: sum((a + dt.timedelta(i)).weekday() < 5 for i in range(1, (b - a).days + 1))
    want = [weekdays(a, b) if a <= b else -weekdays(b, a) for a, b in pairs]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a date, b date")
    assert [r[0] for r in df.orderBy("i").select(business_days("a", "b")).collect()] == want
