"""Date spine and period arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default calendar range.
SPINE_START = dt.date(2020, 1, 1)
SPINE_END = dt.date(2030, 12, 31)

# Length of one period per grain, as a Spark interval.
GRAIN_STEP = {
    "day": "interval 1 day",
    "week": "interval 7 days",
    "month": "interval 1 month",
    "quarter": "interval 3 months",
    "year": "interval 1 year",
}


def period_start(date: Column, grain: str) -> Column:
    """First day of the period that holds ``date``."""
    if grain not in GRAIN_STEP:
        raise ValueError(f"unknown grain {grain!r}")
    d = date.cast("date")
    return d if grain == "day" else F.trunc(d, grain)


def time_spine(spark: SparkSession, start: dt.date = SPINE_START, end: dt.date = SPINE_END) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def dim_date(spark: SparkSession, start: dt.date = SPINE_START, end: dt.date = SPINE_END) -> DataFrame:
    """Calendar dimension with the usual roll-up columns; weeks are ISO, Sunday is day 0."""
    d = F.col("date_day")
    dow = F.dayofweek(d) - 1
    return time_spine(spark, start, end).select(
        d,
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("iso_week"),
        dow.between(1, 5).alias("is_weekday"),
        period_start(d, "month").alias("first_day_of_month"),
        period_start(d, "quarter").alias("first_day_of_quarter"),
        period_start(d, "year").alias("first_day_of_year"),
    )


def split_by_period(intervals: DataFrame, grain: str, lo: str = "from_date", hi: str = "to_date") -> DataFrame:
    """Cut closed day intervals at period borders.

    Adds ``period_start`` and ``days``, and narrows ``lo``/``hi`` to the part inside the period. A row
    is repeated once per period it touches, so monthly work over years of history handles about a
    thirtieth of the rows of a daily explode.
    """
    step = F.expr(GRAIN_STEP[grain])
    first = period_start(F.col(lo), grain)
    out = intervals.where(F.col(lo) <= F.col(hi)).withColumn(
        "period_start", F.explode(F.sequence(first, F.col(hi), step))
    )
    last_day = F.date_sub((F.col("period_start") + step).cast("date"), 1)
    return (
        out.withColumn("_lo", F.greatest(F.col(lo), F.col("period_start")))
        .withColumn("_hi", F.least(F.col(hi), last_day))
        .withColumns({lo: F.col("_lo"), hi: F.col("_hi")})
        .drop("_lo", "_hi")
        .withColumn("days", F.datediff(F.col(hi), F.col(lo)) + 1)
    )
