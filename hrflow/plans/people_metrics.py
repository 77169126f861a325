"""Metrics with their own denominators: attrition, mobility, time to hire, offer acceptance."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.functions import business_days, safe_ratio

# Worker types that count as employees, event types that count as internal moves,
# offer outcomes decided by the candidate.
EMPLOYEE_TYPES = ("full_time", "part_time", "intern")
MOVE_TYPES = ("transfer", "promotion", "lateral")
CANDIDATE_DECISIONS = ("accepted", "declined", "expired")


def with_is_employee(df: DataFrame, types: Sequence[str] = EMPLOYEE_TYPES) -> DataFrame:
    """Adds ``is_employee``; contractors and contingent workers are workforce but not employees."""
    return df.withColumn("is_employee", F.coalesce(F.col("worker_type").isin(list(types)), F.lit(False)))


def workforce_on(intervals: DataFrame, day: dt.date, by: str) -> DataFrame:
    """Employees and total workforce on one day."""
    rows = with_is_employee(intervals.where((F.col("from_date") <= F.lit(day)) & (F.col("to_date") >= F.lit(day))))
    return rows.groupBy(by).agg(
        F.countDistinct(F.when(F.col("is_employee"), F.col("employee_key"))).alias("active_headcount"),
        F.countDistinct("employee_key").alias("total_workforce_active"),
    )


def _average_headcount(intervals: DataFrame, start: dt.date, end: dt.date, by: str) -> DataFrame:
    """Mean of the head counts on the first and the last day of a period."""
    on = lambda d: (F.col("from_date") <= F.lit(d)) & (F.col("to_date") >= F.lit(d))
    return (
        intervals.where(on(start) | on(end))
        .groupBy(by)
        .agg(F.count_if(on(start)).alias("start_headcount"), F.count_if(on(end)).alias("end_headcount"))
        .withColumn(
            "avg_headcount", (F.col("start_headcount") + F.col("end_headcount")).cast("double") / F.lit(2.0)
        )
    )


def _events_per_headcount(
    intervals: DataFrame,
    events: DataFrame,
    start: dt.date,
    end: dt.date,
    months: int,
    by: str,
    condition: Column,
    count_name: str,
    rate_name: str,
) -> DataFrame:
    in_period = F.col("effective_date").between(F.lit(start), F.lit(end))
    counted = events.where(in_period & condition).groupBy(by).agg(F.count(F.lit(1)).alias(count_name))
    staff = _average_headcount(intervals, start, end, by)
    s, e = staff.alias("s"), counted.alias("e")
    n = F.coalesce(F.col(f"e.{count_name}"), F.lit(0)).cast("bigint")
    return s.join(e, F.col(f"s.{by}").eqNullSafe(F.col(f"e.{by}")), "left").select(
        F.col(f"s.{by}").alias(by),
        "start_headcount",
        "end_headcount",
        n.alias(count_name),
        (safe_ratio(n, F.col("avg_headcount")) * F.lit(12.0 / months)).alias(rate_name),
    )


def attrition_annualised(
    intervals: DataFrame,
    events: DataFrame,
    start: dt.date,
    end: dt.date,
    months: int,
    by: str = "department",
    condition: Column | None = None,
) -> DataFrame:
    """Terminations over the mean of start and end head count, scaled to a year."""
    cond = F.col("event_type") == "termination"
    if condition is not None:
        cond = cond & condition
    return _events_per_headcount(
        intervals, events, start, end, months, by, cond, "terminations", "attrition_rate_annualised"
    )


def mobility_rate(
    intervals: DataFrame, events: DataFrame, start: dt.date, end: dt.date, months: int, by: str = "department"
) -> DataFrame:
    """Internal moves over the mean of start and end head count, scaled to a year."""
    return _events_per_headcount(
        intervals,
        events,
        start,
        end,
        months,
        by,
        F.col("event_type").isin(list(MOVE_TYPES)),
        "internal_moves",
        "mobility_rate_annualised",
    )


def time_to_hire(
    applications: DataFrame,
    offers: DataFrame,
    bridge: DataFrame,
    requisitions: DataFrame,
    by: str = "department",
) -> DataFrame:
    """Median business days between application and acceptance, for applications that led to a hire.

    ``by`` is a column of the requisitions.
    """
    accepted = (
        offers.where("status = 'accepted'")
        .join(bridge.select("offer_id").distinct(), "offer_id", "left_semi")
        .select("application_id", "responded_at")
    )
    days = (
        applications.select("application_id", "requisition_id", "submitted_at")
        .join(accepted, "application_id")
        .withColumn("business_days", business_days("submitted_at", "responded_at"))
        .join(requisitions.select("requisition_id", by), "requisition_id")
    )
    # ``percentile`` holds a day -> count map: bounded by distinct durations, combined before the shuffle.
    return days.groupBy(by).agg(
        F.count(F.lit(1)).alias("hires"),
        F.percentile("business_days", F.lit(0.5)).alias("median_business_days"),
    )


def candidate_offer_acceptance(offers: DataFrame, grain: str = "month") -> DataFrame:
    """Accepted share of the offers that candidates decided, by decision period."""
    return (
        offers.where(F.col("status").isin(list(CANDIDATE_DECISIONS)) & F.col("responded_at").isNotNull())
        .groupBy(F.trunc("responded_at", grain).alias("decision_period"))
        .agg(
            F.count_if(F.col("status") == "accepted").alias("accepted"),
            F.count(F.lit(1)).alias("decided"),
        )
        .withColumn("offer_acceptance", safe_ratio(F.col("accepted"), F.col("decided")))
    )
