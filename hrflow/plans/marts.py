"""Daily reporting marts."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.functions import safe_ratio
from hrflow.operators.snapshot import SNAPSHOT_START, daily_totals, exact

# Columns counted by worker type and by event type.
WORKER_TYPES = ("full_time", "part_time", "contractor", "intern", "contingent")
EVENT_COLUMNS = {
    "hires": "hire",
    "rehires": "rehire",
    "terminations": "termination",
    "promotions": "promotion",
    "transfers": "transfer",
}


def mart_workforce(
    dates: DataFrame,
    intervals: DataFrame,
    events: DataFrame,
    as_of: dt.date,
    start: dt.date = SNAPSHOT_START,
) -> DataFrame:
    """Head count stocks and event flows per calendar day of ``[start, as_of]``.

    Stocks come from the running daily totals of the active intervals, so the day-by-employee fact is
    not needed. ``transfers`` counts transfers only, ``hires`` leaves rehires to their own column.
    """
    is_type = {
        f"{t}_headcount": (F.col("worker_type") == t).cast("bigint") for t in WORKER_TYPES
    }
    stocks = daily_totals(intervals, {"total_fte": exact(F.col("fte")), **is_type})
    flows = events.groupBy("effective_date").agg(
        *[F.count_if(F.col("event_type") == kind).alias(name) for name, kind in EVENT_COLUMNS.items()]
    )
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    spine = dates.where(F.col("date_day").between(F.lit(start), F.lit(as_of)))
    return (
        spine.join(stocks, F.col("date_day") == F.col("snapshot_date"), "left")
        .join(flows, F.col("date_day") == F.col("effective_date"), "left")
        .select(
            "date_day",
            "year_number",
            "quarter_number",
            "month_number",
            "first_day_of_month",
            n("n").alias("active_headcount"),
            F.coalesce(F.col("total_fte").cast("double"), F.lit(0.0)).alias("total_fte"),
            *[n(c).alias(c) for c in is_type],
            *[n(c).alias(c) for c in EVENT_COLUMNS],
            (n("hires") + n("rehires") - n("terminations")).alias("net_headcount_change"),
        )
    )


# Counted columns of the funnel mart as (kind of row, status that must hold or None).
FUNNEL_COUNTS = {
    "applications_submitted": ("application", None),
    "applications_hired": ("application", "hired"),
    "applications_rejected": ("application", "rejected"),
    "offers_extended": ("offer", None),
    "offers_accepted": ("offer", "accepted"),
    "offers_declined": ("offer", "declined"),
    "hires": ("hire", None),
}
FUNNEL_AVERAGES = {"avg_days_in_funnel": "application", "avg_days_to_respond": "offer"}


def _funnel_rows(applications: DataFrame, offers: DataFrame) -> DataFrame:
    """Applications, offers and hires in one shape. An accepted offer gives two rows: offer and hire."""
    row = lambda kind, day, days: F.struct(
        F.lit(kind).alias("kind"), F.to_date(day).alias("event_date"), days.cast("bigint").alias("days")
    )
    submitted = applications.select(
        "requisition_id",
        F.col("application_id").alias("id"),
        "status",
        F.inline(F.array(row("application", "submitted_at", F.col("days_in_funnel")))),
    )
    hire = F.when(F.col("status") == "accepted", row("hire", "responded_at", F.lit(None)))
    extended = offers.select(
        "requisition_id",
        F.col("offer_id").alias("id"),
        "status",
        F.inline(F.array_compact(F.array(row("offer", "extended_at", F.col("days_to_respond")), hire))),
    )
    return submitted.unionByName(extended)


def mart_funnel(applications: DataFrame, offers: DataFrame, jobs: DataFrame) -> DataFrame:
    """Recruiting activity per day, department and function; only combinations with activity.

    Applications count on the submission day, offers and their outcome on the day they were extended,
    hires on the day of the response. Combinations with a null department or function are listed, with
    zeros and without averages: such groups match nothing by equality.

    Distinct ids are found first, on group, kind and id, so a busy group is shared by many tasks; the
    group totals are then plain sums. Several ``count(distinct ...)`` in one aggregate would instead copy
    every row once per expression.
    """
    keys = ["event_date", "department", "function_name"]
    statuses = sorted({s for _, s in FUNNEL_COUNTS.values() if s})
    per_id = (
        _funnel_rows(applications, offers)
        .join(jobs.select("requisition_id", "department", "function_name"), "requisition_id")
        .groupBy(*keys, "kind", "id")
        .agg(
            *[F.bool_or(F.col("status") == s).alias(s) for s in statuses],
            F.sum("days").alias("days"),
            F.count("days").alias("timed"),
        )
    )
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    def of(kind: str, x: Column) -> Column:
        return F.when(F.col("kind") == kind, x)

    def count(kind: str, status: str | None) -> Column:
        hit = known & F.col("id").isNotNull() & (F.col("kind") == kind)
        return F.count_if(hit if status is None else hit & F.col(status))

    totals = per_id.groupBy(*keys).agg(
        *[count(kind, status).alias(name) for name, (kind, status) in FUNNEL_COUNTS.items()],
        *[
            safe_ratio(F.sum(of(kind, F.when(known, F.col("days")))), F.sum(of(kind, F.col("timed")))).alias(name)
            for name, kind in FUNNEL_AVERAGES.items()
        ],
    )
    return totals.select(
        *keys,
        "applications_submitted",
        "applications_hired",
        "applications_rejected",
        "avg_days_in_funnel",
        "offers_extended",
        "offers_accepted",
        "offers_declined",
        "avg_days_to_respond",
        "hires",
        safe_ratio(F.col("offers_accepted"), F.col("offers_extended"), 3).alias("offer_acceptance_rate"),
        safe_ratio(F.col("hires"), F.col("applications_submitted"), 4).alias("funnel_conversion_rate"),
    )
