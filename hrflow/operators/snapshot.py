"""Daily headcount from effective-dated history.

The daily fact is never built by joining a calendar to the history: that is an inequality join. History
and employment episodes meet in one equi-join on the worker, the validity bounds become a closed day
interval, and the interval is expanded, summed over, or cut by period, depending on the question.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrflow.operators.calendar import split_by_period
from hrflow.operators.storage import cut_lineage

# Fixed value: first day of the daily snapshot unless the caller says otherwise.
SNAPSHOT_START = dt.date(2022, 1, 1)

PROFILE_COLUMNS = (
    "employee_profile_key",
    "worker_id",
    "person_external_id",
    "department",
    "function_name",
    "job_title",
    "job_level",
    "manager_worker_id",
    "manager_employee_key",
    "worker_type",
    "fte",
    "location_country",
)
EPISODE_COLUMNS = ("employment_episode_key", "episode_number", "hire_date", "termination_date")


def last_termination(episodes: DataFrame, as_of: dt.date) -> Column:
    """Default snapshot end: the last termination date, or ``as_of`` if nobody has left (scalar subquery)."""
    return episodes.agg(F.coalesce(F.max("termination_date"), F.lit(as_of))).scalar()


def active_intervals(
    scd: DataFrame, episodes: DataFrame, start: dt.date | Column, end: dt.date | Column
) -> DataFrame:
    """Closed intervals ``[from_date, to_date]`` in which a profile version was active.

    One row per profile version and episode that share at least one day inside ``[start, end]``. Episodes
    need not be numbered; the number is carried along when present.
    """
    as_col = lambda d: d if isinstance(d, Column) else F.lit(d)
    p = scd.select("employee_key", "valid_from_date", "valid_to_date", *PROFILE_COLUMNS)
    e = episodes.select("worker_id", *[c for c in EPISODE_COLUMNS if c in episodes.columns])
    # The history is already partitioned and sorted by worker id, from which the employee key derives:
    # joining on the id keeps the history out of another shuffle.
    joined = p.join(e, "worker_id").where(
        F.col("valid_from_date").isNotNull() & F.col("hire_date").isNotNull()
    )
    # Both ends are exclusive in the history, greatest/least ignore open (null) bounds.
    lo = F.greatest("valid_from_date", "hire_date", as_col(start))
    hi = F.least(F.date_sub("valid_to_date", 1), F.date_sub("termination_date", 1), as_col(end))
    return (
        joined.withColumns({"from_date": lo, "to_date": hi})
        .where(F.col("from_date") <= F.col("to_date"))
        .drop("valid_from_date", "valid_to_date")
    )


def explode_days(intervals: DataFrame) -> DataFrame:
    """The daily fact: one row per day and active employee."""
    day = F.explode(F.sequence("from_date", "to_date", F.expr("interval 1 day")))
    return intervals.withColumn("snapshot_date", day).drop("from_date", "to_date")


def snapshot_on(intervals: DataFrame, day: dt.date | Column) -> DataFrame:
    """The daily fact for one day, without expanding the others."""
    d = day if isinstance(day, Column) else F.lit(day)
    return (
        intervals.where((F.col("from_date") <= d) & (F.col("to_date") >= d))
        .withColumn("snapshot_date", d)
        .drop("from_date", "to_date")
    )


def last_day(intervals: DataFrame) -> Column:
    """Last day of the snapshot as a scalar subquery."""
    return intervals.agg(F.max("to_date")).scalar()


def last_snapshot(
    intervals: DataFrame,
    near: dt.date | Column,
    columns: Sequence[str] = ("employee_key", "manager_employee_key", "department"),
) -> DataFrame:
    """The daily fact for the last day of the snapshot; only intervals that end on ``near`` or later are stored.

    ``near`` is where the last day is expected, usually the last termination date, on which most are still active. Any value gives
    the same rows: an earlier one stores more, and if nothing reaches it all intervals are stored.
    """
    day = near if isinstance(near, Column) else F.lit(near)
    narrow = intervals.select(*columns, "from_date", "to_date")
    stored = cut_lineage(narrow.where(F.col("to_date") >= day), "last_day")
    if stored.isEmpty():
        stored = cut_lineage(narrow, "last_day")
    return snapshot_on(stored, last_day(stored))


def with_month(daily: DataFrame) -> DataFrame:
    """Adds the storage partition column of the daily facts."""
    return daily.withColumn("snapshot_month", F.date_format("snapshot_date", "yyyy-MM"))


def stored_day(daily: DataFrame, day: dt.date) -> DataFrame:
    """One day of a stored daily fact; the month condition lets the scan skip all other partitions."""
    return daily.where((F.col("snapshot_month") == day.strftime("%Y-%m")) & (F.col("snapshot_date") == F.lit(day)))


def exact(x: Column) -> Column:
    """Fractions as decimals: running sums of plus and minus then cancel exactly."""
    return x.cast("decimal(28,10)")


def daily_totals(
    intervals: DataFrame, measures: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Daily sums of additive measures without expanding intervals to days.

    Every interval adds its values on its first day and takes them back on the day after its last. The
    changes are summed per day (map-side first), a running sum over at most one row per calendar day
    gives the totals, and only these totals are expanded. ``n`` counts the rows behind each total; days
    without rows are absent, as in a grouped daily fact.
    """
    names = ["n", *measures]
    values = [F.lit(1).cast("bigint").alias("n")] + [
        F.coalesce(m, F.lit(0)).alias(name) for name, m in measures.items()
    ]
    edges = F.inline(
        F.array(
            F.struct(F.col("from_date").alias("day"), F.lit(1).alias("sign")),
            F.struct(F.date_add("to_date", 1).alias("day"), F.lit(-1).alias("sign")),
        )
    )
    changes = (
        intervals.select(*by, "from_date", "to_date", *values)
        .select(*by, *names, edges)
        .groupBy(*by, "day")
        .agg(*[F.sum(F.col(m) * F.col("sign")).alias(m) for m in names])
    )
    w = Window.partitionBy(*by).orderBy("day")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    totals = changes.select(
        *by,
        F.col("day"),
        F.date_sub(F.lead("day").over(w), 1).alias("last_day"),
        *[F.sum(m).over(running).alias(m) for m in names],
    ).where("n > 0")
    days = F.explode(F.sequence("day", "last_day", F.expr("interval 1 day")))
    return totals.select(*by, days.alias("snapshot_date"), *names)


def person_days(intervals: DataFrame, start: Column, end: Column, by: Sequence[str]) -> DataFrame:
    """Days worked inside ``[start, end]`` per group, from interval lengths."""
    lo, hi = F.greatest("from_date", start), F.least("to_date", end)
    return (
        intervals.where((F.col("from_date") <= end) & (F.col("to_date") >= start))
        .groupBy(*by)
        .agg(F.sum(F.datediff(hi, lo) + 1).cast("bigint").alias("person_days"))
    )


def snapshot_periods(intervals: DataFrame, grain: str) -> DataFrame:
    """Snapshot rows weighted by ``days``: one row per interval and period, dated by its first day."""
    if grain == "day":
        return explode_days(intervals).withColumn("days", F.lit(1))
    return split_by_period(intervals, grain).withColumnRenamed("period_start", "snapshot_date")
