"""Data-quality checks. Each returns the failing rows; no rows means the check passed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrflow.operators.history import FAR_FUTURE, overlapping_rows, overlaps


def check_not_null(df: DataFrame, columns: Sequence[str], empty: bool = False) -> DataFrame:
    """Rows with a null in any of the columns; with ``empty`` also those with a blank text, which a missing id lands as."""
    missing = [F.col(c).isNull() | ((F.trim(F.col(c).cast("string")) == "") if empty else F.lit(False)) for c in columns]
    return df.where(reduce(lambda a, b: a | b, missing))


def check_unique(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Values that occur more than once, with their count. Rows with a null in the key do not count."""
    keys = [F.col(c).alias(c) if isinstance(c, str) else c.alias(f"key_{i}") for i, c in enumerate(columns)]
    keyed = df.select(*keys)
    return keyed.dropna().groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their count. Nulls pass."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return df.where(bad).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with their count. Nulls pass.

    Children are counted per key before the join, so one key that fills the child table joins once.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return keys.join(parents, F.col(column) == F.col("_parent"), "left_anti")


def check_freshness(
    df: DataFrame,
    as_of: dt.datetime,
    warn_hours: float,
    error_hours: float,
    column: str = "_ingested_at_utc",
) -> DataFrame:
    """One row: newest load, its age at ``as_of`` and pass / warn / error. A source without rows is an error."""
    age = (
        F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.max(column).cast("timestamp"))
    ) / F.lit(3_600_000_000.0)
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(column).alias("max_loaded_at"), age.alias("age_hours")).withColumn("status", status)


def check_scd2_overlap(scd: DataFrame, pairs: bool = False) -> DataFrame:
    """Profile versions of one employee that share a day with a version that began no later.

    One row per version with one such other version, however many meet. ``pairs`` lists all pairs instead, whose number
    grows with the square of an employee's faulty versions: for looking at a small set of findings.
    """
    columns = ("employee_key", "employee_profile_key", "valid_from_date", "valid_to_date")
    if not pairs:
        return overlapping_rows(scd, *columns)
    return overlaps(scd, *columns).withColumnsRenamed({"id_a": "profile_a", "id_b": "profile_b"})


def check_episode_overlap(episodes: DataFrame) -> DataFrame:
    """Employment episodes that share a day with an episode of the same person that began no later.

    One row per episode with one such other episode: stints without a person share a key, and their pairs
    could not be listed.
    """
    return overlapping_rows(episodes, "person_key", "employment_episode_key", "hire_date", "termination_date")


def check_scd2_grain(scd: DataFrame) -> DataFrame:
    """(worker, effective date) pairs with more than one version."""
    counts = scd.groupBy("worker_id", "valid_from_date").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.where("row_count > 1")


def check_snapshot_unique(snapshot: DataFrame) -> DataFrame:
    """Employees counted more than once on a day.

    ``snapshot`` holds daily rows, or the closed intervals (``from_date``, ``to_date``) whose days they are. Intervals are swept
    once per employee, by first days and days after the last; rows are made for the days in violation only.
    """
    if "snapshot_date" in snapshot.columns:
        counts = snapshot.groupBy("snapshot_date", "employee_key").agg(F.count(F.lit(1)).alias("n"))
        return counts.where("n > 1")
    ends = F.inline(
        F.array(
            F.struct(F.col("from_date").alias("day"), F.lit(1).alias("change")),
            F.struct(F.date_add("to_date", 1).alias("day"), F.lit(-1).alias("change")),
        )
    )
    changes = snapshot.where("from_date <= to_date").select("employee_key", ends).groupBy("employee_key", "day").agg(F.sum("change").alias("change"))
    along = Window.partitionBy("employee_key").orderBy("day")
    swept = changes.select("employee_key", "day", F.lead("day").over(along).alias("next_day"), F.sum("change").over(along).alias("n"))
    days = F.explode(F.expr("sequence(day, date_sub(next_day, 1), interval 1 day)"))
    return swept.where("n > 1").select(days.alias("snapshot_date"), "employee_key", "n")


def check_snapshot_active(snapshot: DataFrame, episodes: DataFrame) -> DataFrame:
    """Snapshot rows on days on which the employee had no active episode."""
    s, e = snapshot.alias("s"), episodes.alias("e")
    active = (
        (F.col("s.employee_key") == F.col("e.employee_key"))
        & (F.col("s.snapshot_date") >= F.col("e.hire_date"))
        & (F.col("s.snapshot_date") < F.coalesce(F.col("e.termination_date"), F.lit(FAR_FUTURE)))
    )
    return s.join(e, active, "left_anti").select("snapshot_date", "employee_key")


def check_intervals_active(intervals: DataFrame, episodes: DataFrame) -> DataFrame:
    """What :func:`check_snapshot_active` finds, from the closed intervals whose days are the snapshot rows.

    Per employee the first and last days of intervals and episodes are swept once; rows are made for the days in
    violation only, not for every employee and day. An employee's rows are their own changes, so no group is large.
    """
    day_after = F.date_add("to_date", 1)
    change = lambda df, day, n, cover: df.select("employee_key", day.alias("day"), F.lit(n).alias("n"), F.lit(cover).alias("cover"))
    held = intervals.where("from_date <= to_date")
    known = episodes.where("employee_key is not null and hire_date is not null and not coalesce(termination_date <= hire_date, false)")
    changes = reduce(
        DataFrame.union,
        [
            change(held, F.col("from_date"), 1, 0),
            change(held, day_after, -1, 0),
            change(known, F.col("hire_date"), 0, 1),
            change(known.where("termination_date is not null"), F.col("termination_date"), 0, -1),
        ],
    )
    along = Window.partitionBy("employee_key").orderBy("day")
    swept = (
        changes.groupBy("employee_key", "day")
        .agg(F.sum("n").alias("n"), F.sum("cover").alias("cover"))
        .select(
            "employee_key",
            "day",
            F.lead("day").over(along).alias("next_day"),
            F.sum("n").over(along).cast("int").alias("n"),
            F.sum("cover").over(along).alias("cover"),
        )
    )
    wrong = swept.where("n > 0 and cover = 0").withColumn("snapshot_date", F.explode(F.expr("sequence(day, date_sub(next_day, 1), interval 1 day)")))
    return wrong.select("snapshot_date", F.explode(F.array_repeat("employee_key", F.col("n"))).alias("employee_key"))


def check_non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a negative number in any of the columns."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns]))


def check_delta_band(daily: DataFrame, date: str, value: str, low: float, high: float) -> DataFrame:
    """Days whose change from the day before leaves ``[low, high]``. Input: one row per calendar day."""
    previous = F.lag(value).over(Window.orderBy(date))
    return daily.select(date, value, (F.col(value) - previous).alias("delta")).where(~F.col("delta").between(low, high))


def check_run_counts(raw: DataFrame, max_drop: float, max_rise: float) -> DataFrame:
    """Extractor runs whose row count moved too far from the run before, per source object.

    Ratios are relative to the previous run: 0.5 for ``max_drop`` flags a run that lost more than half.
    """
    runs = raw.groupBy("_source_system", "_source_object", "_run_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("_ingested_at_utc").alias("started_at")
    )
    w = Window.partitionBy("_source_system", "_source_object").orderBy("started_at", "_run_id")
    change = F.col("row_count").cast("double") / F.col("previous_count") - 1.0
    return (
        runs.withColumn("previous_count", F.lag("row_count").over(w))
        .withColumn("change", change)
        .where((F.col("change") < -max_drop) | (F.col("change") > max_rise))
        .drop("started_at")
    )


def check_payload_keys(raw: DataFrame, tracked: Sequence[str], payload: str = "raw_payload") -> DataFrame:
    """Top-level JSON keys that are new, or tracked keys that no payload has, with occurrence counts."""
    spark = raw.sparkSession
    seen = (
        raw.select(F.explode(F.json_object_keys(payload)).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    expected = spark.createDataFrame([(k,) for k in tracked], "key string").withColumn("_t", F.lit(True))
    both = seen.join(expected, "key", "full_outer")
    change = F.when(F.col("_t").isNull(), "new").when(F.col("row_count").isNull(), "missing")
    return both.select(
        "key", change.alias("change"), F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count")
    ).where("change is not null")


@dataclass(frozen=True)
class Check:
    """A named check: the failing rows plus what the report says about them."""

    name: str
    model: str
    failing: DataFrame
    severity: str = "error"
    owner: str | None = None


def check_report(checks: Sequence[Check]) -> DataFrame:
    """One row per check with its number of failing rows and pass / warn / error."""
    rows = [
        c.failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c.name).alias("check_name"),
            F.lit(c.model).alias("model"),
            F.lit(c.severity).alias("severity"),
            F.lit(c.owner).cast("string").alias("owner"),
            "failures",
            F.when(F.col("failures") == 0, "pass").otherwise(c.severity).alias("status"),
        )
        for c in checks
    ]
    return reduce(DataFrame.unionByName, rows)
