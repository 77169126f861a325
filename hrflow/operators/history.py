"""Effective-dated history with half-open validity ``[valid_from_date, valid_to_date)``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrflow.operators.dedupe import latest

FAR_FUTURE = dt.date(9999, 12, 31)


def _date(d: dt.date | str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def scd2(df: DataFrame, keys: Sequence[str], effective: str) -> DataFrame:
    """Turn dated versions into validity intervals.

    The input must hold one row per key and date (see ``latest_version``). That also bounds the window:
    a key owns at most one row per calendar day, however many raw versions were landed for it.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(effective).asc_nulls_last())
    return df.withColumns(
        {
            "version_number": F.row_number().over(w),
            "valid_from_date": F.col(effective),
            "valid_to_date": F.lead(effective).over(w),
        }
    ).withColumn("is_current", F.col("valid_to_date").isNull())


def valid_at(date: dt.date | str | Column, start: str = "valid_from_date", end: str = "valid_to_date") -> Column:
    """Predicate: the interval holds ``date``. A null end means still valid."""
    d = _date(date)
    return (F.col(start) <= d) & (F.coalesce(F.col(end), F.lit(FAR_FUTURE)) > d)


def as_of(history: DataFrame, date: dt.date | str | Column) -> DataFrame:
    """Rows of a history that were valid on one day."""
    return history.where(valid_at(date))


def bitemporal_as_of(
    versions: DataFrame,
    keys: Sequence[str],
    effective: str,
    recorded: str,
    date: dt.date | str,
    known_at: dt.datetime | str,
    tie: str,
) -> DataFrame:
    """What was believed at ``known_at`` about ``date``.

    Drops versions recorded later, lets the latest recording win per key and effective date, and only
    then derives validity, so an entry made afterwards does not shorten an earlier interval.
    """
    known = versions.where(F.col(recorded) <= F.lit(known_at).cast(versions.schema[recorded].dataType))
    winners = latest(
        known, [*keys, effective], [F.col(recorded).desc_nulls_last(), F.col(tie).desc_nulls_last()]
    )
    return as_of(scd2(winners, keys, effective), date)


def as_of_join(
    events: DataFrame,
    history: DataFrame,
    key: str,
    date: str,
    columns: Sequence[str],
    prefix: str = "",
    how: str = "inner",
) -> DataFrame:
    """Attach the version valid on each event's date.

    Both sides are first reduced to one row per key and day; a running ``last`` then finds the version
    for every day asked for. Work is linear in days per key instead of events times versions, which is
    what an equi-join with an interval condition would evaluate. ``history`` holds disjoint intervals.
    """
    payload = F.struct(
        F.lit(True).alias("_hit"), F.col("valid_to_date").alias("_to"), *[F.col(c) for c in columns]
    )
    starts = history.where(F.col("valid_from_date").isNotNull()).select(
        F.col(key), F.col("valid_from_date").alias("_day"), payload.alias("_version"), F.lit(False).alias("_asked")
    )
    asked = (
        events.select(F.col(key), F.to_date(date).alias("_day"))
        .where(F.col(key).isNotNull() & F.col("_day").isNotNull())
        .distinct()
    )
    points = starts.unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    # On equal days the version comes first, so an event on its first day sees it.
    so_far = Window.partitionBy(key).orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        points.withColumn("_v", F.last("_version", ignorenulls=True).over(so_far))
        .where("_asked")
        .where(F.coalesce(F.col("_v._to"), F.lit(FAR_FUTURE)) > F.col("_day"))
        .where("_v._hit")
        .select(key, "_day", *[F.col(f"_v.{c}").alias(prefix + c) for c in columns])
    )
    return events.withColumn("_day", F.to_date(date)).join(found, [key, "_day"], how).drop("_day")


def overlaps(df: DataFrame, key: str, row_id: str, start: str, end: str) -> DataFrame:
    """Pairs of intervals of one key that intersect, each pair once.

    A linear pass finds the start days at which an interval meets an earlier or equal start. It runs on
    one row per key and day, so it is bounded for hot keys. Only keys with a finding take part in the
    pair join, which on healthy data is nobody. Rows that end before they start are not intervals and
    are left out.
    """
    rows = df.select(
        F.col(key),
        F.col(row_id).alias("_id"),
        F.col(start).alias("_from"),
        F.coalesce(F.col(end), F.lit(FAR_FUTURE)).alias("_to"),
        F.col(end).alias("_end"),
    ).where(F.col(key).isNotNull() & F.col("_from").isNotNull() & (F.col("_from") <= F.col("_to")))
    per_day = rows.groupBy(key, "_from").agg(
        F.max("_to").alias("_to"), F.count_if(F.col("_to") > F.col("_from")).alias("_n")
    )
    before = Window.partitionBy(key).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    hits = (
        per_day.withColumn("_reach", F.max("_to").over(before))
        .where((F.col("_reach") > F.col("_from")) | (F.col("_n") > 1))
        .select(key, "_from")
    )
    later = rows.join(hits, [key, "_from"], "left_semi")
    a, b = rows.alias("a"), later.alias("b")
    starts_first = (F.col("a._from") < F.col("b._from")) | (
        (F.col("a._from") == F.col("b._from")) & (F.col("a._id") < F.col("b._id"))
    )
    # The smaller id is reported first, whichever interval starts first.
    swap = F.col("a._id") > F.col("b._id")
    one, two = (
        F.struct(
            F.col(f"{side}._id").alias("id"),
            F.col(f"{side}._from").alias("start"),
            F.col(f"{side}._end").alias("end"),
        )
        for side in ("a", "b")
    )
    meet = (F.col("a._to") > F.col("b._from")) & (F.col("b._to") > F.col("a._from"))
    return (
        a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & starts_first & meet)
        .select(
            F.col(f"a.{key}").alias(key),
            F.when(swap, two).otherwise(one).alias("x"),
            F.when(swap, one).otherwise(two).alias("y"),
        )
        .select(
            key,
            F.col("x.id").alias("id_a"),
            F.col("y.id").alias("id_b"),
            F.col("x.start").alias("a_from"),
            F.col("x.end").alias("a_to"),
            F.col("y.start").alias("b_from"),
            F.col("y.end").alias("b_to"),
        )
    )


def overlapping_rows(df: DataFrame, key: str, row_id: str, start: str, end: str) -> DataFrame:
    """Intervals that meet another interval of their key which starts no later, with one such interval each.

    The linear form of :func:`overlaps`: at most one result per row, however many rows of a key intersect.
    The witness is the row that reaches furthest among those of the same start day, else among earlier ones;
    equal reach goes to the smaller id.
    """
    rows = df.select(
        F.col(key),
        F.col(row_id).alias("_id"),
        F.col(start).alias("_from"),
        F.coalesce(F.col(end), F.lit(FAR_FUTURE)).alias("_to"),
        F.col(end).alias("_end"),
    ).where(F.col(key).isNotNull() & F.col("_from").isNotNull() & (F.col("_from") <= F.col("_to")))
    # Negated days order like "later end first", so the least struct is the furthest row with the least id.
    reach = F.struct(
        (-F.unix_date("_to")).alias("order"),
        F.col("_id").alias("id"),
        F.col("_to").alias("to"),
        F.col("_end").alias("end"),
        F.col("_from").alias("start"),
    )
    leaders = rows.groupBy(key, "_from").agg(F.min(reach).alias("_leader"))
    before = Window.partitionBy(key).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    leaders = leaders.withColumn("_prior", F.min("_leader").over(before))
    beside = (F.col("_leader.id") != F.col("_id")) & (F.col("_to") > F.col("_from"))
    under = F.col("_prior.to") > F.col("_from")
    witness = F.when(beside, F.col("_leader")).when(under, F.col("_prior"))
    return (
        rows.join(leaders, [key, "_from"])
        .withColumn("_w", witness)
        .where("_w is not null")
        .select(
            key,
            F.col("_id").alias("id"),
            F.col("_from").alias("start"),
            F.col("_end").alias("end"),
            F.col("_w.id").alias("other_id"),
            F.col("_w.start").alias("other_start"),
            F.col("_w.end").alias("other_end"),
        )
    )
