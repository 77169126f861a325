"""Restatement of published daily tables: months that back-dated edits touch are rebuilt beside the frozen version."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hrflow.sources.commits import CommitLog

MONTH = "_month"
TAGS = {"restated_at_utc": "timestamp", "restatement_reason": "string"}


def dirty_months(
    old: DataFrame, new: DataFrame, columns: Sequence[str], from_col: str, to_col: str, first: dt.date, last: dt.date
) -> list[dt.date]:
    """First days of the months in [``first``, ``last``] in which the intervals of ``old`` and ``new`` differ.

    An interval is dirty if the other side has not as many with the same ``columns`` and bounds (both days included, a null
    bound is open). Dirty intervals are not expanded: each opens in its first month and closes after its last, the
    changes are summed by month, and a running sum over the months of the calendar tells which are covered. The driver
    gets at most one row a month.
    """
    shown = lambda df, n: df.select(F.xxhash64(*[x for c in (*columns, from_col, to_col) for x in (F.col(c).isNull(), F.col(c))]).alias("h"), from_col, to_col, F.lit(n).alias("side"))
    odd = shown(old, 1).unionByName(shown(new, -1)).groupBy("h", from_col, to_col).agg(F.sum("side").alias("side")).where("side <> 0")
    lo = F.greatest(F.coalesce(from_col, F.lit(first)), F.lit(first))
    hi = F.least(F.coalesce(to_col, F.lit(last)), F.lit(last))
    ranges = odd.select(lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    edges = F.inline(
        F.array(
            F.struct(F.trunc("lo", "month").alias("month"), F.lit(1).alias("change")),
            F.struct(F.add_months(F.trunc("hi", "month"), 1).alias("month"), F.lit(-1).alias("change")),
        )
    )
    changes = ranges.select(edges).groupBy("month").agg(F.sum("change").alias("change"), F.sum(F.greatest("change", F.lit(0))).alias("opened"))
    # One row a month, so the window without a key is over a bounded table.
    w = Window.orderBy("month")
    swept = changes.select("month", F.lead("month").over(w).alias("next"), F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("open"))
    covered = swept.where("open > 0").select(F.explode(F.sequence("month", F.add_months("next", -1), F.expr("interval 1 month"))).alias("month"))
    return sorted(r.month for r in covered.collect())


def runs_of(months: Sequence[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Consecutive months as pairs of first and last day."""
    out: list[tuple[dt.date, dt.date]] = []
    for month in sorted(months):
        end = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        if out and out[-1][1] + dt.timedelta(days=1) == month:
            out[-1] = (out[-1][0], end)
        else:
            out.append((month, end))
    return out


def clipped(intervals: DataFrame, first: dt.date, last: dt.date, from_col: str = "from_date", to_col: str = "to_date") -> DataFrame:
    """Closed intervals cut to [``first``, ``last``]; those outside are left out."""
    inside = intervals.where((F.col(from_col) <= F.lit(last)) & (F.col(to_col) >= F.lit(first)))
    return inside.withColumns({from_col: F.greatest(from_col, F.lit(first)), to_col: F.least(to_col, F.lit(last))})


def _by_month(df: DataFrame, day_col: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(day_col, "yyyy-MM"))


def publish_daily(log: CommitLog, table: str, daily: DataFrame, day_col: str, run_id: str, tag: str | None = None) -> int:
    """Publish a daily table as a whole, by month, with empty restatement columns. ``tag`` freezes the version by a name."""
    done = log.committed(run_id)
    if done is not None:
        return done
    rows = _by_month(daily.withColumns({c: F.lit(None).cast(t) for c, t in TAGS.items()}), day_col)
    return log.commit(run_id, log.stage(rows, table, by=MONTH), replace_tables=[table], tag=tag)


def read_daily(log: CommitLog, table: str, version: int | str | None = None) -> DataFrame:
    """A published daily table: now, at a version of the log, or at a frozen tag."""
    at = log.version_of(version) if isinstance(version, str) else version
    return log.read(table, at).drop(MONTH)


def restate_months(
    log: CommitLog,
    table: str,
    rebuild: Callable[[dt.date, dt.date], DataFrame],
    months: Sequence[dt.date],
    day_col: str,
    keys: Sequence[str],
    run_id: str,
    restated_at: dt.datetime,
    reason: str,
    tag: str | None = None,
) -> int:
    """Rebuild ``months`` of a published daily table and publish them as the next version; all other months keep their files.

    ``rebuild`` gives the rows between two days, both included; it is called once for each run of consecutive months. Rows that
    equal the published ones keep their tags, the others get ``restated_at`` and ``reason``. ``keys`` with the day identify a
    row. The version before stays as it was, under its number and tags.
    """
    done = log.committed(run_id)
    if done is not None:
        return done
    state = log.state()
    names = [m.strftime("%Y-%m") for m in months]
    old = [e for e in state.entries.get(table, ()) if e.part in set(names)]
    if not names:
        return log.commit(run_id, tag=tag, since=state.version)
    rebuilt = None
    for first, last in runs_of(months):
        part = rebuild(first, last)
        rebuilt = part if rebuilt is None else rebuilt.unionByName(part)
    published = log.read(table, state.version, names).drop(MONTH)
    values = [c for c in rebuilt.columns if c not in (day_col, *keys)]
    o, n = published.alias("o"), rebuilt.alias("n")
    same_row = F.col(f"o.{day_col}") == F.col(f"n.{day_col}")
    for k in keys:
        same_row = same_row & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
    same = F.col(f"o.{day_col}").isNotNull()
    for v in values:
        same = same & F.col(f"o.{v}").eqNullSafe(F.col(f"n.{v}"))
    fresh = {"restated_at_utc": F.lit(restated_at).cast("timestamp"), "restatement_reason": F.lit(reason)}
    rows = n.join(o, same_row, "left").select("n.*", *[F.when(same, F.col(f"o.{c}")).otherwise(x).alias(c) for c, x in fresh.items()])
    return log.commit(run_id, log.stage(_by_month(rows, day_col), table, by=MONTH), remove=old, tag=tag, since=state.version)
