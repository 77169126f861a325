"""Manager chains, spans and organisation size.

The chain is a bounded iteration of joins that doubles the covered depth per round. It runs over managers
only: an employee's chain is the link to the direct manager followed by that manager's chain, so the many
individual contributors take part in one final join instead of one join per round.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrflow.operators.calendar import period_start, split_by_period
from hrflow.operators.history import as_of as valid_on
from hrflow.operators.history import as_of_join
from hrflow.operators.storage import Rounds, cut_lineage

MAX_DEPTH = 20
#: Chain rows of an ancestor and depth that one task takes together.
ROWS_TOGETHER = 100_000


def _extend(chain: DataFrame, links: DataFrame, on: Sequence[str], timed: bool, depth: Column) -> DataFrame:
    """Join each chain row's ancestor to that ancestor's own rows in ``links``."""
    c, h = chain.alias("c"), links.alias("h")
    cond = F.col("c.ancestor_employee_key") == F.col("h.employee_key")
    for name in on:
        cond &= F.col(f"c.{name}") == F.col(f"h.{name}")
    bounds = []
    if timed:
        cond &= (F.col("c.from_date") <= F.col("h.to_date")) & (F.col("h.from_date") <= F.col("c.to_date"))
        bounds = [
            F.greatest("c.from_date", "h.from_date").alias("from_date"),
            F.least("c.to_date", "h.to_date").alias("to_date"),
        ]
    return c.join(h, cond).select(
        *[F.col(f"c.{name}") for name in on],
        F.col("c.employee_key"),
        F.col("h.ancestor_employee_key"),
        depth.cast("int").alias("depth"),
        *bounds,
    )


def _closure(edges: DataFrame, on: Sequence[str], timed: bool, max_depth: int) -> DataFrame:
    bounds = ["from_date", "to_date"] if timed else []
    edges = edges.where(F.col("manager_employee_key").isNotNull()).select(
        *on,
        "employee_key",
        F.col("manager_employee_key").alias("ancestor_employee_key"),
        F.lit(1).alias("depth"),
        *bounds,
    )
    if max_depth < 2:
        return edges
    edges = cut_lineage(edges, "edges")
    managers = edges.select(*on, F.col("ancestor_employee_key").alias("employee_key")).distinct()
    links = cut_lineage(edges.join(managers, [*on, "employee_key"], "left_semi"), "links")

    # Path doubling: chains of length m, extended by the chains of their last member, give all chains up
    # to 2m. The cap is part of the contract: with a cycle in the edges there is always a next round.
    above, length, longest = links, 1, max_depth - 1
    while length < longest:
        full = above.where(F.col("depth") == length)
        if full.isEmpty():
            break
        step = _extend(full, above, on, timed, F.col("c.depth") + F.col("h.depth"))
        step = cut_lineage(step.where(F.col("depth") <= longest), "chains")
        above, length = above.unionByName(step), 2 * length
    indirect = _extend(edges, above, on, timed, F.col("h.depth") + 1)
    return edges.unionByName(indirect)


def manager_chain(snapshot: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(day, employee, ancestor, depth) for every day of a daily snapshot.

    A manager who is not active on a day ends the chain: the link to that manager exists, nothing above.
    """
    return _closure(snapshot, ["snapshot_date"], False, max_depth)


def _reporting_lines(intervals: DataFrame) -> DataFrame:
    """Intervals with a manager; those of an employee that follow one another under one manager become one.

    A line is a run of rows that each begin the day after the one before ends, so days keep their number of rows even where an
    employee's intervals overlap. Where the rows bring the worker id, the partitioning of the history serves here too.
    """
    owner = [c for c in ("worker_id", "employee_key") if c in intervals.columns]
    along = Window.partitionBy(*owner).orderBy("from_date", "to_date")
    before = lambda c: F.lag(c).over(along)
    follows = (before("manager_employee_key") == F.col("manager_employee_key")) & (F.date_add(before("to_date"), 1) == F.col("from_date"))
    held = intervals.where(F.col("manager_employee_key").isNotNull() & (F.col("from_date") <= F.col("to_date")))
    begins = held.select(*owner, "manager_employee_key", "from_date", "to_date", F.when(follows, 0).otherwise(1).alias("_begins"))
    numbered = begins.withColumn("_line", F.sum("_begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    lines = numbered.groupBy(*owner, "manager_employee_key", "_line").agg(
        F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date")
    )
    return lines.select("employee_key", "manager_employee_key", "from_date", "to_date")


def manager_chain_intervals(intervals: DataFrame, max_depth: int = MAX_DEPTH, grain: str | None = "month") -> DataFrame:
    """The same relation with day intervals instead of days: (employee, ancestor, depth, from, to).

    Versions that leave the manager as it was do not cut a chain. The rest is cut at year borders for the joins: the year is part
    of their key, which bounds the versions that meet per key and spreads one busy manager over many keys. The result is cut
    into periods of ``grain``, a column of that name, only after the last join; without ``grain`` it stays in long intervals.
    """
    edges = split_by_period(_reporting_lines(intervals), "year").withColumnRenamed("period_start", "year")
    keys = [c for c in ("employee_key", "manager_employee_key") if edges.schema[c].dataType.typeName() == "string"]
    chain = _closure(edges.withColumns({c: _packed(c) for c in keys}), ["year"], True, max_depth).drop("year")
    chain = chain.withColumns({c: _unpacked(c) for c in (k.replace("manager", "ancestor") for k in keys)})
    return chain if grain is None else split_by_period(chain, grain).drop("days").withColumnRenamed("period_start", grain)


def _packed(key: str) -> Column:
    """A text key as bytes: lower-case hex takes half its length, all other text one byte more."""
    raw = F.unhex(key)
    return F.when(F.lower(F.hex(raw)) == F.col(key), F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), F.col(key).cast("binary")))


def _unpacked(key: str) -> Column:
    """The text that ``_packed`` made bytes of."""
    raw = F.substring(key, 2, 2**31 - 1)
    return F.when(F.substring(key, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(raw))).otherwise(raw.cast("string"))


def org_by_period(chain: DataFrame, period: str) -> DataFrame:
    """Days, distinct employees, least and greatest employee below every ancestor and depth, per calendar ``period``.

    ``chain`` holds uncut chain intervals. They are cut into periods after their one way over the network: the rows of an
    ancestor and depth meet in one place and are summed there, which is the result. Where they are many, employees are dealt to as
    many places as it takes, so no ancestor has to fit one task, and only the sums of such places travel again. In a place an
    employee's intervals are passed in order: a period counts the employee with the first interval that reaches it.
    """
    group = ["ancestor_employee_key", "depth"]
    sizes = chain.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > ROWS_TOGETHER)
    named = [F.col(c).alias(f"_{c}") for c in group]
    parts = cut_lineage(sizes.select(*named, F.ceil(F.col("_rows") / ROWS_TOGETHER).alias("_parts")), "parts")
    keys = [c for c in ("ancestor_employee_key", "employee_key") if chain.schema[c].dataType.typeName() == "string"]

    def sums(days: str, employees: Column, least: str, greatest: str) -> list[Column]:
        return [
            F.sum(days).cast("bigint").alias("employee_days"),
            employees.alias("employees"),
            F.min(least).alias("least_employee"),
            F.max(greatest).alias("greatest_employee"),
        ]

    def per_place(rows: DataFrame, *place: str) -> DataFrame:
        """Sums of rows that are dealt by ``place``."""
        packed = rows.withColumns({c: _packed(c) for c in keys}).repartition(*place)
        along = Window.partitionBy(*place, "employee_key").orderBy("from_date")
        reach = F.max("to_date").over(along.rowsBetween(Window.unboundedPreceding, -1))
        cut = split_by_period(packed.withColumn("_reach", reach), period).withColumnRenamed("period_start", period)
        first = F.col("_reach").isNull() | (F.col(period) > period_start(F.col("_reach"), period))
        text = cut.withColumns({c: _unpacked(c) for c in keys if c not in place})
        found = text.groupBy(period, *place).agg(*sums("days", F.count_if(first), "employee_key", "employee_key"))
        return found.withColumns({c: _unpacked(c) for c in keys if c in place})

    narrow = chain.select(*group, "employee_key", "from_date", "to_date").where("from_date <= to_date")
    if parts.isEmpty():
        return per_place(narrow, *group)
    # The groups of ``parts`` have over ROWS_TOGETHER rows each, so they are few.
    large = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])
    whole = per_place(narrow.join(F.broadcast(parts), large, "left_anti"), *group)
    dealt = narrow.join(F.broadcast(parts), large).select(*narrow.columns, F.pmod(F.xxhash64("employee_key"), "_parts").alias("_part"))
    many = per_place(dealt, *group, "_part").groupBy(period, *group)
    return whole.unionByName(many.agg(*sums("employee_days", F.sum("employees"), "least_employee", "greatest_employee")))


def span_of_control(snapshot: DataFrame, employees: DataFrame) -> DataFrame:
    """Direct reports per manager name and department for a one-day snapshot."""
    # Counting per key first leaves one row per manager for the join.
    reports = snapshot.groupBy("manager_employee_key").agg(F.count(F.lit(1)).alias("n"))
    return (
        reports.join(employees, reports["manager_employee_key"] == employees["employee_key"])
        .groupBy("first_name", "last_name", "current_department")
        .agg(F.sum("n").alias("direct_reports"))
        .select(
            F.concat("first_name", F.lit(" "), "last_name").alias("manager"),
            F.col("current_department").alias("department"),
            "direct_reports",
        )
    )


def org_pyramid(chain: DataFrame) -> DataFrame:
    """Employees per number of levels above them."""
    return chain.groupBy(F.col("depth").alias("levels_above")).agg(
        F.countDistinct("employee_key").alias("employees")
    )


def org_size(chain: DataFrame) -> DataFrame:
    """Direct reports and whole organisation per manager and day.

    Distinct employees are found on (day, manager, employee) first, so a manager above everybody is
    counted by many tasks.
    """
    per_employee = chain.groupBy("snapshot_date", "ancestor_employee_key", "employee_key").agg(
        F.min("depth").alias("depth")
    )
    return per_employee.groupBy(
        "snapshot_date", F.col("ancestor_employee_key").alias("manager_employee_key")
    ).agg(
        F.count_if(F.col("depth") == 1).alias("direct_reports"),
        F.count(F.lit(1)).alias("total_org_size"),
    )


def span_stats(snapshot: DataFrame, by: str = "department") -> DataFrame:
    """Average, median and upper percentiles of direct reports per manager, by the manager's slice."""
    spans = (
        snapshot.where(F.col("manager_employee_key").isNotNull())
        .groupBy(F.col("manager_employee_key").alias("employee_key"))
        .agg(F.countDistinct(F.col("employee_key")).alias("span"))
    )
    managers = snapshot.select("employee_key", by)
    # ``percentile`` keeps a value -> count map, bounded by the number of distinct span sizes.
    return (
        spans.join(managers, "employee_key")
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("managers"),
            F.avg("span").alias("avg_span"),
            F.percentile("span", F.lit(0.5)).alias("median_span"),
            F.percentile("span", F.lit(0.9)).alias("p90_span"),
            F.max("span").alias("max_span"),
        )
    )


def resolve_survivors(merges: DataFrame, max_rounds: int = MAX_DEPTH) -> DataFrame:
    """Final survivor of every merged person key.

    ``merges`` holds (merged_key, survivor_key), one row per merged key. Each round replaces a pointer by
    its target's pointer, so the distance covered doubles and a chain of length n takes log2(n) rounds.
    """
    rounds = Rounds("merges")
    pointers = rounds.save(merges.select("merged_key", "survivor_key"))
    for _ in range(max_rounds):
        a, b = pointers.alias("a"), pointers.alias("b")
        step = a.join(b, F.col("a.survivor_key") == F.col("b.merged_key"), "left").select(
            F.col("a.merged_key"),
            F.coalesce("b.survivor_key", "a.survivor_key").alias("survivor_key"),
            F.col("b.survivor_key").isNotNull().alias("_moved"),
        )
        step = rounds.save(step)
        pointers = step.drop("_moved")
        if step.where("_moved").isEmpty():
            return pointers
    raise ValueError("merge history contains a cycle")


def attrition_by_manager(
    chain: DataFrame,
    history: DataFrame,
    terminations: DataFrame,
    intervals: DataFrame,
    employees: DataFrame,
    as_of: dt.date,
    department_like: str,
    max_depth: int,
    voluntary: Column,
    regrettable: Column,
    months: int = 12,
) -> DataFrame:
    """Voluntary attrition of the last ``months`` months by manager.

    Managers are the ancestors within ``max_depth`` levels (on the day of ``chain``) whose current profile
    is in a matching department. A leaver counts for the manager at the time of leaving. Head count is
    the number of distinct employees a manager had in the window.
    """
    day = F.lit(as_of)
    in_scope = valid_on(history, as_of).where(F.col("department").like(department_like))
    managers = (
        chain.where(F.col("depth") <= max_depth)
        .select(F.col("ancestor_employee_key").alias("employee_key"))
        .distinct()
        .join(in_scope.select("employee_key").distinct(), "employee_key", "left_semi")
        .withColumnRenamed("employee_key", "manager_employee_key")
    )
    leavers = as_of_join(
        terminations.where(F.col("effective_date") >= F.add_months(day, -months)),
        history,
        "worker_id",
        "effective_date",
        ["manager_employee_key"],
        prefix="then_",
    )
    left = leavers.groupBy(F.col("then_manager_employee_key").alias("manager_employee_key")).agg(
        F.count_if(voluntary).alias("voluntary_terms"),
        F.count_if(voluntary & regrettable).alias("regrettable_voluntary_terms"),
    )
    staff = (
        intervals.where(F.col("to_date") >= F.add_months(day, -months))
        .groupBy("manager_employee_key")
        .agg(F.countDistinct("employee_key").cast("double").alias("avg_active_headcount"))
    )
    names = employees.select(
        F.col("employee_key").alias("manager_employee_key"),
        F.concat("first_name", F.lit(" "), "last_name").alias("manager_name"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        managers.join(left, "manager_employee_key", "left")
        .join(staff, "manager_employee_key", "left")
        .join(names, "manager_employee_key", "left")
        .select(
            "manager_employee_key",
            "manager_name",
            "avg_active_headcount",
            F.coalesce("voluntary_terms", zero).alias("voluntary_terms"),
            F.coalesce("regrettable_voluntary_terms", zero).alias("regrettable_voluntary_terms"),
        )
        .withColumn(
            "voluntary_attrition_rate_annualised",
            F.col("voluntary_terms").cast("double")
            / F.nullif(F.col("avg_active_headcount"), F.lit(0.0))
            * F.lit(12.0 / months),
        )
    )
