"""Queries from mergeable states and subtree labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from hrflow.operators.states import (
    dense_ids,
    distinct_count,
    distinct_state_by_day,
    merge_distinct,
    merge_values,
    state_quantiles,
    value_state,
)
from hrflow.operators.storage import cut_lineage
from hrflow.operators.subtree import managers_below, org_size_by_labels, subtree_labels
from workload.checks import check
from workload.hr import _today
from workload.registry import CHECKS, query

GRAINS = ("month", "quarter", "year")


def _rolled(daily, day: str, by: list[str], merge):
    """The states of months, quarters and years, each merged from the one before."""
    state = daily.withColumnRenamed(day, "period_start")
    for grain in GRAINS:
        state = merge(state, [F.trunc("period_start", grain).alias("period_start"), *by])
        yield grain, state


def _union(frames):
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


def _per_grain(sql: str) -> str:
    return "\nunion all\n".join(sql.replace("GRAIN", grain) for grain in GRAINS)


@query(
    "distinct_by_period",
    check(
        _per_grain(
            """select 'GRAIN' as grain, cast(date_trunc('GRAIN', snapshot_date) as date) as period_start, department,
                      count(distinct employee_key) as employees from snapshot group by all"""
        )
    ),
)
def _distinct_by_period(t, spark, sf):
    """Distinct employees of months, quarters and years by department, from the daily state alone."""
    intervals = t["active_intervals"].select("employee_key", "department", "from_date", "to_date")
    ids = dense_ids(intervals, "employee_key")
    numbered = intervals.join(ids, "employee_key").drop("employee_key")
    daily = cut_lineage(distinct_state_by_day(numbered, ["department"], "snapshot_date"), "state")
    by = ["period_start", "department"]
    return _union(
        distinct_count(state, by, "employees").select(F.lit(grain).alias("grain"), *by, "employees")
        for grain, state in _rolled(daily, "snapshot_date", ["department"], merge_distinct)
    )


def _quantiles(offers, value: str, error: float | None):
    rows = offers.where(F.col("responded_at").isNotNull()).select(F.to_date("responded_at").alias("day"), "status", value)
    daily = cut_lineage(value_state(rows, ["day", "status"], value, error), "state")
    by = ["period_start", "status"]
    return _union(
        state_quantiles(state, by, {"median": 0.5, "p90": 0.9}).select(F.lit(grain).alias("grain"), *by, "n", "median", "p90")
        for grain, state in _rolled(daily, "day", ["status"], merge_values)
    )


@query(
    "quantiles_by_period",
    check(
        _per_grain(
            """select 'GRAIN' as grain, cast(date_trunc('GRAIN', responded_at) as date) as period_start, status, count(*) as n,
                      quantile_cont(days_to_respond, 0.5) as median, quantile_cont(days_to_respond, 0.9) as p90
               from offer_facts where responded_at is not null group by all"""
        )
    ),
)
def _quantiles_by_period(t, spark, sf):
    """Days until an offer is answered: exact percentiles of months, quarters and years from the daily histograms."""
    return _quantiles(t["fact_offer"], "days_to_respond", None)


ERROR = 0.01
_GROWTH = (1 + ERROR) / (1 - ERROR)


@query(
    "quantiles_sketched",
    check(
        _per_grain(
            f"""select 'GRAIN' as grain, cast(date_trunc('GRAIN', responded_at) as date) as period_start, status, count(*) as n,
                       round(quantile_cont(x, 0.5), 2) as median, round(quantile_cont(x, 0.9), 2) as p90
                from (select *, pow({_GROWTH!r}, ceil(ln(cast(base_salary_amount as double)) / ln({_GROWTH!r}))) * 2 / ({_GROWTH!r} + 1) as x
                      from offer_facts where responded_at is not null) group by all"""
        )
    ),
)
def _quantiles_sketched(t, spark, sf):
    """Offered salaries: percentiles of any period within one part in a hundred, from the daily states."""
    result = _quantiles(t["fact_offer"], "base_salary_amount", ERROR)
    return result.withColumns({name: F.round(name, 2) for name in ("median", "p90")})


@query("org_size_labels", CHECKS["org_size"])
def _org_size_labels(t, spark, sf):
    """The sizes of ``org_size`` from subtree labels, without a row per ancestor and employee."""
    return org_size_by_labels(_today(t))


@query(
    "managers_below",
    check(
        """select snapshot_date, ancestor_employee_key as manager_employee_key, employee_key as below from last_chain
           where employee_key in (select manager_employee_key from last_snapshot)
           union
           select snapshot_date, manager_employee_key, manager_employee_key from last_snapshot where manager_employee_key is not null"""
    ),
)
def _managers_below(t, spark, sf):
    """All managers at or below each manager, by ranges of labels."""
    labels = cut_lineage(subtree_labels(_today(t)), "labels")
    return managers_below(labels, labels)
