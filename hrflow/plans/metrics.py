"""Metrics: one definition each, computed at any grain and slice.

``metric("hires", tables, grain="month", dims=["department"])`` groups the metric's fact by period and
dimensions. Tables are looked up by name in ``tables``; the head count model reads ``active_intervals``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.functions import safe_ratio
from hrflow.operators.calendar import period_start
from hrflow.operators.snapshot import daily_totals, snapshot_periods

Tables = Mapping[str, DataFrame]
#: Slice name -> condition on its column.
Conditions = Mapping[str, Callable[[Column], Column]]


@dataclass(frozen=True)
class Measure:
    """An aggregation (count, sum or average) of a column of a semantic model."""

    agg: str
    column: str


@dataclass(frozen=True)
class SemanticModel:
    """A fact with its time dimension, slices, foreign entities and measures.

    ``weight`` names a column that says how many fact rows a stored row stands for.
    """

    name: str
    table: str
    time: str
    dimensions: Mapping[str, str]
    entities: Mapping[str, str]
    measures: Mapping[str, Measure]
    weight: str | None = None

    def rows(self, tables: Tables, grain: str) -> DataFrame:
        df = tables[self.table]
        if self.weight is not None:
            df = snapshot_periods(df, grain)
        return df.withColumn("metric_time", period_start(F.col(self.time), grain))


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


SEMANTIC_MODELS = {
    m.name: m
    for m in (
        SemanticModel(
            "headcount_snapshot",
            "active_intervals",
            "snapshot_date",
            _same("department", "function_name", "job_title", "job_level", "worker_type", "location_country"),
            {"employee": "employee_key"},
            {"active_headcount": Measure("count", "employee_key"), "total_fte": Measure("sum", "fte")},
            weight="days",
        ),
        SemanticModel(
            "employment_events",
            "fact_employment_event",
            "effective_date",
            _same("event_type", "department", "function_name", "job_title", "job_level", "termination_reason"),
            {"employee": "employee_key"},
            {
                name: Measure("count", "employment_event_key")
                for name in (
                    "total_events",
                    "hires",
                    "terminations",
                    "voluntary_terminations",
                    "promotions",
                    "transfers",
                )
            },
        ),
        SemanticModel(
            "applications",
            "fact_application",
            "submitted_at",
            _same("current_stage", "status"),
            {"candidate": "candidate_key", "requisition": "requisition_key"},
            {
                "applications_submitted": Measure("count", "application_key"),
                "applications_hired": Measure("count", "application_key"),
                "applications_rejected": Measure("count", "application_key"),
                "avg_days_in_funnel": Measure("average", "days_in_funnel"),
            },
        ),
        SemanticModel(
            "offers",
            "fact_offer",
            "extended_at",
            {"offer_status": "status"},
            {"application": "application_key", "candidate": "candidate_key", "requisition": "requisition_key"},
            {
                "offers_extended": Measure("count", "offer_key"),
                "offers_accepted": Measure("count", "offer_key"),
                "offers_declined": Measure("count", "offer_key"),
                "avg_days_to_respond": Measure("average", "days_to_respond"),
            },
        ),
        SemanticModel(
            "stage_transitions",
            "fact_application_stage_history",
            "transitioned_at",
            _same("from_stage", "to_stage"),
            {"application": "application_key", "candidate": "candidate_key", "requisition": "requisition_key"},
            {
                "stage_transitions_count": Measure("count", "stage_history_key"),
                "avg_hours_in_stage": Measure("average", "hours_in_stage"),
            },
        ),
    )
}

# Entity -> (dimension table, key column), for slices written ``entity__column``.
ENTITY_TABLES = {
    "employee": ("dim_employee", "employee_key"),
    "candidate": ("dim_candidate", "candidate_key"),
    "requisition": ("dim_job_requisition", "requisition_key"),
    "application": ("fact_application", "application_key"),
}


@dataclass(frozen=True)
class Metric:
    """A filtered measure, or an expression over other metrics."""

    name: str
    label: str
    measure: str | None = None
    where: Callable[[], Column] | None = None
    inputs: Sequence[str] = field(default_factory=tuple)
    expr: Callable[[], Column] | None = None


def _is(column: str, *values: str) -> Callable[[], Column]:
    return lambda: F.col(column).isin(*values) if len(values) > 1 else F.col(column) == values[0]


# Fixed value: the termination reason that the voluntary metric looks for. Sources that spell reasons out
# (``voluntary_resignation``) pass their own predicate through ``overrides``.
VOLUNTARY_REASON = "voluntary"


def _voluntary() -> Column:
    return (F.col("event_type") == "termination") & (F.col("termination_reason") == VOLUNTARY_REASON)


def _rate(name: str, label: str, top: str, bottom: str) -> Metric:
    return Metric(name, label, inputs=(top, bottom), expr=lambda: safe_ratio(F.col(top), F.col(bottom)))


METRICS = {
    m.name: m
    for m in (
        Metric("active_headcount", "Active Headcount", "active_headcount"),
        Metric("total_fte", "Total FTE", "total_fte"),
        Metric("hires", "Hires", "hires", _is("event_type", "hire", "rehire")),
        Metric("terminations", "Terminations", "terminations", _is("event_type", "termination")),
        Metric("voluntary_terminations", "Voluntary Terminations", "voluntary_terminations", _voluntary),
        Metric("promotions", "Promotions", "promotions", _is("event_type", "promotion")),
        Metric("transfers", "Transfers", "transfers", _is("event_type", "transfer", "lateral")),
        _rate("voluntary_attrition_rate", "Voluntary Attrition Rate", "voluntary_terminations", "active_headcount"),
        _rate("total_attrition_rate", "Total Attrition Rate", "terminations", "active_headcount"),
        Metric("applications_submitted", "Applications Submitted", "applications_submitted"),
        Metric("applications_hired", "Applications Hired", "applications_hired", _is("status", "hired")),
        Metric("offers_extended", "Offers Extended", "offers_extended"),
        Metric("offers_accepted", "Offers Accepted", "offers_accepted", _is("status", "accepted")),
        _rate("offer_acceptance_rate", "Offer Acceptance Rate", "offers_accepted", "offers_extended"),
        _rate("funnel_conversion_rate", "Funnel Conversion Rate", "applications_hired", "applications_submitted"),
        Metric("avg_days_in_funnel", "Avg Days in Funnel", "avg_days_in_funnel"),
        Metric("avg_days_to_respond", "Avg Days to Offer Response", "avg_days_to_respond"),
        Metric("avg_hours_in_stage", "Avg Hours in Stage", "avg_hours_in_stage"),
    )
}


def _model_of(measure: str) -> SemanticModel:
    return next(m for m in SEMANTIC_MODELS.values() if measure in m.measures)


def _with_dims(
    df: DataFrame, model: SemanticModel, dims: Sequence[str], tables: Tables, only: Conditions | None = None
) -> DataFrame:
    """Adds every requested slice as a column of its requested name, and keeps the rows whose slices meet ``only``."""
    only = only or {}
    wanted = [*dims, *[d for d in only if d not in dims]]
    for dim in wanted:
        if "__" not in dim:
            df = df.withColumn(f"_d_{dim}", F.col(model.dimensions[dim]))
    by_entity: dict[str, list[str]] = {}
    for dim in wanted:
        if "__" in dim:
            entity, column = dim.split("__", 1)
            by_entity.setdefault(entity, []).append(column)
    for entity, columns in by_entity.items():
        table, key = ENTITY_TABLES[entity]
        lookup = tables[table].select(
            F.col(key).alias("_k"), *[F.col(c).alias(f"_d_{entity}__{c}") for c in columns]
        )
        df = df.join(lookup, F.col(model.entities[entity]) == F.col("_k"), "left").drop("_k")
    for dim, condition in only.items():
        df = df.where(condition(F.col(f"_d_{dim}")))
    return df


def _aggregate(m: Measure, keep: Column | None, weight: str | None) -> Column:
    """Aggregate of the rows that satisfy ``keep``; null when no row of the group does."""
    x = F.col(m.column) if keep is None else F.when(keep, F.col(m.column))
    w = F.lit(1) if weight is None else F.col(weight)
    if m.agg == "count":
        return F.sum(F.when(x.isNotNull(), w)).cast("bigint")
    if m.agg == "sum":
        return F.sum(x * w)
    if m.agg == "average":
        return safe_ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))
    raise ValueError(f"unknown aggregation {m.agg!r}")


def _daily(
    model: SemanticModel,
    measures: Sequence[tuple[str, Measure, Column | None]],
    tables: Tables,
    dims: Sequence[str],
    only: Conditions | None = None,
) -> DataFrame:
    """Measures of an interval model by day, from the intervals' first and last days: no row per interval and day."""
    rows = _with_dims(tables[model.table], model, dims, tables, only)
    keeps = [keep for _, _, keep in measures]
    if all(k is not None for k in keeps):
        rows = rows.where(reduce(lambda a, b: a | b, keeps))
    by, values = [f"_d_{d}" for d in dims], {}
    for name, m, keep in measures:
        x = F.col(m.column) if keep is None else F.when(keep, F.col(m.column))
        present = F.when(x.isNotNull(), F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        values |= {f"{name}__rows": present, f"{name}__sum": present if m.agg == "count" else F.coalesce(x, F.lit(0))}
    totals = daily_totals(rows, values, by)

    def value(name: str, m: Measure) -> Column:
        total, n = F.col(f"{name}__sum"), F.col(f"{name}__rows")
        return F.when(n > 0, safe_ratio(total, n) if m.agg == "average" else total).alias(name)

    return totals.select(
        period_start(F.col("snapshot_date"), "day").alias("metric_time"),
        *[F.col(f"_d_{d}").alias(d) for d in dims],
        *[value(name, m) for name, m, _ in measures],
    )


def _semi_additive(
    model: SemanticModel,
    measures: Sequence[tuple[str, Measure, Column | None]],
    tables: Tables,
    grain: str,
    dims: Sequence[str],
    only: Conditions | None = None,
) -> DataFrame:
    """Average per loaded day instead of the sum over days."""
    rows = _with_dims(model.rows(tables, grain), model, dims, tables, only)
    bounds = tables[model.table].agg(F.min("from_date").alias("lo"), F.max("to_date").alias("hi"))
    loaded = snapshot_periods(
        bounds.select(F.col("lo").alias("from_date"), F.col("hi").alias("to_date")), grain
    ).select(period_start(F.col("snapshot_date"), grain).alias("metric_time"), F.col("days").alias("_n_days"))
    sums = rows.groupBy("metric_time", *[F.col(f"_d_{d}").alias(d) for d in dims]).agg(
        *[_aggregate(m, keep, model.weight).alias(name) for name, m, keep in measures]
    )
    return sums.join(loaded, "metric_time").select(
        "metric_time", *dims, *[safe_ratio(F.col(name), F.col("_n_days")).alias(name) for name, _, _ in measures]
    )


def metric(
    names: str | Sequence[str],
    tables: Tables,
    grain: str = "day",
    dims: Sequence[str] = (),
    where: Column | None = None,
    semi_additive: str | None = None,
    overrides: Mapping[str, Callable[[], Column]] | None = None,
    only: Conditions | None = None,
) -> DataFrame:
    """Metrics by period (``metric_time``) and slices, one column per metric.

    Head count at a grain above day is the number of employee-days of the period, computed from
    interval lengths; ``semi_additive="avg"`` divides by the loaded days of the period. ``where`` filters
    the groups, on requested slices. ``only`` holds a condition for each of any slices, requested or not, that rows must meet
    before they are aggregated; a slice that a metric's model lacks is a KeyError. Groups in which no metric has a row are
    absent. ``overrides`` replaces metric filters by name.

    All metrics of one model are computed in one pass; results of several models are combined by an
    aggregate over their union, which also matches null slices.
    """
    names = [names] if isinstance(names, str) else list(names)
    filters = {n: m.where for n, m in METRICS.items()} | dict(overrides or {})
    simple: list[str] = []
    for n in names:
        for leaf in METRICS[n].inputs or (n,):
            if leaf not in simple:
                simple.append(leaf)
    by_model: dict[str, list[str]] = {}
    for n in simple:
        by_model.setdefault(_model_of(METRICS[n].measure).name, []).append(n)

    parts = []
    for model_name, members in by_model.items():
        model = SEMANTIC_MODELS[model_name]
        if semi_additive == "avg" and model.weight is not None:
            measures = [(n, model.measures[METRICS[n].measure], filters[n]() if filters[n] else None) for n in members]
            parts.append(_semi_additive(model, measures, tables, grain, dims, only))
            continue
        if grain == "day" and model.weight is not None:
            measures = [(n, model.measures[METRICS[n].measure], filters[n]() if filters[n] else None) for n in members]
            parts.append(_daily(model, measures, tables, dims, only))
            continue
        rows = _with_dims(model.rows(tables, grain), model, dims, tables, only)
        conditions = [filters[n]() if filters[n] else None for n in members]
        if all(c is not None for c in conditions):
            # Rows that no metric uses are dropped at the scan and leave no empty groups behind.
            rows = rows.where(reduce(lambda a, b: a | b, conditions))
        if len(members) == 1:
            conditions = [None]
        parts.append(
            rows.groupBy("metric_time", *[F.col(f"_d_{d}").alias(d) for d in dims]).agg(
                *[
                    _aggregate(model.measures[METRICS[n].measure], c, model.weight).alias(n)
                    for n, c in zip(members, conditions)
                ]
            )
        )
    out = parts[0]
    if len(parts) > 1:
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        out = union.groupBy("metric_time", *dims).agg(*[F.max(n).alias(n) for n in simple])
    if where is not None:
        out = out.where(where)
    columns = [METRICS[n].expr().alias(n) if METRICS[n].expr else F.col(n) for n in names]
    return out.select("metric_time", *dims, *columns)


def measure(name: str, tables: Tables, grain: str = "day", dims: Sequence[str] = ()) -> DataFrame:
    """A raw, unfiltered measure by period and slices, also for measures without a metric."""
    model = _model_of(name)
    if grain == "day" and model.weight is not None:
        return _daily(model, [(name, model.measures[name], None)], tables, dims)
    rows = _with_dims(model.rows(tables, grain), model, dims, tables)
    return rows.groupBy("metric_time", *[F.col(f"_d_{d}").alias(d) for d in dims]).agg(
        _aggregate(model.measures[name], None, model.weight).alias(name)
    )
