"""All layers wired together: raw tables in, a dictionary of lazily defined tables out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from hrflow.operators.calendar import dim_date, time_spine
from hrflow.operators.dedupe import latest_version
from hrflow.operators.hierarchy import manager_chain_intervals
from hrflow.operators.snapshot import (
    SNAPSHOT_START,
    active_intervals,
    explode_days,
    last_termination,
    with_month,
)
from hrflow.operators.storage import cut_lineage
from hrflow.plans import core
from hrflow.plans.marts import mart_funnel, mart_workforce
from hrflow.sources.flatten import BASE_MODELS, base_model


class Tables(dict):
    """Table name -> DataFrame. Entries are built on first use, so a query defines only what it reads."""

    def __init__(self, builders: Mapping[str, object] | None = None, **known: DataFrame) -> None:
        super().__init__(known)
        self.builders = dict(builders or {})

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.builders[name]()
        return self[name]

    def pin(self, name: str, columns: Sequence[str] = ()) -> DataFrame:
        """Compute a table once, its ``columns`` alone if given, and read it from storage from now on.

        For tables that a query uses twice.
        """
        df = self[name]
        self[name] = cut_lineage(df.select(*columns) if columns else df, name)
        return self[name]


# Daily facts are stored by month.
MONTHLY = ("fact_headcount_snapshot_daily", "fact_manager_chain_daily")


def staging(raw: Mapping[str, DataFrame]) -> Tables:
    """Staging relations from raw tables: base models, profile versions deduplicated once more."""

    def build(obj: str):
        def make() -> DataFrame:
            df = base_model(raw[obj], obj)
            return latest_version(df) if obj == "profile_versions" else df

        return make

    return Tables({obj: build(obj) for obj in BASE_MODELS})


def warehouse(
    stg: Mapping[str, DataFrame],
    as_of: dt.date,
    start: dt.date = SNAPSHOT_START,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> Tables:
    """Core tables and marts from staging relations.

    ``start`` is the first snapshot day; the last one is the last termination date. ``calendar`` is the
    range of the date dimension.
    """
    bounds = calendar or ()

    t = Tables()

    def intervals(episodes: DataFrame) -> DataFrame:
        end = last_termination(stg["workers"], as_of)
        return active_intervals(t["dim_employee_profile_scd"], episodes, start, end)

    t.builders = {
        "dim_date": lambda: dim_date(stg["workers"].sparkSession, *bounds),
        "time_spine": lambda: time_spine(stg["workers"].sparkSession, *bounds),
        "dim_person": lambda: core.dim_person(stg["persons"]),
        "dim_employee": lambda: core.dim_employee(stg["workers"]),
        "dim_employment_episode": lambda: core.employment_episodes(stg["workers"], as_of),
        "dim_employee_profile_scd": lambda: core.employee_profile_scd(stg["profile_versions"]),
        "fact_employment_event": lambda: core.fact_employment_event(stg["employment_events"]),
        "active_intervals": lambda: intervals(core.employment_stints(stg["workers"], as_of)),
        "fact_headcount_snapshot_daily": lambda: explode_days(intervals(t["dim_employment_episode"])),
        "fact_manager_chain_daily": lambda: explode_days(
            manager_chain_intervals(t["active_intervals"], grain=None)
        ),
        "dim_candidate": lambda: core.dim_candidate(stg["candidates"]),
        "dim_job_requisition": lambda: core.dim_job_requisition(stg["jobs"]),
        "fact_application": lambda: core.fact_application(stg["applications"]),
        "fact_application_stage_history": lambda: core.stage_history(stg["application_stage_events"]),
        "fact_offer": lambda: core.fact_offer(stg["offers"]),
        "bridge_candidate_employee": lambda: core.candidate_bridge(stg["offers"], stg["workers"]),
        "mart_workforce_metrics_daily": lambda: mart_workforce(
            t["dim_date"], t["active_intervals"], t["fact_employment_event"], as_of, start
        ),
        "mart_recruiting_funnel_daily": lambda: mart_funnel(
            t["fact_application"], t["fact_offer"], t["dim_job_requisition"]
        ),
    }
    return t


def publish(t: Tables, folder: str, names: Sequence[str] | None = None) -> Tables:
    """Write core tables and marts as parquet below ``folder`` and read them from there afterwards.

    Tables are written in dependency order, each from the stored version of those before it. ``folder``
    must be a new version of the warehouse, not one that ``t`` is being read from.
    """
    for name in names or list(t.builders):
        df, path = t[name], f"{folder}/{name}"
        if name in MONTHLY:
            # Rebalancing keeps one month in few files without forcing it into one task.
            monthly = with_month(df).hint("rebalance", "snapshot_month")
            monthly.write.mode("overwrite").partitionBy("snapshot_month").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        t[name] = df.sparkSession.read.parquet(path)
    return t


def build(raw: Mapping[str, DataFrame], folder: str, as_of: dt.date, **options) -> Tables:
    """Staging relations, core tables and marts from raw tables, stored below ``folder``.

    Staging is stored first, so each raw table is read, deduplicated and parsed once for all that depends on it.
    """
    stored = publish(staging(raw), f"{folder}/staging")
    return publish(warehouse(stored, as_of, **options), f"{folder}/core")
