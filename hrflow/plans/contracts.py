"""Declared expectations per relation, and a report that evaluates them.

A contract names key columns (unique and not null), further required columns, value lists and references.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.operators.quality import check_accepted_values, check_relationships, check_unique
from hrflow.sources.flatten import BASE_MODELS

# Status lists.
EVENT_TYPES = ("hire", "rehire", "promotion", "transfer", "lateral", "termination")
JOB_STATUS = ("open", "filled", "closed_unfilled")
APPLICATION_STATUS = ("active", "hired", "rejected", "withdrawn")
OFFER_STATUS = ("accepted", "declined", "expired", "rescinded", "pending")


@dataclass(frozen=True)
class Contract:
    """Expectations of one relation. ``refs`` maps a column to (parent table, parent column)."""

    severity: str
    keys: str = ""
    required: str = ""
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    refs: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    unique_together: tuple[str, ...] = ()
    blank_is_missing: bool = False

    def size(self) -> dict[str, int]:
        """Number of declared checks by kind."""
        keys = len(self.keys.split())
        return {
            "not_null": keys + len(self.required.split()),
            "unique": keys + bool(self.unique_together),
            "accepted_values": len(self.accepted),
            "relationships": len(self.refs),
        }


# Who must be what. Raw tables only need a record id, which is empty where the source had none.
RAW_CONTRACTS = {obj: Contract("standard", required="_source_record_id", blank_is_missing=True) for obj in BASE_MODELS}

BASE_CONTRACTS = {
    "workers": Contract("standard", "worker_id", "person_external_id hire_date ingested_run_id"),
    "profile_versions": Contract(
        "standard", required="profile_version_id worker_id effective_date ingested_run_id"
    ),
    "persons": Contract("standard", "person_external_id", "ingested_run_id"),
    "employment_events": Contract(
        "important", "event_id", "worker_id effective_date ingested_run_id", {"event_type": EVENT_TYPES}
    ),
    "jobs": Contract("standard", "requisition_id", "opened_at", {"status": JOB_STATUS}),
    "candidates": Contract("standard", "candidate_id"),
    "applications": Contract(
        "standard", "application_id", "candidate_id requisition_id submitted_at", {"status": APPLICATION_STATUS}
    ),
    "application_stage_events": Contract(
        "standard", "stage_event_id", "application_id to_stage transitioned_at"
    ),
    "offers": Contract(
        "important", "offer_id", "application_id candidate_id requisition_id extended_at", {"status": OFFER_STATUS}
    ),
}

STAGING_CONTRACTS = {
    "workers": Contract("standard", "worker_id", "person_external_id hire_date"),
    "profile_versions": Contract(
        "standard", required="profile_version_id worker_id effective_date ingested_run_id"
    ),
    "persons": Contract("standard", "person_external_id"),
    "employment_events": Contract("important", "event_id", "worker_id effective_date"),
    "jobs": Contract("standard", "requisition_id"),
    "candidates": Contract("standard", "candidate_id"),
    "applications": Contract("standard", "application_id", "candidate_id requisition_id"),
    "application_stage_events": Contract("standard", "stage_event_id", "application_id"),
    "offers": Contract("important", "offer_id", "application_id"),
}

_EMPLOYEE = {"employee_key": ("dim_employee", "employee_key")}
_CANDIDATE = {"candidate_key": ("dim_candidate", "candidate_key")}
_APPLICATION = {"application_key": ("fact_application", "application_key")}

CORE_CONTRACTS = {
    "dim_date": Contract("standard", "date_day"),
    "time_spine": Contract("standard", "date_day"),
    "dim_person": Contract("critical", "person_key person_external_id", "ingested_run_id"),
    "dim_employee": Contract(
        "critical",
        "employee_key worker_id",
        "person_key ingested_run_id",
        refs={"person_key": ("dim_person", "person_key")},
    ),
    "dim_employment_episode": Contract(
        "critical", "employment_episode_key", "employee_key episode_number ingested_run_id", refs=_EMPLOYEE
    ),
    "dim_employee_profile_scd": Contract(
        "critical",
        "employee_profile_key",
        "employee_key valid_from_date ingested_run_id",
        {"version_event_type": EVENT_TYPES},
        _EMPLOYEE,
    ),
    "fact_employment_event": Contract(
        "critical",
        "employment_event_key",
        "employee_key person_key ingested_run_id",
        {"event_type": EVENT_TYPES},
        _EMPLOYEE,
    ),
    "fact_headcount_snapshot_daily": Contract("important", required="snapshot_date employee_key fte"),
    "fact_manager_chain_daily": Contract("important", required="depth"),
    "dim_candidate": Contract("critical", "candidate_key candidate_id"),
    "dim_job_requisition": Contract(
        "important", "requisition_key requisition_id", "opened_at", {"status": JOB_STATUS}
    ),
    "fact_application": Contract(
        "critical",
        "application_key application_id",
        "candidate_key requisition_key submitted_at",
        {"status": APPLICATION_STATUS},
        {**_CANDIDATE, "requisition_key": ("dim_job_requisition", "requisition_key")},
    ),
    "fact_application_stage_history": Contract(
        "important",
        "stage_history_key",
        "application_key candidate_key requisition_key to_stage transitioned_at",
        refs=_APPLICATION,
    ),
    "fact_offer": Contract(
        "critical",
        "offer_key offer_id",
        "application_key candidate_key requisition_key extended_at",
        {"status": OFFER_STATUS},
        _APPLICATION,
    ),
    "bridge_candidate_employee": Contract(
        "critical", "candidate_employee_bridge_key", "candidate_key person_key", refs={**_CANDIDATE, **_EMPLOYEE}
    ),
    "mart_workforce_metrics_daily": Contract("important", "date_day", "active_headcount"),
    "mart_recruiting_funnel_daily": Contract(
        "important",
        required="event_date department function_name",
        unique_together=("event_date", "department", "function_name"),
    ),
}


def contract_report(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract], names: Sequence[str] | None = None
) -> DataFrame:
    """One row per declared check: model, check, column, severity, failures, status.

    Failures are null rows, repeated values, values outside the list, or child rows without a parent. All
    null checks of a relation share one scan; the others are grouped counts.
    """
    parts = []
    for model in names or list(contracts):
        contract, df = contracts[model], tables[model]
        required = [*contract.keys.split(), *contract.required.split()]
        if required:
            counts = [
                F.struct(
                    F.lit("not_null").alias("check_name"),
                    F.lit(c).alias("column_name"),
                    F.col(f"_{i}").alias("failures"),
                )
                for i, c in enumerate(required)
            ]
            blank = F.lit(contract.blank_is_missing)
            missing = [F.col(c).isNull() | (blank & (F.trim(F.col(c).cast("string")) == "")) for c in required]
            nulls = df.agg(*[F.count_if(m).alias(f"_{i}") for i, m in enumerate(missing)])
            parts.append(_labelled(nulls.select(F.inline(F.array(*counts))), model, contract))

        def add(check: str, column: str, failing: DataFrame, n: Column) -> None:
            row = failing.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failures"))
            row = row.select(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), "failures")
            parts.append(_labelled(row, model, contract))

        for c in contract.keys.split():
            add("unique", c, check_unique(df, [c]), F.count(F.lit(1)))
        if contract.unique_together:
            together = list(contract.unique_together)
            add("unique", "|".join(together), check_unique(df, together), F.count(F.lit(1)))
        for c, values in contract.accepted.items():
            add("accepted_values", c, check_accepted_values(df, c, values), F.count(F.lit(1)))
        for c, (parent, parent_column) in contract.refs.items():
            add("relationships", c, check_relationships(df, c, tables[parent], parent_column), F.sum("row_count"))
    return reduce(DataFrame.unionByName, parts)


def _labelled(df: DataFrame, model: str, contract: Contract) -> DataFrame:
    return df.select(
        F.lit(model).alias("model"),
        "check_name",
        "column_name",
        F.lit(contract.severity).alias("severity"),
        "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )
