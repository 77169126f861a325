"""Contracts of all core and base models, with checking SQL made from the declarations and the sources of each column."""

from __future__ import annotations

from hrflow.operators.storage import cut_lineage
from hrflow.plans.contracts import BASE_CONTRACTS, CORE_CONTRACTS, Contract, contract_report
from hrflow.plans.warehouse import MONTHLY
from workload.checks import check, key
from workload.registry import query

#: The relation behind each core model, and the source columns of its hash keys.
SOURCES: dict[str, tuple[str, dict[str, tuple[str, ...]]]] = {
    "dim_date": ("days", {}),
    "time_spine": ("days", {}),
    "dim_person": ("persons", {"person_key": ("person_external_id",)}),
    "dim_employee": ("workers", {"employee_key": ("worker_id",), "person_key": ("person_external_id",)}),
    "dim_employment_episode": ("episodes", {"employment_episode_key": ("worker_id", "hire_date"), "employee_key": ("worker_id",)}),
    "dim_employee_profile_scd": ("scd", {"employee_profile_key": ("worker_id", "effective_date"), "employee_key": ("worker_id",)}),
    "fact_employment_event": (
        "employment_events",
        {"employment_event_key": ("event_id",), "employee_key": ("worker_id",), "person_key": ("person_external_id",)},
    ),
    "fact_headcount_snapshot_daily": ("snapshot", {"employee_key": ("worker_id",)}),
    "fact_manager_chain_daily": ("chain", {}),
    "dim_candidate": ("candidates", {"candidate_key": ("candidate_id",)}),
    "dim_job_requisition": ("jobs", {"requisition_key": ("requisition_id",)}),
    "fact_application": (
        "applications",
        {"application_key": ("application_id",), "candidate_key": ("candidate_id",), "requisition_key": ("requisition_id",)},
    ),
    "fact_application_stage_history": (
        "application_stage_events",
        {
            "stage_history_key": ("stage_event_id",),
            "application_key": ("application_id",),
            "candidate_key": ("candidate_id",),
            "requisition_key": ("requisition_id",),
        },
    ),
    "fact_offer": (
        "offers",
        {
            "offer_key": ("offer_id",),
            "application_key": ("application_id",),
            "candidate_key": ("candidate_id",),
            "requisition_key": ("requisition_id",),
        },
    ),
    "bridge_candidate_employee": (
        "bridge",
        {
            "candidate_employee_bridge_key": ("offer_id", "worker_id"),
            "candidate_key": ("candidate_id",),
            "person_key": ("accepted_person_external_id",),
            "employee_key": ("worker_id",),
        },
    ),
    "mart_workforce_metrics_daily": ("mart_workforce", {}),
    "mart_recruiting_funnel_daily": ("mart_funnel", {}),
}
#: Columns with another name in the relation.
RENAMED = {"version_event_type": "event_type"}


def _rows(model: str, contract: Contract, sources: dict) -> list[str]:
    relation, hashed = sources[model]

    def shown(column: str, of: str = model) -> str:
        parts = sources[of][1].get(column)
        return key(*parts) if parts else RENAMED.get(column, column)

    def row(kind: str, column: str, sql: str) -> str:
        return f"""select '{model}' as model, '{kind}' as check_name, '{column}' as column_name, '{contract.severity}' as severity,
            n as failures, case when n = 0 then 'pass' else 'fail' end as status from ({sql}) as found(n)"""

    def repeated(*columns: str) -> str:
        known = " and ".join(f"{c} is not null" for c in columns)
        return f"select count(*) from (select 1 from {relation} where {known} group by {', '.join(columns)} having count(*) > 1)"

    out = [
        row("not_null", c, f"select count(*) from {relation} where {shown(c)} is null") for c in (*contract.keys.split(), *contract.required.split())
    ]
    out += [row("unique", c, repeated(shown(c))) for c in contract.keys.split()]
    if contract.unique_together:
        out.append(row("unique", "|".join(contract.unique_together), repeated(*contract.unique_together)))
    for c, values in contract.accepted.items():
        listed = ", ".join(f"'{v}'" for v in values)
        out.append(row("accepted_values", c, f"select count(distinct {shown(c)}) from {relation} where {shown(c)} not in ({listed})"))
    for c, (parent, column) in contract.refs.items():
        there = f"select {shown(column, parent)} as k from {sources[parent][0]}"
        out.append(
            row("relationships", c, f"select count(*) from {relation} where {shown(c)} is not null and {shown(c)} not in (select k from ({there}) where k is not null)")
        )
    return out


def _sql(contracts: dict[str, Contract], sources: dict) -> str:
    return check("\nunion all\n".join(r for model, contract in contracts.items() for r in _rows(model, contract, sources)))


def _columns(model: str, contracts: dict[str, Contract]) -> tuple[str, ...]:
    """What the contracts read of a model, as its own checks or as a parent."""
    c = contracts[model]
    own = [*c.keys.split(), *c.required.split(), *c.accepted, *c.refs, *c.unique_together]
    parents = [column for other in contracts.values() for parent, column in other.refs.values() if parent == model]
    return tuple(dict.fromkeys([*own, *parents]))


@query("dq_contracts", _sql(CORE_CONTRACTS, SOURCES))
def _contracts(t, spark, sf):
    """Declared checks of all 17 core models; each but the daily facts, which one scan checks, is computed once, with the columns that are checked."""
    stored = {m: cut_lineage(t[m].select(*_columns(m, CORE_CONTRACTS)), m) for m in CORE_CONTRACTS if m not in MONTHLY}
    return contract_report({**stored, **{m: t[m] for m in MONTHLY}}, CORE_CONTRACTS)


_BASE = {model: (model, {}) for model in BASE_CONTRACTS}
#: The view stands for the base model; the version table before deduplication.
_BASE["profile_versions"] = ("all_profile_versions", {})


@query("dq_contracts_base", _sql(BASE_CONTRACTS, _BASE))
def _base_contracts(t, spark, sf):
    """Declared checks of all nine base models."""
    names = {model: relation for model, (relation, _) in _BASE.items()}
    return contract_report({model: t[f"stg_{names[model]}"] for model in BASE_CONTRACTS}, BASE_CONTRACTS)
