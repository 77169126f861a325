"""Recruiting facts, the candidate bridge and the funnel mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from hrflow.operators.identity import link_offers_by_window
from hrflow.plans.people_metrics import candidate_offer_acceptance, time_to_hire
from workload.checks import check, key
from workload.registry import query

_LINEAGE = "source_updated_at, ingested_at_utc, ingested_run_id"


@query(
    "dim_candidate",
    check(
        f"""select {key("candidate_id")} as candidate_key, {key("person_external_id")} as person_key, candidate_id,
                   person_external_id, first_name, last_name, email, linkedin_url, candidate_source, {_LINEAGE}
            from candidates"""
    ),
)
def _candidate(t, spark, sf):
    return t["dim_candidate"]


@query(
    "dim_job",
    check(
        f"""select {key("requisition_id")} as requisition_key, requisition_id, job_title, job_level, department,
                   function_name, opened_at, closed_at, status, hired_worker_ids_json,
                   cast(date_diff('day', opened_at, closed_at) as integer) as days_open, {_LINEAGE}
            from jobs"""
    ),
)
def _job(t, spark, sf):
    return t["dim_job_requisition"]


@query(
    "fact_application",
    check(
        f"""select application_key, candidate_key, requisition_key, application_id, candidate_id, requisition_id,
                   submitted_at, current_stage, status, final_outcome_reason, application_source, is_winning,
                   closed_at, days_in_funnel, {_LINEAGE}
            from apps"""
    ),
)
def _application(t, spark, sf):
    return t["fact_application"]


@query(
    "stage_history",
    check(
        f"""select {key("stage_event_id")} as stage_history_key, {key("application_id")} as application_key,
                   {key("candidate_id")} as candidate_key, {key("requisition_id")} as requisition_key,
                   stage_event_id, application_id, candidate_id, requisition_id, from_stage, to_stage,
                   transitioned_at, next_transition_at, round(hours, 1) as hours_in_stage, {_LINEAGE}
            from stages"""
    ),
)
def _stage_history(t, spark, sf):
    return t["fact_application_stage_history"]


@query(
    "fact_offer",
    check(
        f"""select offer_key, {key("application_id")} as application_key, {key("candidate_id")} as candidate_key,
                   {key("requisition_id")} as requisition_key,
                   {key("accepted_person_external_id")} as hired_person_key, offer_id, application_id, candidate_id,
                   requisition_id, accepted_person_external_id, extended_at, responded_at, status,
                   base_salary_amount, base_salary_currency, days_to_respond, {_LINEAGE}
            from offer_facts"""
    ),
)
def _offer(t, spark, sf):
    return t["fact_offer"]


@query(
    "candidate_bridge",
    check(
        f"""select {key("offer_id", "worker_id")} as candidate_employee_bridge_key,
                   {key("candidate_id")} as candidate_key, {key("worker_id")} as employee_key,
                   {key("accepted_person_external_id")} as person_key, {key("requisition_id")} as requisition_key,
                   {key("application_id")} as application_key, candidate_id, worker_id,
                   accepted_person_external_id as person_external_id, requisition_id, application_id, offer_id,
                   responded_at as hired_at, hire_date,
                   cast(date_diff('day', cast(responded_at as date), hire_date) as integer) as days_offer_to_hris_start,
                   'offer_acceptance' as match_method, cast(1.0 as double) as match_confidence
            from bridge"""
    ),
)
def _bridge(t, spark, sf):
    return t["bridge_candidate_employee"]


@query(
    "offer_fallback_link",
    check(
        """select o.offer_id, c.candidate_source as department, o.responded_at, min(w.worker_id) as worker_id
           from offers o join candidates c on c.candidate_id = o.candidate_id
           join workers w on w.current_function = c.candidate_source
            and abs(date_diff('day', w.hire_date, cast(o.responded_at as date))) <= 14
           where o.status = 'accepted' group by 1, 2, 3 having count(distinct w.worker_id) = 1"""
    ),
)
def _fallback(t, spark, sf):
    """Accepted offers that see exactly one new worker of the same department within 14 days."""
    departments = t["stg_candidates"].select("candidate_id", F.col("candidate_source").alias("department"))
    offers = t["stg_offers"].where("status = 'accepted'").select("offer_id", "candidate_id", "responded_at")
    workers = t["stg_workers"].select("worker_id", "hire_date", F.col("current_function").alias("department"))
    linked = link_offers_by_window(offers.join(departments, "candidate_id"), workers, ["department"])
    return linked.select("offer_id", "department", "responded_at", "worker_id")


@query("mart_funnel", check("select * from mart_funnel"))
def _mart_funnel(t, spark, sf):
    return t["mart_recruiting_funnel_daily"]


@query(
    "time_to_hire_median",
    check(
        """select j.department, count(*) as hires, quantile_cont(b.n, 0.5) as median_business_days
           from (select a.requisition_id,
                        case when r >= s then
                            (select count(*) from days where date_day > s and date_day <= r
                                and dayofweek(date_day) not in (0, 6))
                        else -(select count(*) from days where date_day > r and date_day <= s
                                and dayofweek(date_day) not in (0, 6)) end as n
                 from (select p.requisition_id, cast(p.submitted_at as date) as s, cast(o.responded_at as date) as r
                       from bridge o join applications p on p.application_id = o.application_id) a) b
           join jobs j on j.requisition_id = b.requisition_id group by 1"""
    ),
)
def _time_to_hire(t, spark, sf):
    return time_to_hire(
        t["fact_application"],
        t["fact_offer"],
        t["bridge_candidate_employee"],
        t["dim_job_requisition"],
    )


@query(
    "offer_acceptance_candidate",
    check(
        """select cast(date_trunc('month', responded_at) as date) as decision_period,
                  count(*) filter (status = 'accepted') as accepted, count(*) as decided,
                  count(*) filter (status = 'accepted') / count(*) as offer_acceptance
           from offers where status in ('accepted', 'declined', 'expired') and responded_at is not null group by 1"""
    ),
)
def _acceptance(t, spark, sf):
    return candidate_offer_acceptance(t["fact_offer"])
