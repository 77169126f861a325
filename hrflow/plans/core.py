"""Identity, history and fact tables of the core layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.functions import day_diff, hours_between, round_away, surrogate_key, surrogate_key_if
from hrflow.operators.history import scd2
from hrflow.operators.nearest import nearest_by_date
from hrflow.operators.windows import next_in_group, number_in_group

LINEAGE = ("source_updated_at", "ingested_at_utc", "ingested_run_id")


def dim_person(persons: DataFrame) -> DataFrame:
    """One row per human."""
    return persons.select(
        surrogate_key("person_external_id").alias("person_key"),
        "person_external_id",
        "first_name",
        "last_name",
        "personal_email",
        "worker_ids_json",
        *LINEAGE,
    )


def dim_employee(workers: DataFrame) -> DataFrame:
    """One row per worker id, current state."""
    return workers.select(
        surrogate_key("worker_id").alias("employee_key"),
        surrogate_key("person_external_id").alias("person_key"),
        "worker_id",
        "person_external_id",
        "first_name",
        "last_name",
        "work_email",
        "hire_date",
        "termination_date",
        "termination_reason",
        F.col("termination_date").isNull().alias("is_currently_employed"),
        "current_department",
        "current_function",
        "current_job_title",
        "current_job_level",
        "current_manager_worker_id",
        surrogate_key_if("current_manager_worker_id").alias("current_manager_employee_key"),
        "current_worker_type",
        "current_fte",
        "current_location_city",
        "current_location_region",
        "current_location_country",
        *LINEAGE,
    )


def employment_stints(workers: DataFrame, as_of: dt.date) -> DataFrame:
    """Employment episodes without their number, which is all that interval arithmetic needs."""
    return workers.select(
        surrogate_key("worker_id", "hire_date").alias("employment_episode_key"),
        surrogate_key("worker_id").alias("employee_key"),
        surrogate_key("person_external_id").alias("person_key"),
        "worker_id",
        "person_external_id",
        "hire_date",
        "termination_date",
        "termination_reason",
        day_diff(F.col("hire_date"), F.coalesce("termination_date", F.lit(as_of))).alias("tenure_days"),
        F.col("termination_date").isNull().alias("is_active_episode"),
        "ingested_run_id",
    )


def employment_episodes(workers: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per stint, numbered per person by hire date.

    Equal hire dates are ordered by the employee key. The key is a hash, so its first characters split a
    person with very many stints (or the group of stints without a person) evenly.
    """
    numbered = number_in_group(
        employment_stints(workers, as_of),
        ["person_key"],
        [F.col("hire_date").asc_nulls_last(), F.col("employee_key")],
        [F.col("hire_date"), F.left("employee_key", F.lit(2))],
        "episode_number",
    )
    return numbered.select(
        "employment_episode_key",
        "employee_key",
        "person_key",
        "worker_id",
        "person_external_id",
        "episode_number",
        "hire_date",
        "termination_date",
        "termination_reason",
        "tenure_days",
        "is_active_episode",
        "ingested_run_id",
    )


def employee_profile_scd(versions: DataFrame) -> DataFrame:
    """Effective-dated profile history. Input: one version per worker and effective date."""
    return scd2(versions, ["worker_id"], "effective_date").select(
        surrogate_key("worker_id", "effective_date").alias("employee_profile_key"),
        surrogate_key("worker_id").alias("employee_key"),
        "worker_id",
        "person_external_id",
        "version_number",
        "valid_from_date",
        "valid_to_date",
        "is_current",
        "department",
        "function_name",
        "job_title",
        "job_level",
        "manager_worker_id",
        surrogate_key_if("manager_worker_id").alias("manager_employee_key"),
        "worker_type",
        "fte",
        "location_city",
        "location_region",
        "location_country",
        F.col("event_type").alias("version_event_type"),
        F.col("source_updated_at").alias("recorded_at_utc"),
        "ingested_run_id",
    )


def department_scd(departments: DataFrame) -> DataFrame:
    """Effective-dated department history: one row per department version."""
    rest = [c for c in departments.columns if c not in ("department_id", "effective_date")]
    return scd2(departments, ["department_id"], "effective_date").select(
        surrogate_key("department_id", "effective_date").alias("department_version_key"),
        surrogate_key("department_id").alias("department_key"),
        "department_id",
        "version_number",
        "valid_from_date",
        "valid_to_date",
        "is_current",
        *rest,
    )


def fact_employment_event(events: DataFrame) -> DataFrame:
    """One row per HR lifecycle event."""
    return events.select(
        surrogate_key("event_id").alias("employment_event_key"),
        surrogate_key("worker_id").alias("employee_key"),
        surrogate_key("person_external_id").alias("person_key"),
        "event_id",
        "worker_id",
        "person_external_id",
        "event_type",
        "effective_date",
        "department",
        "function_name",
        "job_title",
        "job_level",
        "manager_worker_id",
        surrogate_key_if("manager_worker_id").alias("manager_employee_key"),
        "termination_reason",
        F.col("source_updated_at").alias("recorded_at_utc"),
        "ingested_run_id",
    )


def dim_candidate(candidates: DataFrame) -> DataFrame:
    """One row per candidate. Candidates without a known person share the key of the null person."""
    return candidates.select(
        surrogate_key("candidate_id").alias("candidate_key"),
        surrogate_key("person_external_id").alias("person_key"),
        "candidate_id",
        "person_external_id",
        "first_name",
        "last_name",
        "email",
        "linkedin_url",
        "candidate_source",
        *LINEAGE,
    )


def dim_job_requisition(jobs: DataFrame) -> DataFrame:
    """One row per opening."""
    return jobs.select(
        surrogate_key("requisition_id").alias("requisition_key"),
        "requisition_id",
        "job_title",
        "job_level",
        "department",
        "function_name",
        "opened_at",
        "closed_at",
        "status",
        "hired_worker_ids_json",
        day_diff("opened_at", "closed_at").alias("days_open"),
        *LINEAGE,
    )


def fact_application(applications: DataFrame) -> DataFrame:
    """One row per application."""
    return applications.select(
        surrogate_key("application_id").alias("application_key"),
        surrogate_key("candidate_id").alias("candidate_key"),
        surrogate_key("requisition_id").alias("requisition_key"),
        "application_id",
        "candidate_id",
        "requisition_id",
        "submitted_at",
        "current_stage",
        "status",
        "final_outcome_reason",
        "application_source",
        "is_winning",
        "closed_at",
        day_diff("submitted_at", "closed_at").alias("days_in_funnel"),
        *LINEAGE,
    )


def stage_history(stage_events: DataFrame) -> DataFrame:
    """One row per stage transition with the hours until the next one."""
    timed = next_in_group(
        stage_events, ["application_id"], "transitioned_at", ["stage_event_id"], "next_transition_at"
    )
    hours = hours_between(F.col("transitioned_at"), F.col("next_transition_at"))
    return timed.select(
        surrogate_key("stage_event_id").alias("stage_history_key"),
        surrogate_key("application_id").alias("application_key"),
        surrogate_key("candidate_id").alias("candidate_key"),
        surrogate_key("requisition_id").alias("requisition_key"),
        "stage_event_id",
        "application_id",
        "candidate_id",
        "requisition_id",
        "from_stage",
        "to_stage",
        "transitioned_at",
        "next_transition_at",
        round_away(hours, 1).alias("hours_in_stage"),
        *LINEAGE,
    )


def fact_offer(offers: DataFrame) -> DataFrame:
    """One row per offer."""
    return offers.select(
        surrogate_key("offer_id").alias("offer_key"),
        surrogate_key("application_id").alias("application_key"),
        surrogate_key("candidate_id").alias("candidate_key"),
        surrogate_key("requisition_id").alias("requisition_key"),
        surrogate_key("accepted_person_external_id").alias("hired_person_key"),
        "offer_id",
        "application_id",
        "candidate_id",
        "requisition_id",
        "accepted_person_external_id",
        "extended_at",
        "responded_at",
        "status",
        "base_salary_amount",
        "base_salary_currency",
        day_diff("extended_at", "responded_at").alias("days_to_respond"),
        *LINEAGE,
    )


def candidate_bridge(offers: DataFrame, workers: DataFrame) -> DataFrame:
    """Accepted offers with the person's stint whose hire date is closest to the acceptance."""
    accepted = offers.where(
        (F.col("status") == "accepted") & F.col("accepted_person_external_id").isNotNull()
    ).select(
        "candidate_id",
        "requisition_id",
        "application_id",
        "offer_id",
        F.col("accepted_person_external_id").alias("person_external_id"),
        F.col("responded_at").alias("hired_at"),
    )
    stints = workers.select("person_external_id", "worker_id", "hire_date")
    linked = nearest_by_date(accepted, stints, "person_external_id", "hired_at", "hire_date", "worker_id")
    return linked.select(
        surrogate_key("offer_id", "worker_id").alias("candidate_employee_bridge_key"),
        surrogate_key("candidate_id").alias("candidate_key"),
        surrogate_key("worker_id").alias("employee_key"),
        surrogate_key("person_external_id").alias("person_key"),
        surrogate_key("requisition_id").alias("requisition_key"),
        surrogate_key("application_id").alias("application_key"),
        "candidate_id",
        "worker_id",
        "person_external_id",
        "requisition_id",
        "application_id",
        "offer_id",
        "hired_at",
        "hire_date",
        day_diff("hired_at", "hire_date").alias("days_offer_to_hris_start"),
        F.lit("offer_acceptance").alias("match_method"),
        F.lit(1.0).alias("match_confidence"),
    )
