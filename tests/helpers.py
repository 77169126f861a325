"""Small HR-shaped fixtures."""

from __future__ import annotations

import datetime as dt

LINEAGE = "source_updated_at timestamp, ingested_at_utc timestamp, ingested_run_id string"
STAMP = dt.datetime(2024, 1, 1)


def d(text: str | None):
    return None if text is None else dt.date.fromisoformat(text)


def ts(text: str | None):
    return None if text is None else dt.datetime.fromisoformat(text)


def workers(spark, rows):
    """rows: (worker, person, hire, termination)."""
    schema = f"""worker_id string, person_external_id string, first_name string, last_name string,
        work_email string, hire_date date, termination_date date, termination_reason string,
        current_department string, current_function string, current_job_title string, current_job_level string,
        current_manager_worker_id string, current_worker_type string, current_fte double,
        current_location_city string, current_location_region string, current_location_country string, {LINEAGE}"""
    data = [
        (w, p, "Ann", "Lee", f"{w}@firm.example", d(h), d(t), None, "Eng", "Fn", "Job", "IC1", None, "full_time", 1.0,
         "X", None, "CA", STAMP, STAMP, "run-1")
        for w, p, h, t in rows
    ]
    return spark.createDataFrame(data, schema)


def versions(spark, rows):
    """rows: (worker, effective, manager, department[, worker_type, fte, updated, id])."""
    schema = f"""profile_version_id string, worker_id string, person_external_id string, effective_date date,
        department string, function_name string, job_title string, job_level string, manager_worker_id string,
        worker_type string, fte double, location_city string, location_region string, location_country string,
        event_type string, {LINEAGE}"""
    data = []
    for i, r in enumerate(rows):
        w, e, m, dep, *rest = r
        kind, fte, updated, vid = (*rest, *["full_time", 1.0, None, None][len(rest) :])
        data.append(
            (vid or f"{w}|{e}|{i}", w, None, d(e), dep, "Fn", "Job", "IC1", m, kind, fte, None, None, "CA", "hire",
             ts(updated) or STAMP, STAMP, "run-1")
        )
    return spark.createDataFrame(data, schema)


def events(spark, rows):
    """rows: (event, worker, type, effective, department, reason)."""
    schema = f"""event_id string, worker_id string, person_external_id string, event_type string, effective_date date,
        department string, function_name string, job_title string, job_level string, manager_worker_id string,
        termination_reason string, {LINEAGE}"""
    return spark.createDataFrame(
        [(e, w, None, k, d(day), dep, None, None, None, None, why, STAMP, STAMP, "r") for e, w, k, day, dep, why in rows],
        schema,
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
