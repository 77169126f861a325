"""Typed base layer: the newest raw version per record, one column per declared payload field."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hrflow.operators.dedupe import latest_record


@dataclass(frozen=True)
class Field:
    """A payload field. ``strict`` fails on text that does not cast, otherwise it becomes null."""

    path: str
    name: str
    type: str = "string"
    strict: bool = True


def _fields(spec: str) -> list[Field]:
    """``path[>name][:type[?]]`` separated by blanks; ``?`` marks the forgiving cast."""
    out = []
    for item in spec.split():
        names, _, type_ = item.partition(":")
        path, _, name = names.partition(">")
        out.append(Field(path, name or path, type_.rstrip("?") or "string", not type_.endswith("?")))
    return out


# Source object -> (id column, payload fields in output order).
BASE_MODELS: dict[str, tuple[str, list[Field]]] = {
    "workers": (
        "worker_id",
        _fields(
            """person_external_id first_name last_name work_email personal_email hire_date:date
            termination_date:date? termination_reason current_department current_function
            current_job_title current_job_level current_manager_worker_id current_worker_type
            current_fte:double current_location_city current_location_region current_location_country
            is_active>is_active_in_source:boolean"""
        ),
    ),
    "persons": (
        "person_external_id",
        _fields("first_name last_name personal_email worker_ids>worker_ids_json"),
    ),
    "profile_versions": (
        "profile_version_id",
        _fields(
            """worker_id person_external_id effective_date:date department function>function_name
            job_title job_level manager_worker_id worker_type fte:double location_city
            location_region location_country event_type"""
        ),
    ),
    "employment_events": (
        "event_id",
        _fields(
            """worker_id person_external_id event_type effective_date:date department
            function>function_name job_title job_level manager_worker_id termination_reason"""
        ),
    ),
    "jobs": (
        "requisition_id",
        _fields(
            """job_title job_level department function>function_name opened_at:date closed_at:date?
            status hired_worker_ids>hired_worker_ids_json"""
        ),
    ),
    "candidates": (
        "candidate_id",
        _fields("first_name last_name email linkedin_url source>candidate_source person_external_id"),
    ),
    "applications": (
        "application_id",
        _fields(
            """candidate_id requisition_id submitted_at:timestamp current_stage status
            final_outcome_reason source>application_source is_winning:boolean closed_at:timestamp?"""
        ),
    ),
    "application_stage_events": (
        "stage_event_id",
        _fields(
            "application_id candidate_id requisition_id from_stage to_stage transitioned_at:timestamp"
        ),
    ),
    "offers": (
        "offer_id",
        _fields(
            """application_id candidate_id requisition_id extended_at:timestamp
            responded_at:timestamp? status base_salary_amount:double? base_salary_currency
            accepted_person_external_id"""
        ),
    ),
}

# Source systems and the objects each of them lands.
SOURCE_OBJECTS = {
    "hris_workday": ("workers", "profile_versions", "persons", "employment_events"),
    "ats_ashby": ("jobs", "candidates", "applications", "application_stage_events", "offers"),
}


def json_field(payload: Column | str, path: str) -> Column:
    """One field as text; nested values come as JSON text."""
    return F.get_json_object(payload, f"$.{path}")


def json_field_cast(payload: Column | str, path: str, type_: str) -> Column:
    """One field, typed; fails on text that does not cast (ANSI mode)."""
    return json_field(payload, path).cast(type_)


def json_field_try_cast(payload: Column | str, path: str, type_: str) -> Column:
    """One field, typed; null where the text does not cast."""
    return json_field(payload, path).try_cast(type_)


def flatten(raw: DataFrame, id_name: str, fields: Sequence[Field]) -> DataFrame:
    """Typed columns out of ``raw_payload``, plus id and lineage columns.

    The payload is parsed once with an all-text schema and the casts follow, instead of scanning the
    text again for each field.
    """
    schema = T.StructType([T.StructField(f.path, T.StringType()) for f in fields])
    doc = raw.withColumn("_doc", F.from_json("raw_payload", schema))

    def column(f: Field) -> Column:
        text = F.col("_doc").getField(f.path)
        if f.type == "string":
            return text.alias(f.name)
        return (text.cast(f.type) if f.strict else text.try_cast(f.type)).alias(f.name)

    return doc.select(
        F.col("_source_record_id").alias(id_name),
        *[column(f) for f in fields],
        F.col("_source_updated_at").alias("source_updated_at"),
        F.col("_ingested_at_utc").alias("ingested_at_utc"),
        F.col("_run_id").alias("ingested_run_id"),
    )


def base_model(raw: DataFrame, obj: str) -> DataFrame:
    """Newest version per record of a source object, flattened."""
    id_name, fields = BASE_MODELS[obj]
    return flatten(latest_record(raw), id_name, fields)
