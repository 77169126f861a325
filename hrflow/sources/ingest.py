"""Extracts of the two source systems: files to raw tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hrflow.operators.storage import cut_lineage, scratch_scope
from hrflow.sources.commits import CommitLog
from hrflow.sources.documents import read_documents, unfurl, without_field
from hrflow.sources.flatten import BASE_MODELS
from hrflow.sources.landing import land, new_run_id, raw_table, rejects, stamp


@dataclass(frozen=True)
class Nested:
    """A child array that becomes an object of its own. ``own_time`` stamps children with the extract time."""

    array: str
    obj: str
    parent_keys: tuple[str, ...]
    id_parts: tuple[str, ...]
    own_time: bool = False


@dataclass(frozen=True)
class Extract:
    """One file of a source system."""

    file: str
    obj: str
    nested: Nested | None = None


# File names and nesting of the extracts.
SYSTEMS: dict[str, tuple[Extract, ...]] = {
    "hris_workday": (
        Extract(
            "workday_workers.json",
            "workers",
            Nested(
                "profile_history",
                "profile_versions",
                ("worker_id", "person_external_id"),
                ("worker_id", "effective_date"),
                own_time=True,
            ),
        ),
        Extract("workday_persons.json", "persons"),
        Extract("workday_employment_events.json", "employment_events"),
    ),
    "ats_ashby": (
        Extract("ashby_jobs.json", "jobs"),
        Extract("ashby_candidates.json", "candidates"),
        Extract(
            "ashby_applications.json",
            "applications",
            Nested(
                "stage_history",
                "application_stage_events",
                ("application_id", "candidate_id", "requisition_id"),
                ("application_id", "transitioned_at", "to_stage"),
            ),
        ),
        Extract("ashby_offers.json", "offers"),
    ),
}


#: Folder, beside the raw tables, of what could not be read as a document.
REJECTS = "rejects"


def extract_objects(
    spark: SparkSession, system: str, folder: str, extracted_at: dt.datetime, multiline: bool = False
) -> dict[str, DataFrame]:
    """Source object -> documents, child arrays split off. Only parents have a column ``reject``.

    A file is read and parsed once: its documents are stored in the shared folder, from where parents, children and
    rejects are taken. Inside ``scratch_scope`` they go when it ends.
    """
    out: dict[str, DataFrame] = {}
    for e in SYSTEMS[system]:
        docs = cut_lineage(read_documents(spark, f"{folder}/{e.file}", multiline), "documents")
        if e.nested is not None:
            n = e.nested
            own = F.lit(extracted_at.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")) if n.own_time else None
            id_name = BASE_MODELS[n.obj][0]
            out[n.obj] = unfurl(docs, n.array, n.parent_keys, (id_name, n.id_parts), own)[1]
            docs = without_field(docs, n.array)
        out[e.obj] = docs
    return out


def ingest(
    spark: SparkSession,
    system: str,
    folder: str,
    raw_folder: str,
    extracted_at: dt.datetime,
    run_id: str | None = None,
    truncate_first: bool = False,
    multiline: bool = False,
) -> str:
    """Land every object of a source system under ``raw_folder`` and return the run id.

    What is not a document goes to the table ``rejects`` with its text (``rejected`` counts them by run and object);
    with ``multiline`` a bad file stops the run with an error.
    """
    run = run_id or new_run_id()
    with scratch_scope(spark):
        for obj, docs in extract_objects(spark, system, folder, extracted_at, multiline).items():
            raw = stamp(docs, system, obj, run, BASE_MODELS[obj][0], extracted_at)
            land(raw, f"{raw_folder}/{raw_table(system, obj, schema='')}", truncate_first)
            if "reject" in docs.columns:
                land(rejects(docs, system, obj, run, extracted_at), f"{raw_folder}/{REJECTS}")
    return run


def ingest_committed(
    log: CommitLog,
    system: str,
    folder: str,
    extracted_at: dt.datetime,
    run_id: str,
    truncate_first: bool = False,
    multiline: bool = False,
) -> int:
    """Like :func:`ingest` for a commit log: all objects of the run, and its rejects, become visible in one step.

    A run id that is in the log is not read again, so a run may be repeated after a failure at any point. Rejects are only added.
    """

    def make() -> dict[str, DataFrame]:
        out: dict[str, DataFrame] = {}
        for obj, docs in extract_objects(log.spark, system, folder, extracted_at, multiline).items():
            out[raw_table(system, obj, schema="")] = stamp(docs, system, obj, run_id, BASE_MODELS[obj][0], extracted_at)
            if "reject" in docs.columns:
                bad = rejects(docs, system, obj, run_id, extracted_at)
                out[REJECTS] = out[REJECTS].unionByName(bad) if REJECTS in out else bad
        return out

    if (done := log.committed(run_id)) is not None:
        return done
    with scratch_scope(log.spark):
        tables = make()
        staged = [e for table, df in tables.items() for e in log.stage(df, table)]
    return log.commit(run_id, staged, replace_tables=[t for t in tables if t != REJECTS] if truncate_first else ())


def committed_tables(log: CommitLog, systems: Sequence[str] = tuple(SYSTEMS), version: int | None = None) -> Mapping[str, DataFrame]:
    """Source object -> committed rows, all of one version of the log."""
    version = log.state().version if version is None else version
    return {
        obj: log.read(raw_table(system, obj, schema=""), version)
        for system in systems
        for e in SYSTEMS[system]
        for obj in (e.obj, *([e.nested.obj] if e.nested else []))
    }


def rejected(spark: SparkSession, raw_folder: str) -> DataFrame:
    """Number of rejects of each run and source object."""
    return spark.read.parquet(f"{raw_folder}/{REJECTS}").groupBy("_run_id", "_source_system", "_source_object").count()


def raw_tables(
    spark: SparkSession, raw_folder: str, systems: Sequence[str] = tuple(SYSTEMS)
) -> Mapping[str, DataFrame]:
    """Source object -> landed rows."""
    return {
        obj: spark.read.parquet(f"{raw_folder}/{raw_table(system, obj, schema='')}")
        for system in systems
        for e in SYSTEMS[system]
        for obj in (e.obj, *([e.nested.obj] if e.nested else []))
    }
