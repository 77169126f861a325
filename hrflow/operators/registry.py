"""The source-to-person registry as a stored table in buckets, of which a merge rewrites those it touches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.operators.identity import REGISTRY_KEYS, upsert_registry
from hrflow.operators.storage import cut_lineage
from hrflow.sources.commits import CommitLog

REGISTRY = "bridge_person_source"
SCHEMA = """bridge_person_source_key string, source_system string, source_object string, source_record_id string, person_key string,
    match_method string, match_confidence double, created_at_utc timestamp, updated_at_utc timestamp"""
BUCKET = "_bucket"


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Adds the bucket of the registry keys; its text also names the number of buckets, which is the table's for good."""
    place = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in REGISTRY_KEYS]), F.lit(buckets))
    return df.withColumn(BUCKET, F.concat(F.lit(f"{buckets}-"), place.cast("string")))


def read_registry(log: CommitLog, version: int | None = None) -> DataFrame:
    """The registry as of a version of the log, by default now; empty before the first merge."""
    return log.read(REGISTRY, version, schema=f"{SCHEMA}, {BUCKET} string").drop(BUCKET)


def merge_registry(log: CommitLog, matches: DataFrame, now: dt.datetime, run_id: str, buckets: int = 256) -> int:
    """Merge resolved matches (see ``upsert_registry``) into the stored registry; the new version of the log.

    Copy on write: the buckets in which ``matches`` has a key are read, merged and written anew; the files of all others stay and are
    not read. ``buckets`` should keep a bucket to some hundred megabytes; it may not change. The driver learns the names of touched
    buckets, at most ``buckets`` of them. A run id that has been committed changes nothing. Another merge that rewrote one of
    the same buckets meanwhile raises ``Conflict``; merges of different buckets pass.
    """
    done = log.committed(run_id)
    if done is not None:
        return done
    state = log.state()
    stored = state.entries.get(REGISTRY, [])
    if any(not e.part.startswith(f"{buckets}-") for e in stored):
        raise ValueError(f"the registry has {stored[0].part.split('-')[0]} buckets")
    pinned = cut_lineage(_bucketed(matches, buckets), "matches")
    touched = {r[0] for r in pinned.select(BUCKET).distinct().collect()}
    old = [e for e in stored if e.part in touched]
    current = log.read(REGISTRY, state.version, touched, f"{SCHEMA}, {BUCKET} string") if old else None
    before = current.drop(BUCKET) if old else log.spark.createDataFrame([], SCHEMA)
    merged = upsert_registry(before, pinned.drop(BUCKET), now)
    return log.commit(run_id, log.stage(_bucketed(merged, buckets), REGISTRY, by=BUCKET), remove=old, since=state.version)
