"""Append-only landing of source records."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.functions import iso_timestamp
from hrflow.sources.documents import canonical_json, field_text, typed_text

METADATA_COLUMNS = (
    "_ingested_at_utc",
    "_source_system",
    "_source_object",
    "_run_id",
    "_extract_mode",
    "_source_record_id",
    "_source_updated_at",
    "_payload_hash",
    "raw_payload",
)


def new_run_id() -> str:
    """Identifier shared by all rows of one extraction."""
    return str(uuid.uuid4())


def raw_table(system: str, obj: str, schema: str = "raw") -> str:
    """Name of the raw table of a source object."""
    name = f"{system}__{obj}"
    return f"{schema}.{name}" if schema else name


def payload_json(df: DataFrame) -> Column:
    """The whole record as JSON text, nulls included."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})


def stamp(
    docs: DataFrame,
    system: str,
    obj: str,
    run_id: str,
    id_field: str,
    ingested_at: dt.datetime,
    mode: str = "full",
    updated_field: str | None = "source_updated_at",
) -> DataFrame:
    """Raw rows for documents (``doc map<string,variant>``): eight metadata columns plus the payload with every field.

    Rows of typed columns (no column ``doc``) give the same payload and hash as their documents, without becoming ones. Rejects are left out; :func:`rejects` has them. A missing id becomes
    the empty string, which ``check_not_null(..., empty=True)`` finds. Payload and hash have the keys in order, so
    they do not depend on the column order.
    """
    if "doc" in docs.columns:
        docs = docs.where(F.col("doc").isNotNull())
        keys = F.sort_array(F.map_keys("doc"))
        ordered = F.map_from_arrays(keys, F.transform(keys, lambda k: F.col("doc")[k]))
        text, field = F.to_json(ordered, {"ignoreNullFields": "false"}), field_text
    else:
        text, field = canonical_json(docs.schema), lambda name: typed_text(docs.schema, name)
    flat = docs.select(
        field(id_field).alias("_id"),
        (field(updated_field) if updated_field else F.lit(None).cast("string")).alias("_updated"),
        text.alias("raw_payload"),
    )
    return flat.select(
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at_utc"),
        F.lit(system).alias("_source_system"),
        F.lit(obj).alias("_source_object"),
        F.lit(run_id).alias("_run_id"),
        F.lit(mode).alias("_extract_mode"),
        F.coalesce("_id", F.lit("")).alias("_source_record_id"),
        iso_timestamp("_updated").alias("_source_updated_at"),
        F.sha2("raw_payload", 256).alias("_payload_hash"),
        "raw_payload",
    )


def rejects(docs: DataFrame, system: str, obj: str, run_id: str, ingested_at: dt.datetime) -> DataFrame:
    """The text of what was not a document, with the metadata of the run."""
    return docs.where(F.col("reject").isNotNull()).select(
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at_utc"),
        F.lit(system).alias("_source_system"),
        F.lit(obj).alias("_source_object"),
        F.lit(run_id).alias("_run_id"),
        F.col("reject").alias("raw_text"),
    )


def land(raw: DataFrame, path: str, truncate_first: bool = False) -> None:
    """Append stamped rows to a raw table's folder, or replace its content."""
    raw.write.mode("overwrite" if truncate_first else "append").parquet(path)


def land_table(raw: DataFrame, table: str, truncate_first: bool = False) -> None:
    """Like :func:`land` for a catalog table, which is created on first use."""
    schema, _, _ = table.rpartition(".")
    if schema:
        raw.sparkSession.sql(f"create schema if not exists {schema}")
    raw.write.mode("overwrite" if truncate_first else "append").format("parquet").saveAsTable(table)


def only_changed(raw_new: DataFrame, raw_existing: DataFrame) -> DataFrame:
    """New rows whose payload differs from the newest landed version of the record, each payload once.

    The newest hash per record is an aggregate with map-side combining, not a window over all versions.
    """
    newest = raw_existing.groupBy("_source_record_id").agg(
        F.max(F.struct("_source_updated_at", "_ingested_at_utc", "_payload_hash"))["_payload_hash"].alias(
            "_payload_hash"
        )
    )
    changed = raw_new.join(newest, ["_source_record_id", "_payload_hash"], "left_anti")
    return changed.dropDuplicates(["_source_record_id", "_payload_hash"])


def since_watermark(df: DataFrame, updated_col: str, mark: dt.datetime | None) -> DataFrame:
    """Records updated after the stored mark; everything when there is none yet.

    Records without an update time are read each time: whether they have changed is for ``only_changed`` to tell.
    """
    if mark is None:
        return df
    return df.where(F.col(updated_col).isNull() | (F.col(updated_col) > F.lit(mark).cast(df.schema[updated_col].dataType)))


def next_watermark(df: DataFrame, updated_col: str) -> DataFrame:
    """One row with the mark to store after a load."""
    return df.agg(F.max(updated_col).alias("watermark"))


def audit_trace(rows: DataFrame, raw: DataFrame, id_col: str = "worker_id") -> DataFrame:
    """Raw versions behind dimension rows, oldest load first within each record.

    Records are not sorted among each other, which would send every payload through one more shuffle.
    """
    d, r = rows.alias("d"), raw.alias("r")
    return (
        d.join(r, F.col(f"d.{id_col}") == F.col("r._source_record_id"))
        .select(
            F.col(f"d.{id_col}").alias(f"dim_{id_col}"),
            F.col("d.ingested_run_id").alias("dim_run_id"),
            "r._ingested_at_utc",
            F.col("r._run_id").alias("raw_run_id"),
            "r._payload_hash",
            "r._source_updated_at",
            "r.raw_payload",
        )
        .sortWithinPartitions(f"dim_{id_col}", F.col("_ingested_at_utc").asc_nulls_last(), "_payload_hash")
    )
