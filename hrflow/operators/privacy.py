"""Masking, erasure and small-group suppression."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Roles that see clear text, mask and tombstone texts.
CLEAR_ROLES = ("PA_PLATFORM_ADMIN", "PA_SENSITIVE_HR", "PA_AUDITOR")
MASK = "***"
ERASED_NAME = "ERASED"
ERASED_VALUE = "__ERASED__"

# Which columns carry which kind of personal data.
PII_TAGS = {
    "dim_employee": {"work_email": "email", "first_name": "name", "last_name": "name"},
    "dim_person": {"personal_email": "email"},
}

ERASURE_LOG_SCHEMA = T.StructType(
    [
        T.StructField("erasure_id", T.StringType(), False),
        T.StructField("ticket_id", T.StringType(), False),
        T.StructField("person_external_id", T.StringType(), False),
        T.StructField("executed_at", T.TimestampType(), False),
        T.StructField("executed_by", T.StringType(), False),
    ]
)


def mask_email(email: Column, role: str, strict: bool = False) -> Column:
    """First character and domain. Text without ``@`` passes unless ``strict`` hides it as well."""
    if role in CLEAR_ROLES:
        return email
    masked = F.regexp_replace(email, "(.{1}).*(@.*)", "$1" + MASK + "$2")
    if not strict:
        return masked
    return F.when(email.contains("@"), masked).when(email.isNotNull(), F.lit(MASK))


def mask_name(name: Column, role: str) -> Column:
    """First letter only."""
    return name if role in CLEAR_ROLES else F.concat(F.left(name, F.lit(1)), F.lit(MASK))


def apply_masks(df: DataFrame, tags: Mapping[str, str], role: str) -> DataFrame:
    """Mask every tagged column for a role."""
    masks = {"email": mask_email, "name": mask_name}
    return df.withColumns({c: masks[kind](F.col(c), role) for c, kind in tags.items()})


def _flag(df: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Adds ``_hit``: the row's value is in the id set."""
    marked = ids.select(F.col(id_column).alias("_id")).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(marked, F.col(column) == F.col("_id"), "left").drop("_id")
    return joined.withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def _replace(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(
        {c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in values.items()}
    ).drop("_hit")


def _placeholder(key: str) -> Column:
    return F.concat(F.lit("erased+"), F.col(key), F.lit("@example.invalid"))


def erase_person(
    tables: Mapping[str, DataFrame],
    requests: DataFrame,
    executed_at: dt.datetime,
    executed_by: str,
    scope: str = "default",
) -> dict[str, DataFrame]:
    """New versions of the tables in which the requested persons cannot be identified.

    ``requests`` has (person_external_id, ticket_id) and may hold many persons. Keys stay, so historical
    counts do not move. Names and e-mails in both dimensions become placeholders, landed worker and person
    rows disappear, and the log gains a row per person. A request for somebody without an employee record
    changes nothing and writes no log row. ``scope="all"`` also tombstones the payloads of every other
    raw table given, except those without a ``person_external_id``.
    """
    out = dict(tables)
    employees = tables["dim_employee"]
    found = requests.join(employees.select("person_external_id").distinct(), "person_external_id", "left_semi")
    ids = found.select("person_external_id").distinct()
    workers = employees.join(ids, "person_external_id", "left_semi").select("worker_id")

    erased = F.lit(ERASED_NAME)
    out["dim_person"] = _replace(
        _flag(tables["dim_person"], "person_external_id", ids, "person_external_id"),
        {"first_name": erased, "last_name": erased, "personal_email": _placeholder("person_key")},
    )
    out["dim_employee"] = _replace(
        _flag(employees, "person_external_id", ids, "person_external_id"),
        {"first_name": erased, "last_name": erased, "work_email": _placeholder("employee_key")},
    )
    for name, gone in (("raw_workers", workers.toDF("_id")), ("raw_persons", ids.toDF("_id"))):
        if name in tables:
            out[name] = tables[name].join(gone, F.col("_source_record_id") == F.col("_id"), "left_anti")
    if scope == "all":
        for name in tables:
            if name.startswith("raw_") and name not in ("raw_workers", "raw_persons"):
                out[name] = _tombstone_for(tables[name], ids)
    entry = found.select(
        F.md5(F.concat_ws("|", "ticket_id", "person_external_id")).alias("erasure_id"),
        "ticket_id",
        "person_external_id",
        F.lit(executed_at).cast("timestamp").alias("executed_at"),
        F.lit(executed_by).alias("executed_by"),
    )
    log = tables.get("erasure_log")
    out["erasure_log"] = entry if log is None else log.unionByName(entry)
    return out


# Payload fields that identify a person, and array fields that refer to one.
SENSITIVE_FIELDS = ("first_name", "last_name", "email", "work_email", "personal_email", "linkedin_url")
SENSITIVE_ARRAYS = ("worker_ids", "hired_worker_ids")


def tombstone(
    payload: Column,
    fields: Sequence[str] = SENSITIVE_FIELDS,
    arrays: Sequence[str] = SENSITIVE_ARRAYS,
) -> Column:
    """Same JSON object with sensitive scalars replaced and arrays emptied; the rest keeps value and type.

    Nulls stay null: they hold no personal data, and typed readers still see what they saw before.
    """
    erased = F.parse_json(F.lit(f'"{ERASED_VALUE}"'))
    empty = F.parse_json(F.lit("[]"))

    def value(k: Column, v: Column) -> Column:
        return (
            F.when(F.is_variant_null(v), v)
            .when(k.isin(list(fields)), erased)
            .when(k.isin(list(arrays)), empty)
            .otherwise(v)
        )

    return F.to_json(F.transform_values(F.from_json(payload, "map<string,variant>"), value))


def _tombstone_for(raw: DataFrame, ids: DataFrame) -> DataFrame:
    person = F.get_json_object("raw_payload", "$.person_external_id")
    flagged = _flag(raw.withColumn("_person", person), "_person", ids, "person_external_id")
    hit = F.col("_hit")
    return flagged.withColumns(
        {
            "raw_payload": F.when(hit, tombstone(F.col("raw_payload"))).otherwise(F.col("raw_payload")),
            "_is_erased": hit,
        }
    ).drop("_hit", "_person")


def _of_erased(landed: DataFrame, log: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """Adds ``_hit``: the row belongs to an erased person, by its record id or by a reference in its payload."""
    gone = log.select("person_external_id").distinct()
    kinds = {"person_external_id": ("persons", gone)}
    if aliases is not None:
        known = aliases.join(gone, "person_external_id", "left_semi")
        for column, obj in (("worker_id", "workers"), ("candidate_id", "candidates")):
            if column in aliases.columns:
                kinds[column] = (obj, known.where(F.col(column).isNotNull()))
    objects = F.col("_source_object") if "_source_object" in landed.columns else F.lit("persons")
    hits = F.lit(False)
    for column, (obj, ids) in kinds.items():
        own = F.when(objects == obj, F.col("_source_record_id"))
        landed = _flag(
            landed.withColumn("_ref", F.coalesce(F.get_json_object("raw_payload", f"$.{column}"), own)), "_ref", ids, column
        )
        landed = landed.withColumnRenamed("_hit", f"_hit_{column}").drop("_ref")
        hits = hits | F.col(f"_hit_{column}")
    return landed.withColumn("_hit", hits).drop(*[f"_hit_{c}" for c in kinds])


def guard_erased(
    landed: DataFrame, log: DataFrame, aliases: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split newly landed rows of any source object into (clean, blocked): blocked ones belong to persons already erased.

    A row belongs to the person whose id it or its payload has, and to the owner of the worker or candidate it is about.
    ``aliases`` (person_external_id, and worker_id or candidate_id or both) says who owns those ids; keys survive an
    erasure, so ``dim_employee`` and the candidate bridge still know.
    """
    flagged = _of_erased(landed, log, aliases)
    return flagged.where("not _hit").drop("_hit"), flagged.where("_hit").drop("_hit")


def tombstone_erased(landed: DataFrame, log: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """All landed rows; the payloads of those that :func:`guard_erased` would block become tombstones (``_is_erased``)."""
    flagged = _of_erased(landed, log, aliases)
    payload = F.when(F.col("_hit"), tombstone(F.col("raw_payload"))).otherwise(F.col("raw_payload"))
    return flagged.withColumns({"raw_payload": payload, "_is_erased": F.col("_hit")}).drop("_hit")


def stability_check(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups whose row count differs between two versions of a table."""
    tag = lambda df, b, a: df.select(*keys, F.lit(b).alias("_b"), F.lit(a).alias("_a"))
    return (
        tag(before, 1, 0)
        .unionByName(tag(after, 0, 1))
        .groupBy(*keys)
        .agg(F.sum("_b").alias("count_before"), F.sum("_a").alias("count_after"))
        .where("count_before <> count_after")
    )


def suppress_small(df: DataFrame, n_col: str, values: Sequence[str], k: int = 5) -> DataFrame:
    """Null out the values of groups below ``k`` members and say why; the group itself stays visible."""
    small = F.col(n_col) < k
    return df.withColumns(
        {
            **{v: F.when(~small, F.col(v)) for v in values},
            "suppressed_reason": F.when(small, F.lit("below_threshold")),
        }
    )


def retain(df: DataFrame, months: int, as_of: dt.date, column: str = "_ingested_at_utc") -> DataFrame:
    """Rows still inside the retention period at ``as_of``."""
    return df.where(F.col(column) >= F.add_months(F.lit(as_of), -months))
