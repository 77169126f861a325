"""Supersession after hard deletes: versions and deletion events replayed into validity intervals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.operators.reconcile import mark_deleted
from hrflow.operators.windows import next_in_group


def deletions(warehouse: DataFrame, extract: DataFrame, keys: Sequence[str], detected_at: dt.datetime, at: str) -> DataFrame:
    """Deletion events (``keys`` and time ``at``) of the warehouse keys that a full extract no longer has."""
    gone = mark_deleted(warehouse.select(*keys).distinct(), extract, keys).where("is_deleted")
    return gone.select(*keys, F.lit(detected_at).cast("timestamp").alias(at))


def replay(versions: DataFrame, events: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """``versions`` with valid_from, valid_to, closed_by (``version``, ``deletion`` or null) and is_active.

    A version holds from its time until the next version or deletion event of its key; what comes after a deletion opens anew. A deletion
    at the very time of a version closes it at once. ``versions`` must have one row a key and time. Deletions
    without a version before them change nothing. Times must not be null.

    Only narrow rows, one for each key and time, are put in order, in buckets of a day, so neither payloads nor all versions of
    a frequent key meet in one task.
    """
    v, e = (df.select(*keys, at, F.lit(gone).alias("_gone")) for df, gone in ((versions, False), (events, True)))
    moments = v.unionByName(e).groupBy(*keys, at).agg(F.bool_or("_gone").alias("_gone"))
    ordered = next_in_group(moments, keys, at, [], "_next", bucket="day")
    gone = F.struct(*keys, F.col(at).alias("_t"))
    closers = moments.where("_gone").select(gone.alias("_c"), F.lit(True).alias("_deleted"))
    ordered = ordered.withColumn("_c", F.struct(*keys, F.when(F.col("_gone"), F.col(at)).otherwise(F.col("_next")).alias("_t")))
    ordered = ordered.join(closers, "_c", "left")
    spans = ordered.select(F.struct(*keys, at).alias("_k"), F.col("_c._t").alias("valid_to"), F.coalesce("_deleted", F.lit(False)).alias("_deleted"))
    return (
        versions.withColumn("_k", F.struct(*keys, at))
        .join(spans, "_k")
        .withColumns(
            {
                "valid_from": F.col(at),
                "closed_by": F.when(F.col("valid_to").isNull(), None).when(F.col("_deleted"), "deletion").otherwise("version"),
                "is_active": F.col("valid_to").isNull(),
            }
        )
        .drop("_k", "_deleted")
    )


def mark_inactive(rows: DataFrame, replayed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dimension or bridge rows with is_active and inactive_since, by the replayed versions of their keys; facts need none of it.

    A key is active if its last version still holds. Rows whose key has no version are active. Replayed versions are reduced to one
    row a key before the join.
    """
    last = replayed.groupBy(*keys).agg(F.bool_or("is_active").alias("_active"), F.max("valid_to").alias("_until"))
    last = last.select(F.struct(*keys).alias("_k"), "_active", "_until")
    active = F.coalesce("_active", F.lit(True))
    joined = rows.withColumn("_k", F.struct(*[F.col(k) for k in keys])).join(last, "_k", "left")
    return joined.withColumns({"is_active": active, "inactive_since": F.when(~active, F.col("_until"))}).drop("_k", "_active", "_until")
