"""Compare two versions of a relation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _and(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def _or(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def reconcile(extract: DataFrame, warehouse: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that only one side has: ``missing`` in the warehouse, or ``extra`` there (deleted at source).

    Implemented as one aggregate over the tagged union. Map-side combining keeps repeated keys out of
    the shuffle, and null keys compare like values.
    """
    tag = lambda df, e: df.select(*keys, F.lit(e).alias("_e"), F.lit(not e).alias("_w"))
    sides = tag(extract, True).unionByName(tag(warehouse, False))
    flags = sides.groupBy(*keys).agg(F.bool_or("_e").alias("_e"), F.bool_or("_w").alias("_w"))
    status = F.when(F.col("_e"), "missing").otherwise("extra")
    return flags.where("_e <> _w").select(*keys, status.alias("status"))


def mark_deleted(warehouse: DataFrame, extract: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Warehouse rows with ``is_deleted`` set where a full extract no longer has the key."""
    present = extract.select(*keys).distinct().withColumn("_present", F.lit(True))
    w, p = warehouse.alias("w"), present.alias("p")
    cond = _and([F.col(f"w.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys])
    return w.join(p, cond, "left").select("w.*", F.col("p._present").isNull().alias("is_deleted"))


def restate(
    published: DataFrame,
    rebuilt: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    restated_at: dt.datetime,
    reason: str,
) -> DataFrame:
    """Rows of the rebuilt mart that differ from the published version, tagged with time and reason.

    ``change`` is added, removed or changed; old values carry the prefix ``old_``. Nulls compare as
    values, so null to null is no change.
    """
    o, n = (df.select(*keys, *values, F.lit(True).alias("_in")) for df in (published, rebuilt))
    o, n = o.alias("o"), n.alias("n")
    cond = _and([F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    differs = _or([~F.col(f"o.{v}").eqNullSafe(F.col(f"n.{v}")) for v in values])
    change = (
        F.when(F.col("o._in").isNull(), "added").when(F.col("n._in").isNull(), "removed").when(differs, "changed")
    )
    return (
        o.join(n, cond, "full_outer")
        .select(
            *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in keys],
            change.alias("change"),
            *[F.col(f"o.{v}").alias(f"old_{v}") for v in values],
            *[F.col(f"n.{v}").alias(v) for v in values],
        )
        .where("change is not null")
        .withColumns(
            {"restated_at_utc": F.lit(restated_at).cast("timestamp"), "restatement_reason": F.lit(reason)}
        )
    )
