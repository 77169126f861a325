"""Ordered window results for large groups.

A plain ``lead`` or ``row_number`` puts a whole group into one task. The two functions here cut each
group along its sort order into buckets, work inside the buckets, and carry values across bucket borders
through a summary with one row per group and bucket. A group that holds a third of the table is thus
spread over as many tasks as it has buckets. A bucket stays in one task: rows of a group that fall into one
bucket, for example the same minute or a null timestamp, are not split further.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    """Null-safe equality of the named columns of two aliased sides (nulls form a group of their own)."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    )


def next_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie: Sequence[str],
    out: str,
    bucket: str = "minute",
) -> DataFrame:
    """Add ``out``, the next value of timestamp ``order_col`` in the group; null on the last row.

    Buckets are calendar units of ``order_col``, so the summary of one group has at most as many rows
    as its time range has units. Rows with a null timestamp sort last.
    """
    df = df.withColumn("_bucket", F.date_trunc(bucket, F.col(order_col)))
    part = [*keys, "_bucket"]
    inside = F.lead(order_col).over(
        Window.partitionBy(*part).orderBy(F.col(order_col).asc_nulls_last(), *tie)
    )
    heads = (
        df.where(F.col(order_col).isNotNull())
        .groupBy(*part)
        .agg(F.min(order_col).alias("_head"))
        .withColumn("_next_head", F.lead("_head").over(Window.partitionBy(*keys).orderBy("_bucket")))
        .where(F.col("_next_head").isNotNull())
    )
    return (
        df.withColumn("_inside", inside)
        .alias("d")
        .join(heads.alias("h"), _same("d", "h", part), "left")
        .select("d.*", F.coalesce("d._inside", "h._next_head").alias(out))
        .drop("_bucket", "_inside")
    )


def number_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], buckets: Sequence[Column], out: str
) -> DataFrame:
    """Add ``out``, the 1-based row number inside the group.

    ``buckets`` must be non-decreasing along ``order`` (for example the sort date plus a prefix of a
    hashed tie-break). Row number = rows of earlier buckets + row number inside the bucket.
    """
    names = [f"_b{i}" for i in range(len(buckets))]
    df = df.withColumns(dict(zip(names, buckets)))
    part = [*keys, *names]
    running = (
        Window.partitionBy(*keys)
        .orderBy(*[F.col(n).asc_nulls_last() for n in names])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0))).drop("_n")
    return (
        df.withColumn("_inside", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
        .alias("d")
        .join(offsets.alias("o"), _same("d", "o", part), "left")
        .select("d.*", (F.col("d._inside") + F.col("o._before")).cast("int").alias(out))
        .drop(*names, "_inside")
    )
