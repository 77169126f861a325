"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Written as ``row_number() = 1`` so that Catalyst adds a ``WindowGroupLimit`` below the exchange:
    every task forwards at most one row per key, hence a key that owns a third of all rows costs one
    row per task in the shuffle. ``order`` should end in a unique column to fix the survivor of a tie.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def latest_record(raw: DataFrame) -> DataFrame:
    """Newest landed version per source record id (landing metadata columns)."""
    return latest(
        raw,
        ["_source_record_id"],
        [
            F.col("_source_updated_at").desc_nulls_last(),
            F.col("_ingested_at_utc").desc_nulls_last(),
            F.col("_payload_hash").desc_nulls_last(),
        ],
    )


def latest_version(versions: DataFrame, tie: str = "profile_version_id") -> DataFrame:
    """One profile version per worker and effective date, the most recently updated one."""
    return latest(
        versions,
        ["worker_id", "effective_date"],
        [
            F.col("source_updated_at").desc_nulls_last(),
            F.col("ingested_at_utc").desc_nulls_last(),
            F.col(tie).desc_nulls_last(),
        ],
    )
