"""Nearest-date join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_by_date(
    left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str, tie: str
) -> DataFrame:
    """Left join that attaches to each left row the right row of the same key with the closest date.

    Adds ``tie`` and ``right_date`` of the match. Equal distances go to the smaller ``tie``; a missing
    date on either side counts as the largest distance. Left rows without any partner keep nulls.

    Both sides are reduced to one row per key and day, then the closest day before and the closest day
    after are read off a sorted pass. No pair of a left and a right row is ever formed, so a key with
    many rows on both sides costs its number of days, not the product.
    """
    match = F.struct(F.col(tie), F.col(right_date))
    stops = (
        right.where(F.col(key).isNotNull())
        .groupBy(key, F.col(right_date).cast("date").alias("_day"))
        .agg(F.min(match).alias("_stop"))
        .withColumn("_asked", F.lit(False))
    )
    probes = (
        left.select(key, F.to_date(left_date).alias("_day"))
        .where(F.col(key).isNotNull())
        .distinct()
        .withColumn("_asked", F.lit(True))
    )
    points = stops.unionByName(probes, allowMissingColumns=True)
    whole = Window.partitionBy(key)
    dated = F.when(F.col("_day").isNotNull(), F.col("_stop"))
    # On equal days the stop comes first and is found at distance zero. The closest later day is read in
    # descending order: a frame that ends at the last row would be evaluated anew for every row.
    so_far = (Window.unboundedPreceding, 0)
    upwards = whole.orderBy(F.col("_day").asc_nulls_last(), "_asked").rowsBetween(*so_far)
    downwards = whole.orderBy(F.col("_day").desc_nulls_last(), "_asked").rowsBetween(*so_far)
    before, after = (F.last(dated, ignorenulls=True).over(w) for w in (upwards, downwards))
    found = points.withColumns(
        {
            "_before": before,
            "_after": after,
            # Distance unknown for every candidate: the smallest tie value wins.
            "_any": F.min("_stop").over(whole),
        }
    ).where("_asked")

    def ranked(name: str):
        distance = F.abs(F.datediff(F.col(f"{name}.{right_date}"), F.col("_day")))
        return F.when(
            F.col(name).isNotNull(), F.struct(distance.alias("distance"), F.col(name).alias("match"))
        )

    best = F.array_min(F.array_compact(F.array(ranked("_before"), ranked("_after"))))["match"]
    chosen = F.when(F.col("_day").isNotNull(), F.coalesce(best, F.col("_any"))).otherwise(F.col("_any"))
    found = found.withColumn("_match", chosen)
    found = found.select(
        F.col(key).alias("_key"),
        "_day",
        F.col(f"_match.{tie}").alias(tie),
        F.col(f"_match.{right_date}").alias(right_date),
    )
    asked_day = F.to_date(left_date)
    return left.join(
        found, (F.col(key) == F.col("_key")) & asked_day.eqNullSafe(F.col("_day")), "left"
    ).drop("_key", "_day")
