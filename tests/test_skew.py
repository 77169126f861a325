"""Groups that own a third of all rows are shared by several tasks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hrflow.operators.hierarchy import manager_chain
from hrflow.operators.windows import next_in_group
from tests.helpers import plan

# Makes a few thousand rows look like a large shuffle.
TINY = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def tiny(spark):
    old = {k: spark.conf.get(k, None) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_busy_manager_is_split_by_adaptive_execution(tiny):
    n = 20_000
    name = lambda c: F.md5(c.cast("string"))
    # Worker 1 manages a third of the company, 0 manages the managers.
    boss = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2)
    snap = tiny.range(2, n).select(
        F.lit(dt.date(2024, 1, 1)).alias("snapshot_date"),
        name(F.col("id")).alias("employee_key"),
        name(F.when(F.col("id") < 502, F.lit(1)).otherwise(boss)).alias("manager_employee_key"),
    )
    top = tiny.range(1).select(
        F.lit(dt.date(2024, 1, 1)).alias("snapshot_date"),
        name(F.lit(1)).alias("employee_key"),
        name(F.lit(0)).alias("manager_employee_key"),
    )
    chain = manager_chain(snap.unionByName(top))
    rows = chain.groupBy("depth").count().collect()
    counts = {r["depth"]: r["count"] for r in rows}
    direct_of_1 = snap.where(F.col("manager_employee_key") == name(F.lit(1))).count()
    assert counts[1] == n - 1 and counts[2] == n - 2 and counts[3] == n - 2 - direct_of_1
    chain.write.format("noop").mode("overwrite").save()
    chain.collect()
    assert "skew=true" in plan(chain)


def test_busy_application_is_spread_over_buckets(tiny):
    df = tiny.range(30_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("at"),
    )
    out = next_in_group(df, ["k"], "at", ["id"], "nxt")
    gaps = out.where("k = 'hot' and nxt is not null").select((F.unix_micros("nxt") - F.unix_micros("at")).alias("g"))
    assert gaps.distinct().collect()[0].g == 3_000_000 and gaps.count() == 9_999
    # The widest window group is a minute of one application.
    widest = df.groupBy("k", F.date_trunc("minute", "at")).count().agg(F.max("count")).first()[0]
    assert widest == 20
