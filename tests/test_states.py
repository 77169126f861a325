"""Mergeable states against the rows they stand for."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hrflow.operators.snapshot import explode_days
from hrflow.operators.states import (
    dense_ids,
    distinct_count,
    distinct_state,
    distinct_state_by_day,
    merge_distinct,
    merge_values,
    state_quantiles,
    value_state,
)
from tests.helpers import plan

DAY = dt.date(2024, 1, 1)


def month():
    return F.trunc("day", "month").alias("month")


@pytest.fixture(scope="module")
def visits(spark):
    """70,000 keys, so that ids fill three bitmaps; one slice holds a third of the rows; null keys and slices."""
    rng = random.Random(3)
    rows = [(DAY + dt.timedelta(rng.randrange(70)), rng.choice(["hot", "hot", "a", "b", "c", None]), f"k{rng.randrange(70_000)}") for _ in range(20_000)]
    rows += [(DAY, "a", None), (DAY, "a", "k1"), (DAY, "a", "k1")]
    rows += [(DAY, "all", f"k{i}") for i in range(70_000)]
    return spark.createDataFrame(rows, "day date, slice string, k string").cache()


def test_ids_are_dense_and_stay(spark, visits):
    ids = dense_ids(visits, "k").cache()
    assert sorted(r.id for r in ids.collect()) == list(range(1, 70_001))
    more = spark.createDataFrame([("new1",), ("k5",), ("new2",), (None,), ("new1",)], "k string")
    grown = {r.k: r.id for r in dense_ids(more, "k", ids).collect()}
    assert {k: grown[k] for k in ("new1", "new2")}.keys() and {grown["new1"], grown["new2"]} == {70_001, 70_002}
    assert all(grown[r.k] == r.id for r in ids.collect()) and len(grown) == 70_002


def test_first_keys_of_an_empty_numbering(spark):
    none = spark.createDataFrame([], "k string, id int")
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    assert sorted(r.id for r in dense_ids(keys, "k", none).collect()) == [1, 2]
    assert dense_ids(keys.limit(0), "k").count() == 0


def test_distinct_of_months_from_days(spark, visits):
    daily = distinct_state(visits.join(dense_ids(visits, "k"), "k", "left"), ["day", "slice"]).cache()
    assert daily.where("slice = 'all'").count() == 3
    months = merge_distinct(daily, [month(), "slice"])
    got = {(r.month, r.slice): r.n for r in distinct_count(months, ["month", "slice"]).collect()}
    want = visits.groupBy(month(), "slice").agg(F.countDistinct("k").alias("n")).collect()
    assert got == {(r.month, r.slice): r.n for r in want}
    assert distinct_count(merge_distinct(months, []), []).first().n == 70_000


def test_distinct_of_nothing(spark, visits):
    empty = visits.limit(0).withColumn("id", F.lit(1))
    assert distinct_count(distinct_state(empty, ["day"]), ["day"]).count() == 0


@pytest.fixture(scope="module")
def amounts(spark):
    rng = random.Random(5)
    rows = [(DAY + dt.timedelta(rng.randrange(70)), rng.choice("ab"), rng.choice([3, 3, 3, rng.randrange(-50, 400)]), rng.lognormvariate(3, 4)) for _ in range(5_000)]
    rows += [(DAY, "a", None, None), (DAY, "a", 7, math.nan), (DAY, "b", 7, math.inf), (DAY, "z", 0, 0.0), (DAY, "z", 1, -2.5)]
    return spark.createDataFrame(rows, "day date, slice string, days int, pay double").cache()


def test_exact_quantiles_of_months_from_days(spark, amounts):
    state = merge_values(value_state(amounts, ["day", "slice"], "days"), [month(), "slice"])
    got = state_quantiles(state, ["month", "slice"], {"p50": 0.5, "p90": 0.9}).collect()
    want = amounts.groupBy(month(), "slice").agg(F.count("days").alias("n"), F.percentile("days", F.lit(0.5)).alias("p50"), F.percentile("days", F.lit(0.9)).alias("p90"))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("error", [0.2, 0.01, 0.001])
def test_sketched_quantiles_keep_their_error(spark, amounts, error):
    points = {"p1": 0.01, "p50": 0.5, "p99": 0.99}
    state = merge_values(value_state(amounts, ["day", "slice"], "pay", error), [month(), "slice"])
    assert state.count() <= amounts.count()
    for r in state_quantiles(state, ["month", "slice"], points).where("slice <> 'z'").collect():
        pays = [x.pay for x in amounts.where((F.col("slice") == r.slice) & (F.trunc("day", "month") == r.month)).collect()]
        pays = [x for x in pays if x is not None and math.isfinite(x)]
        assert r.n == len(pays)
        for name, q in points.items():
            assert r[name] == pytest.approx(np.quantile(pays, q), rel=error * (1 + 1e-9))


def test_zero_and_negative_values(spark, amounts):
    state = value_state(amounts.where("slice = 'z'"), ["slice"], "pay", 0.01)
    values = sorted(r.value for r in state.collect())
    assert values[1] == 0.0 and values[0] == pytest.approx(-2.5, rel=0.01)
    with pytest.raises(ValueError):
        value_state(amounts, [], "pay", 0.0)


def test_days_of_intervals_make_the_state_of_their_rows(spark):
    rng = random.Random(5)
    rows = [(0, "a", DAY, DAY - dt.timedelta(1)), (None, "a", DAY, DAY), (7, None, dt.date(1969, 12, 1), dt.date(1970, 2, 3)), (7, "b", DAY, None)]
    for _ in range(300):
        first = DAY + dt.timedelta(rng.randrange(400))
        rows.append((rng.randrange(70_000), rng.choice(["a", "b", None]), first, first + dt.timedelta(rng.choice([0, 1, 30, 31, 32, 33, 200, rng.randrange(150)]))))
    held = spark.createDataFrame(rows + rows[-5:], "id int, slice string, from_date date, to_date date")
    want = distinct_state(explode_days(held.where("from_date <= to_date")), ["snapshot_date", "slice"])
    got = distinct_state_by_day(held, ["slice"], "snapshot_date")
    state = lambda df: {(r.snapshot_date, r.slice, r.block): bytes(r.bits) for r in df.collect()}
    assert got.count() == want.count() and state(got) == state(want)
    # Narrow rows are dealt once; neither bitmaps nor rows of a day go over the network.
    assert plan(got.select("*")).count("Exchange hashpartitioning") == 1
