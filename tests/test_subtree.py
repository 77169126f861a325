"""Subtree labels against the manager chain and against walks over the rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from tests.helpers import rows

from hrflow.operators.hierarchy import manager_chain, org_size
from hrflow.operators.subtree import managers_below, org_size_by_labels, subtree_labels

DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
SCHEMA = "snapshot_date date, employee_key string, manager_employee_key string"


def forest(seed: int, n: int = 300, hot: int = 100):
    """Random trees on two days, a manager with ``hot`` reports, a manager who is not there, repeated rows."""
    rng = random.Random(seed)
    out = []
    for day in DAYS:
        out += [(day, f"e{i}", f"e{rng.randrange(max(0, i - 40), i)}" if i > 2 else None) for i in range(n)]
        out += [(day, f"h{i}", "e5") for i in range(hot)] + [(day, f"below-h{i}", f"h{i}") for i in range(0, hot, 2)]
        out += [(day, "lone", "away"), (day, "e9", None)]
    return out + out[10:20]


def below(data):
    """{(day, manager): (direct, all employees below)} by walking down."""
    reports = {}
    for day, e, m in data:
        if e is not None and m is not None:
            reports.setdefault((day, m), set()).add(e)
    out = {}
    for (day, m), direct in reports.items():
        seen, todo = set(), list(direct)
        while todo:
            e = todo.pop()
            if e not in seen:
                seen.add(e)
                todo += reports.get((day, e), ())
        out[day, m] = (direct, seen)
    return out


def sizes(df):
    return {(r.snapshot_date, r.manager_employee_key): (r.direct_reports, r.total_org_size) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_sizes_equal_walks_and_chain(spark, seed):
    data = forest(seed)
    snap = spark.createDataFrame(data, SCHEMA)
    got = sizes(org_size_by_labels(snap))
    assert got == {k: (len(a), len(b)) for k, (a, b) in below(data).items()}
    assert got == sizes(org_size(manager_chain(snap)))
    assert subtree_labels(snap).where("high is null").count() == 0


def test_ranges_are_subtrees(spark):
    data = forest(4, n=80, hot=20)
    labels = subtree_labels(spark.createDataFrame(data, SCHEMA)).cache()
    asked = labels.where("manager_employee_key in ('e0', 'e1', 'e5', 'h2', 'away')")
    got = {}
    for r in managers_below(labels, asked).collect():
        got.setdefault((r.snapshot_date, r.manager_employee_key), []).append(r.below)
    under = below(data)
    want = {k: sorted({k[1]} | {e for e in under[k][1] if (k[0], e) in under}) for k in under if k[1] in ("e0", "e1", "e5", "h2", "away")}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_cycles_and_several_managers_fall_back_to_the_chain(spark):
    data = forest(3, n=60, hot=10)
    day = DAYS[0]
    data += [(day, "x", "y"), (day, "y", "z"), (day, "z", "x"), (day, "under-x", "x"), (day, "self", "self")]  # cycles
    data += [(day, "e50", "e3"), (day, "h1", "h0"), (day, "twice", "h2"), (day, "twice", "h4")]  # several managers
    snap = spark.createDataFrame(data, SCHEMA)
    labels = {(r.snapshot_date, r.manager_employee_key): r for r in subtree_labels(snap).collect()}
    for m in ("x", "y", "z", "self", "h2", "e5"):
        assert labels[day, m].high is None and labels[day, m].tree is None and labels[day, m].total_org_size is None
    assert all(r.high is not None for k, r in labels.items() if k[0] != day)
    under = below(data)
    assert all(r.total_org_size == len(under[k][1]) for k, r in labels.items() if r.high is not None)
    got = sizes(org_size_by_labels(snap))
    assert got == sizes(org_size(manager_chain(snap))) == {k: (len(a), len(b)) for k, (a, b) in under.items()}


def test_depth_is_not_limited(spark):
    data = [(DAYS[0], f"e{i}", f"e{i - 1}") for i in range(1, 70)]
    got = sizes(org_size_by_labels(spark.createDataFrame(data, SCHEMA)))
    assert got == {(DAYS[0], f"e{i}"): (1, 69 - i) for i in range(69)}


def test_nulls_and_nothing(spark):
    data = [(None, "a", "b"), (DAYS[0], None, "b"), (DAYS[0], "c", None), (DAYS[0], "d", "")]
    labels = subtree_labels(spark.createDataFrame(data, SCHEMA))
    assert rows(labels.select("manager_employee_key", "tree", "low", "high", "total_org_size")) == [("", "", 1, 1, 1)]
    assert org_size_by_labels(spark.createDataFrame([], SCHEMA)).count() == 0
