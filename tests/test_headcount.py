from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hrflow.operators import hierarchy
from hrflow.operators.dedupe import latest_version
from hrflow.operators.hierarchy import (
    attrition_by_manager,
    manager_chain,
    manager_chain_intervals,
    org_pyramid,
    org_size,
    resolve_survivors,
    span_of_control,
    span_stats,
)
from hrflow.operators.snapshot import (
    active_intervals,
    daily_totals,
    exact,
    explode_days,
    last_day,
    last_snapshot,
    last_termination,
    person_days,
    snapshot_on,
    snapshot_periods,
    with_month,
)
from hrflow.plans import core
from hrflow.plans.marts import mart_workforce
from hrflow.operators.calendar import dim_date
from tests.helpers import d, events, plan, rows, versions, workers

START, END = dt.date(2024, 1, 1), dt.date(2024, 4, 30)


def random_org(rng, n=25):
    """Workers with versions and managers; about one link in ten goes to a later worker, so cycles occur."""
    w, v = [], []
    for i in range(n):
        hire = START + dt.timedelta(rng.randrange(-30, 60))
        term = hire + dt.timedelta(rng.randrange(0, 90)) if rng.random() < 0.4 else None
        w.append((f"W{i}", f"P{i // 2}", str(hire), term and str(term)))
        for off in sorted(rng.sample(range(0, 100), rng.randrange(1, 4))):
            boss = None if i == 0 or rng.random() < 0.05 else f"W{rng.randrange(n) if rng.random() < 0.1 else rng.randrange(i)}"
            kind = rng.choice(["full_time", "part_time", "contractor"])
            v.append((f"W{i}", str(hire + dt.timedelta(off)), boss, rng.choice(["A", "B"]), kind, rng.choice([1.0, 0.6, 0.1])))
    return w, v


def brute_snapshot(w, v, start, end):
    """Every day x version x episode, by definition."""
    by = {}
    for row in v:
        by.setdefault(row[0], {})[d(row[1])] = row
    out = []
    for wid, _, hire, term in w:
        dates = sorted(by.get(wid, {}))
        for a, b in zip(dates, [*dates[1:], None]):
            day = max(a, d(hire), start)
            while day <= end and (b is None or day < b) and (term is None or day < d(term)):
                out.append((day, wid, by[wid][a]))
                day += dt.timedelta(1)
    return out


@pytest.fixture(scope="module")
def org(spark):
    w, v = random_org(random.Random(2))
    wd, vd = workers(spark, w), versions(spark, v)
    scd = core.employee_profile_scd(latest_version(vd))
    ep = core.employment_episodes(wd, dt.date(2024, 12, 31))
    iv = active_intervals(scd, ep, START, END).cache()
    return w, v, wd, scd, ep, iv


def test_snapshot_against_brute_force(org):
    w, v, _, _, _, iv = org
    want = brute_snapshot(w, v, START, END)
    got = explode_days(iv)
    assert sorted((r.snapshot_date, r.worker_id) for r in got.collect()) == sorted((a, b) for a, b, _ in want)
    assert with_month(got).select("snapshot_month").distinct().count() == 4
    day = dt.date(2024, 2, 14)
    assert snapshot_on(iv, day).count() == sum(a == day for a, _, _ in want)


def test_interval_join_is_an_equi_join(org):
    assert "NestedLoop" not in plan(org[5]) and "Cartesian" not in plan(org[5])


def test_sweep_equals_exploded_totals(org):
    iv = org[5]
    for by in ([], ["department", "worker_type"]):
        sweep = daily_totals(iv, {"fte": exact(F.col("fte"))}, by)
        direct = explode_days(iv).groupBy(*by, "snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.sum(exact(F.col("fte"))).alias("fte"))
        cols = [*by, "snapshot_date", "n", "fte"]
        assert rows(sweep.select(cols)) == rows(direct.select(cols))


def test_periods_and_person_days(org):
    iv = org[5]
    n = explode_days(iv).count()
    for grain in ("day", "month", "quarter"):
        assert snapshot_periods(iv, grain).agg(F.sum("days")).first()[0] == n
    lo, hi = F.lit(dt.date(2024, 2, 1)), F.lit(dt.date(2024, 3, 5))
    want = explode_days(iv).where(F.col("snapshot_date").between(lo, hi)).groupBy("department").count()
    assert rows(person_days(iv, lo, hi, ["department"])) == rows(want)


def test_snapshot_edges(spark):
    w = workers(
        spark,
        [
            ("leaver", "P1", "2024-01-01", "2024-01-10"),
            ("same_day", "P2", "2024-01-05", "2024-01-05"),
            ("stays", "P3", "2024-01-08", None),
        ],
    )
    v = versions(
        spark,
        [
            ("leaver", "2024-01-01", None, "A"),
            ("leaver", "2024-01-10", None, "A"),
            ("same_day", "2024-01-05", None, "A"),
            ("stays", "2024-01-08", None, "A"),
        ],
    )
    scd, ep = core.employee_profile_scd(v), core.employment_episodes(w, END)
    iv = active_intervals(scd, ep, START, last_termination(w, END))
    days = {(r.worker_id, r.snapshot_date) for r in explode_days(iv).collect()}
    assert ("leaver", d("2024-01-09")) in days and ("leaver", d("2024-01-10")) not in days
    assert not any(x == "same_day" for x, _ in days)
    # The snapshot ends with the last termination.
    assert max(day for _, day in days) == d("2024-01-10") == iv.select(last_day(iv)).first()[0]
    nobody = w.where("worker_id = 'stays'")
    assert spark.range(1).select(last_termination(nobody, END)).first()[0] == END


def test_backdated_version_changes_only_its_days(spark):
    w = workers(spark, [("W1", "P1", "2024-01-01", None), ("W2", "P2", "2024-01-01", None)])
    base = [("W1", "2024-01-01", None, "A"), ("W1", "2024-03-01", None, "B"), ("W2", "2024-01-01", None, "A")]
    ep = core.employment_episodes(w, END)
    snap = lambda v: {
        (r.worker_id, r.snapshot_date, r.department)
        for r in explode_days(active_intervals(core.employee_profile_scd(versions(spark, v)), ep, START, END)).collect()
    }
    before, after = snap(base), snap([*base, ("W1", "2024-02-10", None, "C")])
    changed = {(w_, day) for w_, day, _ in before ^ after}
    assert changed == {("W1", d("2024-02-10") + dt.timedelta(i)) for i in range(20)}


def test_last_snapshot_is_the_last_day_wherever_it_is_looked_for(spark, org):
    iv = org[5]
    names = ["employee_key", "manager_employee_key", "department", "snapshot_date"]
    for cut in (dt.date(2024, 3, 1), END):
        some = iv.where(F.col("to_date") <= F.lit(cut))
        want = rows(snapshot_on(some, last_day(some)).select(names))
        last = some.agg(F.max("to_date")).first()[0]
        for near in (START, last - dt.timedelta(1), last, last + dt.timedelta(1), dt.date(2030, 1, 1)):
            assert rows(last_snapshot(some, near).select(names)) == want != []
    assert last_snapshot(iv.where("1 = 0"), END).count() == 0


def brute_chain(snapshot, max_depth=20):
    boss = {(day, wid): row[2] for day, wid, row in snapshot}
    out = []
    for (day, wid), up in boss.items():
        depth = 1
        while up is not None and depth <= max_depth:
            out.append((day, wid, up, depth))
            up, depth = boss.get((day, up)), depth + 1
    return out


@pytest.mark.parametrize("depth", [1, 2, 5, 20])
def test_chain_against_brute_force(spark, org, depth):
    w, v, _, _, ep, iv = org
    want = sorted(brute_chain(brute_snapshot(w, v, START, END), depth), key=repr)
    ids = {r.employee_key: r.worker_id for r in ep.select("employee_key", "worker_id").collect()}
    name = lambda r: (r.snapshot_date, ids[r.employee_key], ids[r.ancestor_employee_key], r.depth)
    daily = manager_chain(explode_days(iv), depth)
    assert sorted(map(name, daily.collect()), key=repr) == want
    spans = explode_days(manager_chain_intervals(iv, depth))
    assert sorted(map(name, spans.collect()), key=repr) == want


def test_versions_of_one_manager_do_not_cut_the_chain(spark):
    """40 versions of ten days under one manager, overlapping and repeated rows, managers that change within a month."""
    days = lambda n: START + dt.timedelta(n)
    held = [("a", "m", days(10 * i), days(10 * i + 9)) for i in range(40)]
    held += [("b", "m", days(0), days(50)), ("b", "m", days(0), days(50)), ("b", "n", days(20), days(70)), ("b", "m", days(51), days(90))]
    held += [("m", "t", days(0), days(45)), ("m", "n", days(46), days(300)), ("n", "t", days(0), days(400)), ("t", None, days(0), days(400))]
    iv = spark.createDataFrame(held, "employee_key string, manager_employee_key string, from_date date, to_date date")
    of_a = manager_chain_intervals(iv, grain=None).where("employee_key = 'a' and depth = 1").count()
    assert of_a == len({days(n).year for n in range(400)})
    fields = ("snapshot_date", "employee_key", "ancestor_employee_key", "depth")
    want = sorted(manager_chain(explode_days(iv)).select(*fields).collect())
    for grain in (None, "month"):
        chain = manager_chain_intervals(iv, grain=grain)
        assert sorted(explode_days(chain).select(*fields).collect()) == want
        assert ("month" in chain.columns) == (grain == "month")


@pytest.mark.parametrize("together", [3, 100_000])
def test_organisation_by_month_against_daily_rows(spark, org, monkeypatch, together):
    monkeypatch.setattr(hierarchy, "ROWS_TOGETHER", together)
    iv = org[-1]
    groups = {}
    for r in manager_chain(explode_days(iv)).collect():
        groups.setdefault((r.snapshot_date.replace(day=1), r.ancestor_employee_key, r.depth), []).append(r.employee_key)
    want = sorted((*k, len(v), len(set(v)), min(v), max(v)) for k, v in groups.items())
    got = hierarchy.org_by_period(manager_chain_intervals(iv, grain=None), "month")
    fields = ("month", "ancestor_employee_key", "depth", "employee_days", "employees", "least_employee", "greatest_employee")
    assert sorted(tuple(r) for r in got.select(*fields).collect()) == want


def test_sums_of_whole_groups_travel_once(spark, monkeypatch):
    """Keys of any text, intervals that overlap, repeat, end before they start and lie in one month."""
    days = lambda n: START + dt.timedelta(n)
    keys = ["0a" * 16, "ab", "0A", "abc", "é", "", "x" * 16]
    held = [(e, a, 1 + i % 2, days(7 * i + 3 * j), days(7 * i + 3 * j + k)) for i, e in enumerate(keys) for j, a in enumerate((*keys[:3], None)) for k in (40, 5, 5, -9)]
    chain = spark.createDataFrame(held, "employee_key string, ancestor_employee_key string, depth int, from_date date, to_date date")
    groups = {}
    for e, a, depth, first, last in held:
        for n in range((last - first).days + 1):
            groups.setdefault(((first + dt.timedelta(n)).replace(day=1), a, depth), []).append(e)
    want = sorted([(*k, len(v), len(set(v)), min(v), max(v)) for k, v in groups.items()], key=repr)
    for together in (5, 100_000):
        monkeypatch.setattr(hierarchy, "ROWS_TOGETHER", together)
        got = hierarchy.org_by_period(chain, "month")
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert "hashpartitioning(month" not in got._jdf.queryExecution().executedPlan().toString()


def test_spans(spark, org):
    w, v, wd, _, ep, iv = org
    day = dt.date(2024, 2, 20)
    snap = snapshot_on(iv, day).cache()
    chain = manager_chain(snap)
    direct, total = {}, {}
    for _, wid, up, depth in brute_chain([x for x in brute_snapshot(w, v, START, END) if x[0] == day]):
        total.setdefault(up, set()).add(wid)
        if depth == 1:
            direct.setdefault(up, set()).add(wid)
    ids = {r.employee_key: r.worker_id for r in ep.collect()}
    got = {ids[r.manager_employee_key]: (r.direct_reports, r.total_org_size) for r in org_size(chain).collect()}
    assert got == {m: (len(direct.get(m, ())), len(e)) for m, e in total.items()}
    assert sum(r.direct_reports for r in span_of_control(snap, core.dim_employee(wd)).collect()) == sum(map(len, direct.values()))
    assert org_pyramid(chain).where("levels_above = 1").first().employees == sum(map(len, direct.values()))
    active = {r.employee_key for r in snap.collect()}
    assert span_stats(snap).agg(F.sum("managers")).first()[0] == sum(1 for k, x in ids.items() if x in direct and k in active)


def test_mart_net_change_matches_headcount(spark):
    w = workers(spark, [("W1", "P1", "2024-01-03", "2024-01-20"), ("W2", "P2", "2024-01-05", None), ("W3", "P1", "2024-01-25", None)])
    v = versions(
        spark,
        [
            ("W1", "2024-01-03", None, "A", "part_time", 0.6),
            ("W2", "2024-01-05", None, "A"),
            ("W3", "2024-01-25", None, "A", "intern", 1.0),
        ],
    )
    e = events(
        spark,
        [
            ("1", "W1", "hire", "2024-01-03", "A", None),
            ("2", "W2", "hire", "2024-01-05", "A", None),
            ("3", "W1", "termination", "2024-01-20", "A", "voluntary"),
            ("4", "W3", "rehire", "2024-01-25", "A", None),
            ("5", "W2", "transfer", "2024-01-26", "A", None),
            ("6", "W2", "lateral", "2024-01-27", "A", None),
        ],
    )
    iv = active_intervals(core.employee_profile_scd(v), core.employment_stints(w, END), START, END)
    mart = mart_workforce(dim_date(spark, START, END), iv, core.fact_employment_event(e), dt.date(2024, 1, 31), START)
    out = mart.orderBy("date_day").collect()
    assert len(out) == 31
    running = 0
    for r in out:
        running += r.net_headcount_change
        assert r.active_headcount == running
    assert (out[4].total_fte, out[4].part_time_headcount, out[30].intern_headcount) == (1.6, 1, 1)
    assert sum(r.hires for r in out) == 2 and sum(r.rehires for r in out) == 1 and sum(r.transfers for r in out) == 1


def test_survivors(spark):
    data = [(f"p{i}", f"p{i + 1}") for i in range(9)] + [("x", "p3"), ("y", "z")]
    df = spark.createDataFrame(data, "merged_key string, survivor_key string")
    got = {r.merged_key: r.survivor_key for r in resolve_survivors(df).collect()}
    assert got == {**{f"p{i}": "p9" for i in range(9)}, "x": "p9", "y": "z"}
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], df.schema)
    with pytest.raises(ValueError, match="cycle"):
        resolve_survivors(loop, 6)


def test_attrition_counts_the_manager_at_the_time(spark):
    w = workers(spark, [("boss", "P0", "2023-01-01", None), ("new_boss", "P1", "2023-01-01", None), ("W1", "P2", "2023-01-01", "2024-02-01"), ("W2", "P3", "2023-01-01", None)])
    v = versions(
        spark,
        [
            ("boss", "2023-01-01", None, "Eng"),
            ("new_boss", "2023-01-01", "boss", "Eng"),
            ("W1", "2023-01-01", "boss", "Eng"),
            ("W1", "2024-01-15", "new_boss", "Eng"),
            ("W2", "2023-01-01", "new_boss", "Eng"),
        ],
    )
    e = events(spark, [("1", "W1", "termination", "2024-02-01", "Eng", "voluntary")])
    scd = core.employee_profile_scd(v)
    iv = active_intervals(scd, core.employment_stints(w, END), dt.date(2023, 1, 1), END)
    out = attrition_by_manager(
        manager_chain(snapshot_on(iv, END)), scd, core.fact_employment_event(e), iv, core.dim_employee(w), END, "Eng%", 2,
        voluntary=F.col("termination_reason") == "voluntary", regrettable=F.lit(False),
    )
    emp = {r.employee_key: r.worker_id for r in core.dim_employee(w).collect()}
    got = {emp[r.manager_employee_key]: (r.voluntary_terms, r.avg_active_headcount) for r in out.collect()}
    # W1 reports to the old boss only before the window of the last twelve months ends, then to the new one.
    assert got == {"boss": (0, 2.0), "new_boss": (1, 2.0)}
    half = attrition_by_manager(
        manager_chain(snapshot_on(iv, END)), scd, core.fact_employment_event(e), iv, core.dim_employee(w), END, "Eng%", 2,
        voluntary=F.col("termination_reason") == "voluntary", regrettable=F.lit(False), months=6,
    )
    for r in half.collect():
        assert r.voluntary_attrition_rate_annualised == 2 * r.voluntary_terms / r.avg_active_headcount
