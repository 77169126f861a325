from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hrflow.operators.snapshot import active_intervals
from hrflow.plans import core
from hrflow.plans.marts import mart_funnel
from hrflow.plans.metrics import METRICS, SEMANTIC_MODELS, measure, metric
from hrflow.plans.people_metrics import (
    attrition_annualised,
    candidate_offer_acceptance,
    mobility_rate,
    time_to_hire,
    with_is_employee,
)
from hrflow.plans.reports import EXTRACTS, REPORTS, STAGES
from tests.helpers import d, events, plan, ts, versions, workers

END = dt.date(2024, 12, 31)


def funnel_inputs(spark):
    apps = spark.createDataFrame(
        [
            ("a1", "r1", ts("2024-01-01 10:00:00"), "hired", 4),
            ("a1", "r1", ts("2024-01-01 11:00:00"), "hired", 6),
            ("a2", "r1", ts("2024-01-01 12:00:00"), "rejected", None),
            ("a3", "r2", ts("2024-01-02 12:00:00"), "active", None),
            ("a4", "gone", ts("2024-01-02 12:00:00"), "active", None),
        ],
        "application_id string, requisition_id string, submitted_at timestamp, status string, days_in_funnel int",
    )
    offers = spark.createDataFrame(
        [
            ("o1", "r1", ts("2024-01-01 10:00:00"), ts("2024-01-05 09:00:00"), "accepted", 4),
            ("o2", "r1", ts("2024-01-01 10:00:00"), ts("2024-01-03 09:00:00"), "declined", 2),
            ("o3", "r1", ts("2024-01-01 10:00:00"), None, "pending", None),
            ("o4", "r2", ts("2024-01-02 10:00:00"), ts("2024-01-02 11:00:00"), "accepted", 0),
        ],
        "offer_id string, requisition_id string, extended_at timestamp, responded_at timestamp, status string, days_to_respond int",
    )
    jobs = spark.createDataFrame([("r1", "Eng", "F"), ("r2", None, "F")], "requisition_id string, department string, function_name string")
    return apps, offers, jobs


def test_funnel_mart(spark):
    out = {(r.event_date, r.department): r for r in mart_funnel(*funnel_inputs(spark)).collect()}
    assert set(out) == {(d("2024-01-01"), "Eng"), (d("2024-01-02"), None), (d("2024-01-05"), "Eng")}
    r = out[(d("2024-01-01"), "Eng")]
    assert (r.applications_submitted, r.applications_hired, r.applications_rejected, r.avg_days_in_funnel) == (2, 1, 1, 5.0)
    assert (r.offers_extended, r.offers_accepted, r.offers_declined, r.avg_days_to_respond) == (3, 1, 1, 3.0)
    assert (r.hires, r.offer_acceptance_rate, r.funnel_conversion_rate) == (0, 0.333, 0.0)
    hire = out[(d("2024-01-05"), "Eng")]
    assert (hire.hires, hire.funnel_conversion_rate, hire.avg_days_in_funnel) == (1, None, None)
    # A null department matches nothing: the combination is listed with zeros.
    null = out[(d("2024-01-02"), None)]
    assert (null.applications_submitted, null.offers_extended, null.hires, null.avg_days_to_respond) == (0, 0, 0, None)


def test_funnel_mart_does_not_expand_rows_per_distinct(spark):
    assert "Expand" not in plan(mart_funnel(*funnel_inputs(spark)))


@pytest.fixture(scope="module")
def tables(spark):
    w = workers(spark, [("W1", "P1", "2024-01-01", "2024-02-11"), ("W2", "P2", "2024-01-16", None)])
    v = versions(spark, [("W1", "2024-01-01", None, "A", "full_time", 0.5), ("W2", "2024-01-16", "W1", "B")])
    e = events(
        spark,
        [
            ("1", "W1", "hire", "2024-01-01", "A", None),
            ("2", "W2", "rehire", "2024-01-16", "B", None),
            ("3", "W1", "termination", "2024-02-11", "A", "voluntary_resignation"),
            ("4", "W1", "termination", "2024-02-11", None, "voluntary"),
            ("5", "W2", "lateral", "2024-03-01", "B", None),
        ],
    )
    scd = core.employee_profile_scd(v)
    return {
        "active_intervals": active_intervals(scd, core.employment_stints(w, END), dt.date(2024, 1, 1), dt.date(2024, 3, 31)),
        "fact_employment_event": core.fact_employment_event(e),
        "dim_employee": core.dim_employee(w),
    }


def by_month(df, *cols):
    return {(str(r.metric_time)[:7], *[r[c] for c in cols[:-1]]): r[cols[-1]] for r in df.collect()}


def test_headcount_adds_up_over_days(tables):
    assert by_month(metric("active_headcount", tables, "month"), "active_headcount") == {("2024-01",): 47, ("2024-02",): 39, ("2024-03",): 31}
    assert by_month(metric("total_fte", tables, "month", ["department"]), "department", "total_fte")[("2024-01", "A")] == 15.5
    daily = metric("active_headcount", tables, "day").where("metric_time = date'2024-01-20'").first()
    assert daily.active_headcount == 2
    avg = by_month(metric("active_headcount", tables, "month", semi_additive="avg"), "active_headcount")
    assert avg == {("2024-01",): 47 / 31, ("2024-02",): 39 / 29, ("2024-03",): 1.0}


def test_conditions_on_slices_that_are_not_requested(tables):
    a, b = {"department": lambda c: c == "A"}, {"department": lambda c: c == "B", "employee__termination_date": lambda c: c.isNull()}
    assert by_month(metric("active_headcount", tables, "month", only=a), "active_headcount") == {("2024-01",): 31, ("2024-02",): 10}
    assert by_month(metric("active_headcount", tables, "month", only=b), "active_headcount") == {("2024-01",): 16, ("2024-02",): 29, ("2024-03",): 31}
    days = metric("active_headcount", tables, "day", only=a)
    assert days.count() == 41 and days.agg(F.max("active_headcount")).first()[0] == 1
    avg = by_month(metric("active_headcount", tables, "month", semi_additive="avg", only=a), "active_headcount")
    assert avg == {("2024-01",): 31 / 31, ("2024-02",): 10 / 29}
    sliced = metric("terminations", tables, "month", ["department"], only={"termination_reason": lambda c: c == "voluntary"})
    assert by_month(sliced, "department", "terminations") == {("2024-02", None): 1}
    with pytest.raises(KeyError):
        metric("terminations", tables, "month", only={"fte": lambda c: c > 0})


def test_flow_metrics_as_written(tables):
    assert by_month(metric("hires", tables, "month"), "hires") == {("2024-01",): 2}
    assert by_month(metric("transfers", tables, "month"), "transfers") == {("2024-03",): 1}
    assert by_month(metric("terminations", tables, "month", ["department"]), "department", "terminations") == {("2024-02", "A"): 1, ("2024-02", None): 1}
    assert by_month(metric("voluntary_terminations", tables, "month"), "voluntary_terminations") == {("2024-02",): 1}
    spelled = {"voluntary_terminations": lambda: F.col("termination_reason").startswith("voluntary")}
    assert by_month(metric("voluntary_terminations", tables, "month", overrides=spelled), "voluntary_terminations") == {("2024-02",): 2}


def test_derived_metric_keeps_groups_of_either_side(tables):
    out = by_month(metric("total_attrition_rate", tables, "month", ["department"]), "department", "total_attrition_rate")
    assert out[("2024-02", "A")] == 0.1 and out[("2024-02", None)] is None and out[("2024-02", "B")] is None
    sliced = metric("total_attrition_rate", tables, "month", ["department"], where=F.col("department") == "A")
    assert {r.department for r in sliced.collect()} == {"A"}


def test_metric_by_entity_column(tables):
    out = metric("active_headcount", tables, "month", ["employee__hire_date"])
    assert {str(r.employee__hire_date) for r in out.collect()} == {"2024-01-01", "2024-01-16"}


def test_measure_without_metric_and_inventory(tables):
    assert by_month(measure("total_events", tables, "month"), "total_events") == {("2024-01",): 2, ("2024-02",): 2, ("2024-03",): 1}
    assert len(METRICS) == 18 and len(SEMANTIC_MODELS) == 5
    assert sum(len(m.measures) for m in SEMANTIC_MODELS.values()) == 18


def test_rates_and_employee_flag(spark, tables):
    iv, ev = tables["active_intervals"], tables["fact_employment_event"]
    a = {r.department: r for r in attrition_annualised(iv, ev, dt.date(2024, 1, 1), dt.date(2024, 3, 31), 3).collect()}
    assert (a["A"].start_headcount, a["A"].end_headcount, a["A"].terminations) == (1, 0, 1)
    assert a["A"].attrition_rate_annualised == 8.0 and a["B"].attrition_rate_annualised == 0.0
    m = {r.department: r for r in mobility_rate(iv, ev, dt.date(2024, 1, 1), dt.date(2024, 3, 31), 3).collect()}
    assert m["B"].mobility_rate_annualised == 8.0
    types = spark.createDataFrame([("full_time",), ("contractor",), (None,)], "worker_type string")
    assert [r.is_employee for r in with_is_employee(types).collect()] == [True, False, False]


def test_time_to_hire_counts_business_days(spark):
    # Friday to Monday is one business day.
    apps = spark.createDataFrame([("a", "r", ts("2024-01-05 10:00:00"))], "application_id string, requisition_id string, submitted_at timestamp")
    offers = spark.createDataFrame([("o", "a", "accepted", ts("2024-01-08 10:00:00"))], "offer_id string, application_id string, status string, responded_at timestamp")
    reqs = spark.createDataFrame([("r", "Eng")], "requisition_id string, department string")
    out = time_to_hire(apps, offers, offers.select("offer_id"), reqs).collect()
    assert [tuple(r) for r in out] == [("Eng", 1, 1.0)]
    acc = offers.unionByName(spark.createDataFrame([("p", "b", "rescinded", ts("2024-01-09 00:00:00"))], offers.schema))
    assert [tuple(r)[1:] for r in candidate_offer_acceptance(acc).collect()] == [(1, 1, 1.0)]


def test_report_inventory():
    assert {f"q{i:02}" for i in range(1, 25)} <= set(REPORTS)
    assert len(EXTRACTS) == 7 and STAGES[0] == "applied" and STAGES[-1] == "hired"
    assert "work_email" not in EXTRACTS["dim_employee"]


def test_contracts_cover_the_declared_checks(spark):
    from hrflow.plans.contracts import BASE_CONTRACTS, CORE_CONTRACTS, RAW_CONTRACTS, STAGING_CONTRACTS, contract_report

    total: dict[str, int] = {}
    for group in (RAW_CONTRACTS, BASE_CONTRACTS, STAGING_CONTRACTS, CORE_CONTRACTS):
        for c in group.values():
            for kind, n in c.size().items():
                total[kind] = total.get(kind, 0) + n
    assert total == {"not_null": 114, "unique": 37, "accepted_values": 9, "relationships": 10}

    w = workers(spark, [("W1", "P1", "2024-01-01", None), ("W1", "P1", "2024-01-01", None)])
    persons = core.dim_person(w.selectExpr("'P2' person_external_id", "first_name", "last_name", "'' personal_email", "'' worker_ids_json", *core.LINEAGE).limit(1))
    report = contract_report({"dim_employee": core.dim_employee(w), "dim_person": persons}, CORE_CONTRACTS, ["dim_employee"])
    bad = {(r.check_name, r.column_name): r.failures for r in report.collect() if r.status == "fail"}
    assert bad == {("unique", "employee_key"): 1, ("unique", "worker_id"): 1, ("relationships", "person_key"): 2}
