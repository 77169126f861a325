"""Files to marts: the whole way on a small company."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hrflow.operators.quality import check_payload_keys, check_snapshot_active, check_scd2_grain, check_scd2_overlap
from hrflow.operators.snapshot import stored_day
from hrflow.plans.contracts import CORE_CONTRACTS, contract_report
from hrflow.plans.metrics import metric
from hrflow.plans.reports import EXTRACTS, REPORTS, extract
from hrflow.plans.warehouse import build, publish, staging, warehouse
from hrflow.sources.ingest import ingest, raw_tables
from hrflow.sources.landing import METADATA_COLUMNS
from tests.helpers import rows

AT = dt.datetime(2024, 6, 1, 6)
AS_OF = dt.date(2024, 6, 30)
NOW = "2024-06-01T00:00:00Z"


def documents():
    def version(day, dep, boss, kind="full_time", fte=1.0, event="hire"):
        return {"effective_date": day, "department": dep, "function": "F", "job_title": "T", "job_level": "IC1", "manager_worker_id": boss,
                "worker_type": kind, "fte": fte, "location_city": "X", "location_region": None, "location_country": "CA", "event_type": event}

    def worker(wid, pid, hire, term, history, **extra):
        return {"worker_id": wid, "person_external_id": pid, "first_name": "Ann", "last_name": wid, "work_email": f"{wid}@x.example",
                "personal_email": None, "hire_date": hire, "termination_date": term, "termination_reason": None, "is_active": term is None,
                "current_department": history[-1]["department"] if history else None, "current_function": "F", "current_job_title": "T",
                "current_job_level": "IC1", "current_manager_worker_id": history[-1]["manager_worker_id"] if history else None,
                "current_worker_type": "full_time", "current_fte": 1.0, "current_location_city": "X", "current_location_region": None,
                "current_location_country": "CA", "source_updated_at": NOW, "profile_history": history, **extra}

    workers = [
        worker("W1", "P1", "2024-01-01", None, [version("2024-01-01", "Eng", None), version("2024-03-01", "Eng", None, event="promotion")]),
        worker("W2", "P2", "2024-01-10", "2024-04-01", [version("2024-01-10", "Eng", "W1"), version("2024-04-01", "Eng", "W1", event="termination")], badge="new field"),
        worker("W3", "P2", "2024-05-01", None, [version("2024-05-01", "Ops", "W1", "part_time", 0.6, "rehire")]),
    ]
    persons = [{"person_external_id": p, "first_name": "Ann", "last_name": p, "personal_email": f"{p}@m.example", "worker_ids": ids, "source_updated_at": NOW} for p, ids in (("P1", ["W1"]), ("P2", ["W2", "W3"]))]
    event = lambda i, w, p, kind, day: {"event_id": f"E{i}", "worker_id": w, "person_external_id": p, "event_type": kind, "effective_date": day, "department": "Eng", "function": "F", "source_updated_at": NOW}
    events = [event(1, "W1", "P1", "hire", "2024-01-01"), event(2, "W2", "P2", "hire", "2024-01-10"), event(3, "W1", "P1", "promotion", "2024-03-01"), event(4, "W2", "P2", "termination", "2024-04-01"), event(5, "W3", "P2", "rehire", "2024-05-01")]
    jobs = [{"requisition_id": "REQ1", "job_title": "T", "job_level": "IC1", "department": "Eng", "function": "F", "opened_at": "2023-12-01", "closed_at": "2024-01-05", "status": "filled", "hired_worker_ids": ["W2"], "source_updated_at": NOW}]
    candidates = [{"candidate_id": "C1", "first_name": "Ann", "last_name": "P2", "email": "p2@m.example", "linkedin_url": None, "source": "referral", "person_external_id": "P2", "source_updated_at": NOW}]
    apps = [
        {"application_id": a, "candidate_id": "C1", "requisition_id": "REQ1", "submitted_at": "2023-12-10T09:00:00+00:00", "current_stage": stage, "status": status, "final_outcome_reason": None, "source": "referral", "is_winning": status == "hired", "closed_at": closed,
         "source_updated_at": NOW, "stage_history": [{"from_stage": None, "to_stage": "applied", "transitioned_at": "2023-12-10T09:00:00+00:00"}, {"from_stage": "applied", "to_stage": stage, "transitioned_at": "2023-12-12T09:00:00+00:00"}]}
        for a, stage, status, closed in (("A1", "hired", "hired", "2024-01-05T00:00:00+00:00"), ("A2", "offer", "active", None))
    ]
    offers = [{"offer_id": "O1", "application_id": "A1", "candidate_id": "C1", "requisition_id": "REQ1", "extended_at": "2024-01-02T10:00:00+00:00", "responded_at": "2024-01-05T10:00:00+00:00", "status": "accepted", "base_salary_amount": 100000.0, "base_salary_currency": "CAD", "accepted_person_external_id": "P2", "source_updated_at": NOW}]
    return {
        "workday_workers": workers, "workday_persons": persons, "workday_employment_events": events, "ashby_jobs": jobs,
        "ashby_candidates": candidates, "ashby_applications": apps, "ashby_offers": offers,
    }


def write(folder, lines=False):
    folder.mkdir()
    for name, docs in documents().items():
        text = "\n".join(json.dumps(x) for x in docs) if lines else json.dumps(docs)
        (folder / f"{name}.json").write_text(text)
    return str(folder)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("pipeline")
    raw = str(tmp / "raw")
    runs = [ingest(spark, s, write(tmp / s), raw, AT, truncate_first=True, multiline=True) for s in ("hris_workday", "ats_ashby")]
    tables = raw_tables(spark, raw)
    return build(tables, str(tmp / "warehouse"), AS_OF, start=dt.date(2024, 1, 1)), tables, runs, tmp


def test_stored_staging_gives_the_same_tables(spark, built, tmp_path):
    t, raw, _, _ = built
    direct = publish(warehouse(staging(raw), AS_OF, start=dt.date(2024, 1, 1)), str(tmp_path / "w"), ["dim_employee", "active_intervals"])
    for name in ("dim_employee", "active_intervals"):
        assert rows(t[name]) == rows(direct[name])


def test_raw_tables_are_complete(built):
    _, raw, runs, _ = built
    counts = {obj: df.count() for obj, df in raw.items()}
    assert counts == {"workers": 3, "profile_versions": 5, "persons": 2, "employment_events": 5, "jobs": 1, "candidates": 1,
                      "applications": 2, "application_stage_events": 4, "offers": 1}
    for df in raw.values():
        assert tuple(df.columns) == METADATA_COLUMNS
        assert all(len(r._payload_hash) == 64 and r._run_id in runs and r._source_updated_at for r in df.collect())
    # Undeclared fields stay in the payload, and the drift check sees them.
    known = [k for k in documents()["workday_workers"][0] if k != "profile_history"]
    assert [(r.key, r.change) for r in check_payload_keys(raw["workers"], known).collect()] == [("badge", "new")]
    ids = {r[0] for r in raw["profile_versions"].select("_source_record_id").collect()}
    assert "W1|2024-03-01" in ids


def test_line_delimited_extract_lands_the_same_payloads(spark, built):
    _, raw, _, tmp = built
    target = str(tmp / "raw_lines")
    for system in ("hris_workday", "ats_ashby"):
        ingest(spark, system, write(tmp / f"lines_{system}", lines=True), target, AT)
    for obj, df in raw_tables(spark, target).items():
        pick = lambda x: sorted((r._source_record_id, r._payload_hash) for r in x.collect())
        assert pick(df) == pick(raw[obj]), obj


def test_second_extract_adds_rows_and_keeps_the_base(spark, built):
    _, raw, _, tmp = built
    folder, target = write(tmp / "again"), str(tmp / "raw_twice")
    for day in (0, 1):
        ingest(spark, "hris_workday", folder, target, AT + dt.timedelta(days=day), run_id=f"run-{day}", multiline=True)
    twice = spark.read.parquet(f"{target}/hris_workday__workers")
    assert twice.count() == 6
    from hrflow.sources.flatten import base_model

    assert {r.ingested_run_id for r in base_model(twice, "workers").collect()} == {"run-1"}


def test_marts(built):
    t = built[0]
    mart = {r.date_day: r for r in t["mart_workforce_metrics_daily"].collect()}
    day = mart[dt.date(2024, 3, 31)]
    assert (day.active_headcount, day.total_fte) == (2, 2.0)
    # The snapshot ends with the last termination.
    assert mart[dt.date(2024, 4, 1)].active_headcount == 1 and mart[dt.date(2024, 5, 2)].active_headcount == 0
    funnel = {r.event_date: r for r in t["mart_recruiting_funnel_daily"].collect()}
    assert funnel[dt.date(2023, 12, 10)].applications_submitted == 2 and funnel[dt.date(2024, 1, 5)].hires == 1
    bridge = t["bridge_candidate_employee"].first()
    assert (bridge.worker_id, bridge.days_offer_to_hris_start) == ("W2", 5)
    chain = t["fact_manager_chain_daily"].where("snapshot_date = date'2024-02-01'").collect()
    assert len(chain) == 1 and chain[0].depth == 1
    assert metric("hires", t, "year").first().hires == 3


def test_stored_day_reads_one_month(built):
    daily = built[0]["fact_headcount_snapshot_daily"]
    one = stored_day(daily, dt.date(2024, 2, 1))
    assert one.count() == 2
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_month" in text


def test_published_tables_keep_their_contracts(built):
    t = built[0]
    bad = contract_report(t, CORE_CONTRACTS).where("status = 'fail'").collect()
    assert [(r.model, r.column_name) for r in bad] == []
    for failing in (
        check_scd2_overlap(t["dim_employee_profile_scd"]),
        check_scd2_grain(t["dim_employee_profile_scd"]),
        check_snapshot_active(t["fact_headcount_snapshot_daily"], t["dim_employment_episode"]),
    ):
        assert failing.count() == 0


def test_every_report_and_extract_runs(built):
    t, raw, _, _ = built
    t["raw_workers"] = raw["workers"]
    for name, fn in REPORTS.items():
        assert fn(t, AS_OF).collect() is not None, name
    for name in EXTRACTS:
        assert extract(t, name).columns
    assert REPORTS["q11"](t, AS_OF).select(F.count_if(F.col("raw_run_id") == F.col("dim_run_id"))).first()[0] == 3
