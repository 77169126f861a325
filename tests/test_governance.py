from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from hrflow.operators import identity, privacy, quality, reconcile
from hrflow.operators.components import components
from hrflow.operators.snapshot import explode_days
from hrflow.plans import core
from hrflow.streaming.events import check_deliveries, first_deliveries, land_events, read_events, reconcile_events
from tests.helpers import d, rows, ts, workers

NOW = dt.datetime(2024, 6, 1, 12)


def test_generic_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("z", -3)], "k string, n int")
    assert rows(quality.check_not_null(df, ["k"])) == [(None, 2)]
    assert rows(quality.check_unique(df, ["k"])) == [("a", 2)]
    assert rows(quality.check_unique(df, [F.concat_ws("|", "k", "n")])) == [("a|1", 2)]
    assert rows(quality.check_accepted_values(df, "k", ["a"])) == [("z", 1)]
    assert rows(quality.check_non_negative(df, ["n"])) == [("z", -3)]
    parent = spark.createDataFrame([("a",)], "p string")
    assert rows(quality.check_relationships(df, "k", parent, "p")) == [("z", 1)]


@pytest.mark.parametrize("hours,status", [(1, "pass"), (40, "warn"), (80, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(NOW - dt.timedelta(hours=hours),)], "_ingested_at_utc timestamp")
    r = quality.check_freshness(df, NOW, 36, 72).first()
    assert (r.status, r.age_hours) == (status, float(hours))
    assert quality.check_freshness(df.limit(0), NOW, 36, 72).first().status == "error"


def test_history_checks(spark):
    scd = spark.createDataFrame(
        [("e", "k1", "w", d("2024-01-01"), d("2024-02-01")), ("e", "k2", "w", d("2024-01-20"), None), ("e", "k3", "w", d("2024-01-20"), None)],
        "employee_key string, employee_profile_key string, worker_id string, valid_from_date date, valid_to_date date",
    )
    pairs = [(r.profile_a, r.profile_b) for r in quality.check_scd2_overlap(scd, pairs=True).collect()]
    assert sorted(pairs) == [("k1", "k2"), ("k1", "k3"), ("k2", "k3")]
    assert rows(quality.check_scd2_grain(scd)) == [("w", d("2024-01-20"), 2)]
    ep = core.employment_episodes(workers(spark, [("a", "P", "2024-01-01", None), ("b", "P", "2024-02-01", None), ("c", "Q", "2024-01-01", None)]), d("2024-03-01"))
    assert quality.check_episode_overlap(ep).count() == 1
    snap = spark.createDataFrame([(d("2024-01-01"), "x"), (d("2024-01-01"), "x")], "snapshot_date date, employee_key string")
    assert rows(quality.check_snapshot_unique(snap)) == [(d("2024-01-01"), "x", 2)]
    assert quality.check_snapshot_active(snap, ep).count() == 2


def test_intervals_give_the_violations_of_their_days(spark):
    r = random.Random(5)
    day = lambda n: d("2024-01-01") + dt.timedelta(days=n)
    spans = [(r.choice("abcde"), day(at := r.randrange(60)), day(at + r.randrange(20))) for _ in range(40)]
    spans += [(None, day(1), day(3)), ("z", day(0), day(1)), ("z", day(0), day(1))]
    stints = [(r.choice("abcd"), day(at := r.randrange(60)), r.choice([None, day(at + r.randrange(-1, 15))])) for _ in range(14)]
    stints += [(None, day(0), None), ("e", None, day(9))]
    held = spark.createDataFrame(spans, "employee_key string, from_date date, to_date date")
    episodes = spark.createDataFrame(stints, "employee_key string, hire_date date, termination_date date")
    got, want = quality.check_intervals_active(held, episodes), quality.check_snapshot_active(explode_days(held), episodes)
    assert rows(got) == rows(want) and got.count() > 50
    assert quality.check_intervals_active(held.limit(0), episodes).count() == 0
    assert quality.check_intervals_active(held, episodes.limit(0)).count() == explode_days(held).count()


def test_days_counted_twice_from_intervals(spark):
    held = spark.createDataFrame(
        [
            ("x", d("2024-01-01"), d("2024-01-10")),
            ("x", d("2024-01-05"), d("2024-01-12")),
            ("x", d("2024-01-10"), d("2024-01-10")),
            ("x", d("2024-01-13"), d("2024-01-20")),
            ("y", d("2024-01-01"), d("2024-03-01")),
            ("y", d("2024-01-09"), d("2024-01-08")),
            (None, d("2024-02-01"), d("2024-02-02")),
            (None, d("2024-02-02"), d("2024-02-02")),
            ("z", d("2024-01-01"), None),
        ],
        "employee_key string, from_date date, to_date date",
    )
    daily = explode_days(held.where("from_date <= to_date"))
    got = quality.check_snapshot_unique(held)
    assert rows(got) == rows(quality.check_snapshot_unique(daily)) and got.count() == 7


def test_operational_checks(spark):
    daily = spark.createDataFrame([(d("2024-01-01"), 10), (d("2024-01-02"), 11), (d("2024-01-03"), 30)], "day date, n int")
    assert rows(quality.check_delta_band(daily, "day", "n", -5, 5)) == [(d("2024-01-03"), 30, 19)]
    raw = spark.createDataFrame(
        [("s", "o", f"r{run}", NOW + dt.timedelta(days=run), json.dumps({"a": 1, **({"b": 2} if run == 2 else {})})) for run, n in enumerate([10, 10, 3]) for _ in range(n)],
        "_source_system string, _source_object string, _run_id string, _ingested_at_utc timestamp, raw_payload string",
    )
    out = quality.check_run_counts(raw, 0.5, 0.5).collect()
    assert [(r._run_id, r.row_count, r.previous_count) for r in out] == [("r2", 3, 10)]
    assert rows(quality.check_payload_keys(raw, ["a", "c"])) == [("b", "new", 3), ("c", "missing", 0)]
    report = quality.check_report([quality.Check("x", "m", daily.limit(0)), quality.Check("y", "m", daily, "warn", "hr")])
    assert [(r.check_name, r.failures, r.status, r.owner) for r in report.orderBy("check_name").collect()] == [("x", 0, "pass", None), ("y", 3, "warn", "hr")]


def test_masks(spark):
    df = spark.createDataFrame([("ann@x.org",), ("a@x.org",), ("nodomain",), (None,)], "e string")
    got = [r[0] for r in df.select(privacy.mask_email(F.col("e"), "PA_ANALYST")).collect()]
    assert got == ["a***@x.org", "a***@x.org", "nodomain", None]
    strict = [r[0] for r in df.select(privacy.mask_email(F.col("e"), "PA_ANALYST", strict=True)).collect()]
    assert strict == ["a***@x.org", "a***@x.org", "***", None]
    assert [r[0] for r in df.select(privacy.mask_name(F.col("e"), "PA_AUDITOR")).collect()][0] == "ann@x.org"
    assert [r[0] for r in df.select(privacy.mask_name(F.col("e"), "")).collect()] == ["a***", "a***", "n***", None]


def erasure_tables(spark):
    w = workers(spark, [("W1", "P1", "2020-01-01", "2021-01-01"), ("W2", "P1", "2022-01-01", None), ("W3", "P2", "2022-01-01", None)])
    persons = spark.createDataFrame([("P1", "Ann", "Lee", "a@x"), ("P2", "Bo", "Li", "b@x")], "person_external_id string, first_name string, last_name string, personal_email string")
    raw = lambda ids: spark.createDataFrame(
        [(i, json.dumps({"person_external_id": p, "first_name": "Ann", "worker_ids": ["W1"], "fte": 1.0, "email": None})) for i, p in ids],
        "_source_record_id string, raw_payload string",
    )
    return {
        "dim_person": persons.withColumn("person_key", F.md5("person_external_id")),
        "dim_employee": core.dim_employee(w),
        "raw_workers": raw([("W1", "P1"), ("W2", "P1"), ("W3", "P2")]),
        "raw_persons": raw([("P1", "P1"), ("P2", "P2")]),
        "raw_profile_versions": raw([("v1", "P1"), ("v2", "P2")]),
    }


def test_erase_person_default_scope(spark):
    t = erasure_tables(spark)
    requests = spark.createDataFrame([("P1", "T1"), ("P9", "T2")], "person_external_id string, ticket_id string")
    new = privacy.erase_person(t, requests, NOW, "me")
    assert rows(new["dim_person"].select("person_external_id", "first_name", "last_name")) == [("P1", "ERASED", "ERASED"), ("P2", "Bo", "Li")]
    e = {r.worker_id: r for r in new["dim_employee"].collect()}
    assert e["W2"].work_email == f"erased+{e['W2'].employee_key}@example.invalid" and e["W3"].first_name == "Ann"
    assert rows(new["raw_workers"].select("_source_record_id")) == [("W3",)]
    assert rows(new["raw_persons"].select("_source_record_id")) == [("P2",)]
    assert rows(new["raw_profile_versions"]) == rows(t["raw_profile_versions"])
    assert [(r.ticket_id, r.person_external_id, r.executed_by) for r in new["erasure_log"].collect()] == [("T1", "P1", "me")]
    assert new["erasure_log"].columns == [f.name for f in privacy.ERASURE_LOG_SCHEMA]
    assert privacy.stability_check(t["dim_employee"], new["dim_employee"], ["current_department", "hire_date"]).count() == 0
    assert rows(privacy.stability_check(t["raw_workers"], new["raw_workers"], ["_source_record_id"])) == [("W1", 1, 0), ("W2", 1, 0)]


def test_erase_unknown_person_changes_nothing(spark):
    t = erasure_tables(spark)
    requests = spark.createDataFrame([("P9", "T2")], "person_external_id string, ticket_id string")
    new = privacy.erase_person(t, requests, NOW, "me")
    assert new["erasure_log"].count() == 0
    for name in t:
        assert rows(new[name].select(t[name].columns)) == rows(t[name])


def test_erase_all_scope_and_guard(spark):
    t = erasure_tables(spark)
    requests = spark.createDataFrame([("P1", "T1")], "person_external_id string, ticket_id string")
    new = privacy.erase_person(t, requests, NOW, "me", scope="all")
    got = {r._source_record_id: (json.loads(r.raw_payload), r._is_erased) for r in new["raw_profile_versions"].collect()}
    assert got["v1"] == ({"person_external_id": "P1", "first_name": "__ERASED__", "worker_ids": [], "fte": 1.0, "email": None}, True)
    assert got["v2"][0]["first_name"] == "Ann" and got["v2"][1] is False
    clean, blocked = privacy.guard_erased(t["raw_persons"], new["erasure_log"])
    assert (rows(clean.select("_source_record_id")), rows(blocked.select("_source_record_id"))) == ([("P2",)], [("P1",)])
    # Worker, version and event rows of an erased person are held back too, with and without the person's id in them.
    aliases = spark.createDataFrame([("P1", "W1", "C1"), ("P2", "W3", None)], "person_external_id string, worker_id string, candidate_id string")
    late = spark.createDataFrame(
        [
            ("workers", "W1", "{}"),
            ("workers", "W3", '{"person_external_id": "P2", "first_name": "Bo"}'),
            ("workers", "W9", '{"person_external_id": "P1", "first_name": "Ann"}'),
            ("employment_events", "E1", '{"worker_id": "W1"}'),
            ("employment_events", "W1", '{"worker_id": "W3"}'),
            ("candidates", "C1", '{"email": "a@b"}'),
            ("applications", "A1", '{"candidate_id": "C1"}'),
            ("applications", "A2", '{"candidate_id": "C2"}'),
        ],
        "_source_object string, _source_record_id string, raw_payload string",
    )
    clean, blocked = privacy.guard_erased(late, new["erasure_log"], aliases)
    pick = lambda df: {(r._source_object, r._source_record_id) for r in df.collect()}
    assert pick(clean) == {("workers", "W3"), ("employment_events", "W1"), ("applications", "A2")}
    assert clean.columns == blocked.columns == late.columns and clean.count() + blocked.count() == late.count()
    stones = {(r._source_object, r._source_record_id): r for r in privacy.tombstone_erased(late, new["erasure_log"], aliases).collect()}
    assert "Ann" not in stones["workers", "W9"].raw_payload and json.loads(stones["candidates", "C1"].raw_payload) == {"email": "__ERASED__"}
    assert {k for k, r in stones.items() if r._is_erased} == pick(blocked)


def test_suppression_and_retention(spark):
    df = spark.createDataFrame([("a", 4, 1.0), ("b", 5, 2.0)], "g string, n int, score double")
    assert rows(privacy.suppress_small(df, "n", ["score"])) == [("a", 4, None, "below_threshold"), ("b", 5, 2.0, None)]
    raw = spark.createDataFrame([(ts("2022-04-30"),), (ts("2022-05-01"),)], "_ingested_at_utc timestamp")
    assert privacy.retain(raw, 25, dt.date(2024, 6, 1)).count() == 1


def test_reconcile_and_restate(spark):
    a = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string")
    b = spark.createDataFrame([("2",), ("3",), (None,)], "id string")
    assert rows(reconcile.reconcile(a, b, ["id"])) == [("1", "missing"), ("3", "extra")]
    assert rows(reconcile.mark_deleted(b, a, ["id"])) == [("2", False), ("3", True), (None, False)]
    old = spark.createDataFrame([("m1", 1), ("m2", None), ("m3", 3)], "k string, n int")
    new = spark.createDataFrame([("m1", 2), ("m2", None), ("m4", 4)], "k string, n int")
    out = reconcile.restate(old, new, ["k"], ["n"], NOW, "why")
    assert [(r.k, r.change, r.old_n, r.n) for r in out.orderBy("k").collect()] == [("m1", "changed", 1, 2), ("m3", "removed", 3, None), ("m4", "added", None, 4)]
    assert {r.restatement_reason for r in out.collect()} == {"why"}


def registry(spark, data):
    return spark.createDataFrame(
        [(f"key-{i}", "s", "o", i, p, "seed", 1.0, NOW, None) for i, p in data],
        """bridge_person_source_key string, source_system string, source_object string, source_record_id string,
           person_key string, match_method string, match_confidence double, created_at_utc timestamp, updated_at_utc timestamp""",
    )


def test_registry_upsert(spark):
    later = NOW + dt.timedelta(days=1)
    matches = spark.createDataFrame([("s", "o", "1", "Q", "email", 0.9), ("s", "o", "2", "R", "email", 0.9)], "source_system string, source_object string, source_record_id string, resolved_person_key string, match_method string, match_confidence double")
    out = {r.source_record_id: r for r in identity.upsert_registry(registry(spark, [("1", "P"), ("3", "S")]), matches, later).collect()}
    assert (out["1"].person_key, out["1"].created_at_utc, out["1"].updated_at_utc, out["1"].bridge_person_source_key) == ("Q", NOW, later, "key-1")
    assert (out["2"].person_key, out["2"].created_at_utc, out["2"].updated_at_utc) == ("R", later, None)
    assert (out["3"].person_key, out["3"].match_method) == ("S", "seed")


def test_match_cascade(spark):
    incoming = spark.createDataFrame([("s", "o", i, e) for i, e in [("1", "x@x"), ("2", " ANN@x "), ("3", "dup@x"), ("4", None), ("5", "none@x")]], "source_system string, source_object string, source_record_id string, email string")
    emails = spark.createDataFrame([("ann@x", "P2"), ("dup@x", "P3"), ("dup@x", "P4"), (None, "P0")], "email string, person_key string")
    links = spark.createDataFrame([("4", "P5"), ("2", "P9")], "source_record_id string, person_key string")
    resolved, review = identity.match_identities(incoming, registry(spark, [("1", "P1")]), emails, links)
    got = {r.source_record_id: (r.match_method, r.resolved_person_key) for r in resolved.collect()}
    assert got["1"] == ("existing_mapping", "P1") and got["2"] == ("email", "P2") and got["4"] == ("hire_link", "P5")
    assert got["5"][0] == "new_person" and "3" not in got
    assert [r.source_record_id for r in review.collect()] == ["3"]


def test_match_by_employee_number(spark):
    said = [("1", "a@x", "E1"), ("2", None, " e2 "), ("3", None, "E3"), ("4", None, "E9"), ("5", None, None), ("6", None, "")]
    incoming = spark.createDataFrame([("s", "o", *r) for r in said], "source_system string, source_object string, source_record_id string, email string, employee_number string")
    emails = spark.createDataFrame([("a@x", "P1")], "email string, person_key string")
    numbers = spark.createDataFrame([("E1", "P7"), ("E2", "P2"), ("E3", "P3"), ("E3", "P4"), ("", "P0"), (None, "P0")], "employee_number string, person_key string")
    links = spark.createDataFrame([("2", "P8"), ("5", "P5")], "source_record_id string, person_key string")
    resolved, review = identity.match_identities(incoming, registry(spark, [("9", "P9")]), emails, links, numbers)
    got = {r.source_record_id: (r.match_method, r.resolved_person_key) for r in resolved.collect()}
    assert got["1"] == ("email", "P1") and got["2"] == ("employee_number", "P2") and got["5"] == ("hire_link", "P5")
    assert got["4"][0] == got["6"][0] == "new_person" and len(got) == 5
    assert [(r.source_record_id, r.match_method) for r in review.collect()] == [("3", "employee_number")]
    without = identity.match_identities(incoming, registry(spark, [("9", "P9")]), emails, links)[0]
    assert {r.source_record_id: r.match_method for r in without.collect()}["2"] == "hire_link"


def _roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    r = random.Random(seed)
    pairs = [(a, a + 1) for a in r.sample(range(300), 200)]  # paths
    pairs += [(400, 400 + i) for i in r.sample(range(80), 60)] + [(500 + i, 560) for i in range(40)]  # stars onto small and large nodes
    pairs += [(r.randrange(600, 680), r.randrange(600, 680)) for _ in range(50)] + [(700, 701), (701, 702), (702, 700), (900, 900)]
    pairs += pairs[:30]
    want = {x: y for x, y in _roots(pairs).items() if x != y}
    links = spark.createDataFrame([*pairs, (None, 1), (5, None)], "a long, b long")
    assert dict(map(tuple, components(links).collect())) == want
    assert components(links.limit(0)).count() == 0


def test_identity_graph_finds_persons_and_conflicts(spark):
    said = [
        ("1", "a", None, "E1", None), ("2", "a", "x", None, None), ("3", None, "x", "E1", "P5"),
        ("4", "b", None, "E2", None), ("5", "b", None, "E3", None),
        ("6", "c", None, None, "P1"), ("7", "c", None, None, "P2"), ("8", None, None, None, None), ("9", None, None, None, "P2"),
    ]
    df = spark.createDataFrame([("s", "o", *r) for r in said], "source_system string, source_object string, source_record_id string, mail string, phone string, number string, person string")
    out = {r.source_record_id: r for r in identity.identity_graph(df, ["mail", "phone"], ["number"], known="person").collect()}
    assert {i for i in out if out[i].conflict} == {"4", "5", "6", "7", "9"} and len(out) == 9
    assert {out[i].person_key for i in "123"} == {"P5"} and {out[i].records for i in "123"} == {3}
    assert {out[i].reason for i in "45"} == {"number"} and {out[i].reason for i in "679"} == {"person"}
    assert out["8"].records == 1 and out["8"].reason is None
    alone = identity.identity_graph(df, ["number"])
    assert len({r.person_key for r in alone.collect()}) == 8 and not any(r.conflict for r in alone.collect())
    assert identity.identity_graph(df.limit(0), ["mail"]).count() == 0


def test_offer_fallback_link_needs_one_worker(spark):
    offers = spark.createDataFrame([("o1", "A", ts("2024-01-15")), ("o2", "B", ts("2024-01-15")), ("o3", "A", ts("2024-03-01"))], "offer_id string, dep string, responded_at timestamp")
    w = spark.createDataFrame([("W1", "A", d("2024-01-29")), ("W2", "B", d("2024-01-10")), ("W3", "B", d("2024-01-20")), ("W4", "A", d("2024-01-30"))], "worker_id string, dep string, hire_date date")
    out = identity.link_offers_by_window(offers, w, ["dep"])
    assert [(r.offer_id, r.worker_id) for r in out.collect()] == [("o1", "W1")]


def test_stream_lands_each_event_once_across_runs(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    first = spark.createDataFrame([(1, ts("2024-01-01 00:00:00")), (2, ts("2024-01-01 01:00:00")), (1, ts("2024-01-01 00:00:00"))], "id int, at timestamp")
    first.write.parquet(src)
    run = lambda: land_events(read_events(spark, src, first.schema), out, cp).awaitTermination()
    once = lambda: first_deliveries(spark.read.parquet(out), "id", "at")
    run()
    assert rows(once().select("id")) == [(1,), (2,)]
    # Late first deliveries, weeks behind what came before, land like any other.
    again = spark.createDataFrame([(2, ts("2024-01-01 01:00:00")), (3, ts("2023-11-01 02:00:00"))], first.schema)
    again.write.mode("append").parquet(src)
    run()
    landed = once()
    assert rows(landed.select("id")) == [(1,), (2,), (3,)] and spark.read.parquet(out).count() == 5
    day = ts("2024-01-01 12:00:00")
    assert rows(check_deliveries(spark.read.parquet(out), "id", "at", day)) == [(4, 2)]
    assert check_deliveries(landed, "id", "at", day).count() == 0
    full = first.unionByName(again).unionByName(spark.createDataFrame([(9, NOW)], first.schema))
    assert rows(reconcile_events(full, landed, ["id"])) == [(9, "missing")]
