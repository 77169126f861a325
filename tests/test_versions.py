"""What rests on the commit log: registry in buckets, digest trees, restatement by month."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import d

from hrflow.functions import surrogate_key
from hrflow.operators.digests import differing_buckets, digest_tree, reconcile_stored, restate_stored, store_with_digests
from hrflow.operators.identity import REGISTRY_KEYS, upsert_registry
from hrflow.operators.reconcile import reconcile, restate
from hrflow.operators.registry import SCHEMA, merge_registry, read_registry
from hrflow.operators.snapshot import daily_totals
from hrflow.plans.restatement import clipped, dirty_months, publish_daily, read_daily, restate_months, runs_of
from hrflow.sources.commits import CommitLog, Conflict

NOW, LATER = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def matches(spark, ids, person):
    rows = [("crm", "contacts", i, f"{person}{i}", "email", 1.0) for i in ids]
    return spark.createDataFrame(rows, "source_system string, source_object string, source_record_id string, resolved_person_key string, match_method string, match_confidence double")


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_merge_rewrites_touched_buckets_alone(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert read_registry(log).count() == 0
    first, second = matches(spark, [f"r{i}" for i in range(200)], "p"), matches(spark, ["r7", "r8", "new"], "q")
    merge_registry(log, first, NOW, "run-1", buckets=32)
    before = {e.part: e.path for e in log.state().entries["bridge_person_source"]}
    version = merge_registry(log, second, LATER, "run-2", buckets=32)
    after = {e.part: e.path for e in log.state().entries["bridge_person_source"]}
    changed = {p for p in after if after[p] != before.get(p)}
    assert len(before) > 25 and 1 <= len(changed) <= 3
    full = upsert_registry(upsert_registry(spark.createDataFrame([], SCHEMA), first, NOW), second, LATER)
    same(full, read_registry(log))
    assert read_registry(log).where(F.col("bridge_person_source_key") != surrogate_key(*REGISTRY_KEYS)).count() == 0
    assert merge_registry(log, matches(spark, ["r1"], "z"), LATER, "run-2", buckets=32) == version
    same(upsert_registry(spark.createDataFrame([], SCHEMA), first, NOW), read_registry(log, 1))
    with pytest.raises(ValueError, match="32 buckets"):
        merge_registry(log, second, LATER, "run-3", buckets=64)
    with pytest.raises(Conflict):  # made from version 1, whose bucket is gone
        log.commit("run-4", remove=[e for e in log.state(1).entries["bridge_person_source"] if e.part in changed & set(before)], since=1)


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, part string, v string")


def test_digests_find_differing_leaves(spark):
    rows = [(i, None if i % 5 == 0 else "x", f"v{i}") for i in range(500)]
    r = random.Random(1)
    base = digest_tree(table(spark, rows), ["id", "part"], ["v"])
    mixed = r.sample(rows, len(rows))
    assert differing_buckets(base, digest_tree(table(spark, mixed).repartition(3), ["id", "part"], ["v"]), by_rows=True) == []
    other = [x for x in rows if x[0] != 3] + [(900, "x", "v"), rows[4]]
    assert 2 <= len(differing_buckets(base, digest_tree(table(spark, other), ["id", "part"], ["v"]))) <= 3
    value = [(i, p, "new" if i == 9 else v) for i, p, v in rows]
    tree = digest_tree(table(spark, value), ["id", "part"], ["v"])
    assert differing_buckets(base, tree) == [] and len(differing_buckets(base, tree, by_rows=True)) == 1
    swapped = digest_tree(table(spark, [(1, None, "a"), (2, "a", None)]), ["id"], ["part", "v"])
    assert len(differing_buckets(swapped, digest_tree(table(spark, [(1, "a", None), (2, None, "a")]), ["id"], ["part", "v"]), by_rows=True)) == 2
    assert tree.where("level = 0").first().n == 500 and digest_tree(table(spark, []), ["id"]).count() == 0


def test_stored_tables_compare_as_whole_ones(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    old = table(spark, [(i, "x", f"v{i}") for i in range(400)] + [(None, "x", "n")])
    new = table(spark, [(i, "x", "changed" if i == 11 else f"v{i}") for i in range(3, 402)])
    for name, df in (("old", old), ("new", new), ("none", table(spark, []))):
        store_with_digests(log, df, name, ["id"], f"store-{name}", ["part", "v"])
    found = reconcile_stored(log, "new", "old", ["id"])
    same(reconcile(new, old, ["id"]), found)
    files = len(log.read("new").inputFiles()) + len(log.read("old").inputFiles())
    assert 0 < len(found.inputFiles()) <= 20 < files
    same(restate(old, new, ["id"], ["part", "v"], NOW, "late"), restate_stored(log, "old", "new", ["id"], ["part", "v"], NOW, "late"))
    assert reconcile_stored(log, "old", "old", ["id"]).count() == 0 and not reconcile_stored(log, "old", "old", ["id"]).inputFiles()
    same(reconcile(old, table(spark, []), ["id"]), reconcile_stored(log, "old", "none", ["id"]))


def intervals(spark, rows):
    return spark.createDataFrame([(e, p, d(a), d(b)) for e, p, a, b in rows], "employee string, department string, from_date date, to_date date")


def by_day(df):
    return daily_totals(df, {}, ["department"])


@pytest.mark.parametrize("seed", range(3))
def test_restated_months_equal_a_full_rebuild(spark, tmp_path, seed):
    r = random.Random(seed)
    first, last = dt.date(2023, 1, 1), dt.date(2024, 12, 31)
    day = lambda: first + dt.timedelta(days=r.randint(0, 730))
    spans = [(f"e{i}", r.choice(["A", "B", None]), *map(str, sorted((day(), day())))) for i in range(30)]
    edited = [x for i, x in enumerate(spans) if i not in (3, 4)]
    edited += [("e3", "A", spans[3][2], spans[3][3]), ("e99", "C", "2023-05-10", "2023-07-02"), ("e98", "B", "2024-02-29", "2024-02-29")]
    old, new = intervals(spark, spans), intervals(spark, edited)
    log = CommitLog(spark, str(tmp_path))
    publish_daily(log, "mart", by_day(old), "snapshot_date", "v1", tag="board")
    months = dirty_months(old, new, ["employee", "department"], "from_date", "to_date", first, last)
    odd = [x for x in spans if x not in edited] + [x for x in edited if x not in spans]
    covered = {m for _, _, a, b in odd for m in {(d(a) + dt.timedelta(days=k)).replace(day=1) for k in range((d(b) - d(a)).days + 1)}}
    assert months == sorted(covered)
    asked = []

    def rebuild(a, b):
        asked.append((a, b))
        return by_day(clipped(new, a, b))

    before = {e.part: e.path for e in log.state().entries["mart"]}
    for _ in range(2):  # the second call changes nothing
        assert restate_months(log, "mart", rebuild, months, "snapshot_date", ["department"], "v2", LATER, "back_dated") == 2
    after = {e.part: e.path for e in log.state().entries["mart"]}
    assert asked == runs_of(months) and {p for p in before if after.get(p) != before[p]} <= {m.strftime("%Y-%m") for m in months}
    now = read_daily(log, "mart")
    same(by_day(new), now)
    same(by_day(old), read_daily(log, "mart", "board"))
    key = lambda df: {(x.snapshot_date, x.department): x.n for x in df.collect()}
    was = key(by_day(old))
    for x in now.collect():
        differs = was.get((x.snapshot_date, x.department)) != x.n
        assert (x.restatement_reason, x.restated_at_utc) == (("back_dated", LATER) if differs else (None, None))


def test_nothing_to_restate(spark, tmp_path):
    same_rows = intervals(spark, [("a", "A", "2024-01-05", "2024-01-09"), ("a", "A", "2024-01-05", "2024-01-09")])
    bounds = ("from_date", "to_date", dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert dirty_months(same_rows, same_rows, ["employee"], *bounds) == []
    open_ = intervals(spark, [("a", "A", None, "2024-02-09"), ("b", "B", "2024-11-30", None), ("c", "C", "2025-02-01", None)])
    assert [m.month for m in dirty_months(open_, same_rows.limit(0), ["employee"], *bounds)] == [1, 2, 11, 12]
    log = CommitLog(spark, str(tmp_path))
    publish_daily(log, "mart", by_day(same_rows), "snapshot_date", "v1")
    assert restate_months(log, "mart", lambda a, b: None, [], "snapshot_date", [], "v2", LATER, "none") == 2
    same(by_day(same_rows), read_daily(log, "mart"))


def moment(text):
    return dt.datetime.fromisoformat(text)


def test_replay_orders_versions_and_deletions(spark):
    v = [(1, "2024-01-01", "a"), (1, "2024-01-05", "b"), (1, "2024-01-05 12:00:00", "c"), (2, "2024-01-01", "x"), (3, "2024-02-01", "y"), (None, "2024-01-01", "n")]
    e = [(1, "2024-01-03"), (1, "2024-01-04"), (2, "2024-01-01"), (3, "2024-01-15"), (9, "2024-01-01"), (None, "2024-03-01")]
    versions = spark.createDataFrame([(i, moment(t), x) for i, t, x in v], "id long, at timestamp, name string")
    events = spark.createDataFrame([(i, moment(t)) for i, t in e], "id long, at timestamp")
    from hrflow.operators.supersede import deletions, mark_inactive, replay

    found = replay(versions, events, ["id"], "at")
    got = {r.name: (str(r.valid_to) if r.valid_to else None, r.closed_by, r.is_active) for r in found.collect()}
    assert got["a"] == ("2024-01-03 00:00:00", "deletion", False) and got["b"] == ("2024-01-05 12:00:00", "version", False)
    assert got["c"] == (None, None, True) == got["y"] and got["x"] == ("2024-01-01 00:00:00", "deletion", False) and len(got) == 6
    dim = spark.createDataFrame([(1, "k"), (2, "k"), (3, "k"), (7, "k")], "id long, more string")
    marked = {r.id: (r.is_active, r.inactive_since) for r in mark_inactive(dim, found, ["id"]).collect()}
    assert marked == {1: (True, None), 2: (False, moment("2024-01-01")), 3: (True, None), 7: (True, None)}
    gone = deletions(versions, versions.where("id = 1"), ["id"], NOW, "at").collect()
    assert sorted((str(r.id), r["at"]) for r in gone) == [("2", NOW), ("3", NOW), ("None", NOW)]


def test_erasure_rewrites_only_files_that_may_hold_the_person(spark, tmp_path):
    from hrflow.operators.file_index import erase_in_files, files_that_may_hold, index_files

    log = CommitLog(spark, str(tmp_path))
    rows = spark.range(3000).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("person"), F.lit("clear").alias("name"))
    nobody = spark.createDataFrame([(None, "clear")], "person string, name string")
    log.run("a", lambda: {"t": rows.repartition(12, "person")})
    log.run("b", lambda: {"t": nobody})
    index_files(log, "t", lambda: F.col("person"), "index-1")
    wanted = spark.createDataFrame([("P5",), ("P1234",), ("unknown",), (None,)], "person string")
    files = lambda: {p for p in log.read("t").inputFiles()}
    before = files()
    holding = {r[0] for r in log.read("t").where("person in ('P5', 'P1234')").select("_metadata.file_path").distinct().collect()}
    admitted = files_that_may_hold(log.read("t__files"), wanted, "person")
    assert all(any(h.endswith(a) for a in admitted) for h in holding) and len(admitted) <= len(holding) + 2 < len(before)
    name = F.when(F.col("person").isin("P5", "P1234"), "erased").otherwise(F.col("name"))
    version, gone = erase_in_files(log, "t", wanted, "person", lambda df: df.withColumn("name", name), "erase")
    assert gone == admitted and len(before - files()) == len(gone)
    same(rows.unionByName(nobody).withColumn("name", name), log.read("t"))
    assert erase_in_files(log, "t", wanted, "person", lambda df: df, "erase") == (version, [])
    log.run("c", lambda: {"t": rows.where("person = 'P5'")})  # landed again, in no index yet
    erase_in_files(log, "t", wanted, "person", lambda df: df.withColumn("name", name), "erase-2")
    assert log.read("t").where("person = 'P5' and name = 'clear'").count() == 0
    index_files(log, "t", lambda: F.col("person"), "index-2")
    log.sweep(keep_versions=1, older_than_ms=-1)
    assert spark.read.parquet(f"{tmp_path}/data/t/*").where("person = 'P1234' and name = 'clear'").count() == 0
    assert log.read("t").count() == 3002
