from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hrflow.operators.dedupe import latest, latest_record
from hrflow.operators.storage import SHUFFLE_CLEANUP, Rounds, cut_lineage, materialize, scratch_scope, shared_folder
from hrflow.sources import landing
from hrflow.sources.documents import as_documents, field_text, read_documents, unfurl
from hrflow.sources.flatten import BASE_MODELS, SOURCE_OBJECTS, base_model
from hrflow.sources.ingest import extract_objects, ingest, raw_tables, rejected
from tests.helpers import plan, rows

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def stamp(df, run="r1", at=T1, id_col="id", **kw):
    return landing.stamp(df, "sys", "obj", run, id_col, at, **kw)


def docs(spark, data):
    return spark.createDataFrame(data, "id string, v string, source_updated_at string")


def test_land_stamps_metadata_and_stable_hash(spark):
    df = docs(spark, [("a", "x", "2024-01-01T00:00:00Z"), (None, None, None)])
    raw = stamp(df)
    assert tuple(raw.columns) == landing.METADATA_COLUMNS
    a, b = sorted(raw.collect(), key=lambda r: r["_source_record_id"], reverse=True)
    assert (a["_source_record_id"], b["_source_record_id"]) == ("a", "")
    assert a["_source_updated_at"] == dt.datetime(2024, 1, 1) and b["_source_updated_at"] is None
    assert len(a["_payload_hash"]) == 64 and json.loads(b["raw_payload"]) == {"id": None, "v": None, "source_updated_at": None}
    reordered = stamp(df.select("v", "source_updated_at", "id"))
    assert rows(raw.select("_payload_hash")) == rows(reordered.select("_payload_hash"))


def test_append_and_truncate(spark, tmp_path):
    raw, path = stamp(docs(spark, [("a", "x", None)])), str(tmp_path / "raw")
    landing.land(raw, path)
    landing.land(raw, path)
    assert spark.read.parquet(path).count() == 2
    assert spark.read.parquet(path).dropDuplicates(["_source_record_id"]).count() == 1
    landing.land(raw, path, truncate_first=True)
    assert spark.read.parquet(path).count() == 1
    assert landing.raw_table("hris", "workers") == "raw.hris__workers"


def test_latest_prefers_newer_then_dated_then_hash(spark):
    old, new = ("a", "old", "2024-01-01T00:00:00Z"), ("a", "new", "2024-02-01T00:00:00Z")
    undated, dated = ("b", "undated", None), ("b", "dated", "2020-01-01T00:00:00Z")
    ties = [("c", str(i), "2024-01-01T00:00:00Z") for i in range(20)]
    raw = stamp(docs(spark, [new, old, undated, dated, *ties]))
    keep = latest_record(raw)
    shuffled = latest_record(raw.orderBy(F.rand(3)).repartition(5))
    assert rows(keep) == rows(shuffled) and keep.count() == 3
    values = {json.loads(r["raw_payload"])["v"] for r in keep.collect()}
    assert {"new", "dated"} < values
    hashes = [r[0] for r in raw.where("_source_record_id = 'c'").select("_payload_hash").collect()]
    assert keep.where("_source_record_id = 'c'").first()["_payload_hash"] == max(hashes)


def test_latest_limits_each_group_before_the_shuffle(spark):
    text = plan(latest(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], [F.col("id").desc()]))
    assert text.count("WindowGroupLimit") == 2


def test_landing_twice_gives_the_same_base(spark):
    df = docs(spark, [(str(i), "x", "2024-01-01T00:00:00Z") for i in range(10)])
    once, twice = latest_record(stamp(df)), latest_record(stamp(df).unionByName(stamp(df, "r2", T2)))
    assert rows(once.select("_source_record_id", "raw_payload")) == rows(twice.select("_source_record_id", "raw_payload"))
    assert {r[0] for r in twice.select("_run_id").collect()} == {"r2"}


@pytest.mark.parametrize("lines", [True, False])
def test_read_and_unfurl(spark, tmp_path, lines):
    docs = [
        {"worker_id": "W1", "profile_history": [{"effective_date": "2024-01-01", "fte": 1.0}, {"effective_date": "2024-02-01", "fte": 0.5}]},
        {"worker_id": "W2", "profile_history": []},
        {"worker_id": "W3", "profile_history": None},
        {"worker_id": "W4"},
    ]
    path = tmp_path / "workers.json"
    path.write_text("\n".join(map(json.dumps, docs)) if lines else json.dumps(docs))
    df = read_documents(spark, str(path), multiline=not lines)
    assert df.where("reject is not null").count() == 0
    parents, children = unfurl(df, "profile_history", ["worker_id"], ("profile_version_id", ["worker_id", "effective_date"]), F.lit("now"))
    assert [sorted(json.loads(r[0])) for r in parents.select(F.to_json("doc")).collect()] == [["worker_id"]] * 4
    names = ("profile_version_id", "worker_id", "effective_date", "fte", "source_updated_at")
    assert rows(children.select(*[field_text(n).alias(n) for n in names])) == [
        ("W1|2024-01-01", "W1", "2024-01-01", "1", "now"),
        ("W1|2024-02-01", "W1", "2024-02-01", "0.5", "now"),
    ]


TYPED = """id string, n bigint, small int, ok boolean, day date, at timestamp, raw binary, x double, money decimal(15,2), `a.b` string,
    nested struct<z:string,a:int,m:struct<y:date,b:string>>, list array<struct<k:string,a:bigint>>, words array<string>,
    prices array<double>, pairs map<string,string>, source_updated_at string"""


def typed(spark):
    day, at = dt.date(2024, 2, 29), dt.datetime(2024, 1, 1, 9, 30, 0, 120000)
    nested, items = ("q", 1, (day, None)), [("k", 5), None, (None, None)]
    odd = 'tab\t "quoted" \\ / \u00e9 \u2028 \x01 \U0001f600 </a>'
    return spark.createDataFrame(
        [
            ("a", 5, 1, True, day, at, b"\x00x", 100.0, Decimal("12.50"), "p", nested, items, ["b", None, "a"], [1.0, 0.1], {"z": "1", "a": "2"}, "2024-01-01T00:00:00Z"),
            (odd, -(2**63), 0, False, day, at, b"", 1e300, Decimal("100.00"), odd, (None, None, None), [], [], [], {}, "x"),
            ("nan", 0, 0, None, None, None, None, float("nan"), Decimal("0.00"), "", None, None, [odd], None, None, ""),
            (None,) * 16,
        ],
        TYPED,
    )


@pytest.mark.parametrize("id_col", ["id", "n", "ok", "day", "x", "money", "a.b", "nested", "missing"])
def test_typed_rows_land_as_their_documents(spark, id_col):
    df = typed(spark)
    fast, slow = stamp(df, id_col=id_col), stamp(as_documents(df), id_col=id_col)
    assert rows(fast) == rows(slow) and fast.schema.simpleString() == slow.schema.simpleString()
    assert "parse_json" not in plan(stamp(df.select("id", "n", "nested", "list", "source_updated_at")))


def test_typed_rows_unfurl_as_their_documents(spark):
    df = typed(spark)
    args = ("list", ["id", "n", "a.b", "a"], ("child", ["id", "k", "a", "none"]))
    fast, slow = unfurl(df, *args), unfurl(as_documents(df), *args)
    for own, other in zip(fast, slow, strict=True):
        assert rows(stamp(own, id_col="child").select("_source_record_id", "raw_payload")) == rows(
            stamp(other, id_col="child").select("_source_record_id", "raw_payload")
        )
    assert dict(fast[1].dtypes) == {"id": "string", "n": "bigint", "a.b": "string", "k": "string", "a": "bigint", "child": "string", "source_updated_at": "string"}
    timed = unfurl(df, "list", ["id"], ("child", ["k"]), F.lit("now"))[1]
    assert {r.source_updated_at for r in timed.collect()} == {"now"}


def test_bad_lines_are_kept_as_rejects(spark, tmp_path):
    bad = ['{"a": 1', '{"a": 1} xyz', '{"a": 1}{"b": 2}', '{"a": 1}, {"b": 2}', "[1]", "null", '"x"', "[", "{"]
    (tmp_path / "x.json").write_text("\n".join(['{"id": "1"}', *bad, "  ", '{"id": "2"}', "{}"]))
    docs = read_documents(spark, str(tmp_path / "x.json"))
    assert sorted(r[0] for r in docs.where("reject is not null").select("reject").collect()) == sorted(bad)
    assert stamp(docs).count() == 3
    kept = landing.rejects(docs, "s", "o", "r1", T1)
    assert kept.count() == len(bad) and kept.columns[-1] == "raw_text"


@pytest.mark.parametrize("text", ['[{"a": 1}, {"b":', '[{"a": 1}', '[{"a": 1}] junk', '[{"a": 1}, 5]', '{"a": 1}', "", "null"])
def test_bad_arrays_stop_the_run(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text or " ")
    with pytest.raises(Exception, match="(?i)malformed|not one JSON array|failed_read_file|infer"):
        read_documents(spark, str(tmp_path / "x.json"), multiline=True).collect()


def test_large_array_lands_in_full(spark, tmp_path):
    n, filler = 160_000, "x" * 900
    (tmp_path / "x.json").write_text("[" + ",\n".join(f'{{"id": "{i}", "v": "{filler}"}}' for i in range(n)) + "]")
    assert (tmp_path / "x.json").stat().st_size > 145_000_000
    assert stamp(read_documents(spark, str(tmp_path / "x.json"), multiline=True)).count() == n
    (tmp_path / "y.json").write_text('[{"id": "1", "a b.c": {"x": [1, null]}}, {"id": null, "z`": 2.50}, {}]')
    texts = [r[0] for r in read_documents(spark, str(tmp_path / "y.json"), multiline=True).select(F.to_json("doc", {"ignoreNullFields": "false"})).collect()]
    assert texts == ['{"id":"1","a b.c":{"x":[1,null]}}', '{"id":null,"z`":2.5}', "{}"] or [json.loads(x) for x in texts] == [
        {"id": "1", "a b.c": {"x": [1, None]}}, {"id": None, "z`": 2.5}, {},
    ]


def raw_json(spark, obj, payload):
    return spark.createDataFrame(
        [(T1, "s", obj, "r1", "full", "X1", T1, "h", json.dumps(payload))],
        """_ingested_at_utc timestamp, _source_system string, _source_object string, _run_id string,
           _extract_mode string, _source_record_id string, _source_updated_at timestamp, _payload_hash string,
           raw_payload string""",
    )


def test_flatten_types_and_forgiving_casts(spark):
    payload = {"hire_date": "2024-01-05", "termination_date": "soon", "current_fte": 0.6, "is_active": True, "extra": 1}
    r = base_model(raw_json(spark, "workers", payload), "workers").first()
    assert (r.worker_id, r.hire_date, r.termination_date, r.current_fte, r.is_active_in_source, r.first_name) == (
        "X1", dt.date(2024, 1, 5), None, 0.6, True, None,
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        base_model(raw_json(spark, "workers", {"hire_date": "soon"}), "workers").collect()


def test_arrays_stay_json_text(spark):
    r = base_model(raw_json(spark, "persons", {"worker_ids": ["W1", "W2"]}), "persons").first()
    assert r.worker_ids_json == '["W1","W2"]'


def test_every_source_object_has_a_base_model(spark):
    assert {o for objs in SOURCE_OBJECTS.values() for o in objs} == set(BASE_MODELS)
    for obj, (id_name, fields) in BASE_MODELS.items():
        df = base_model(raw_json(spark, obj, {}), obj)
        assert df.columns == [id_name, *[f.name for f in fields], "source_updated_at", "ingested_at_utc", "ingested_run_id"]


def test_only_changed_compares_with_the_newest_version(spark):
    v = lambda x, t: docs(spark, [("a", x, t)])
    landed = stamp(v("1", "2024-01-01T00:00:00Z")).unionByName(stamp(v("2", "2024-01-02T00:00:00Z"), "r2", T2))
    again = stamp(v("2", "2024-01-02T00:00:00Z"), "r3")
    back = stamp(v("1", "2024-01-01T00:00:00Z"), "r3")
    assert landing.only_changed(again, landed).count() == 0
    assert landing.only_changed(back, landed).count() == 1
    assert landing.only_changed(stamp(docs(spark, [("z", "1", None)])), landed).count() == 1
    assert landing.only_changed(stamp(docs(spark, [("z", "1", None)] * 2 + [("z", "2", None)])), landed).count() == 2


def test_watermark(spark):
    df = spark.createDataFrame([(T1,), (T2,), (None,)], "u timestamp")
    assert landing.since_watermark(df, "u", None).count() == 3
    assert rows(landing.since_watermark(df, "u", T1)) == rows(df.where(F.col("u").isNull() | (F.col("u") == T2)))
    assert landing.next_watermark(df, "u").first()[0] == T2


def test_audit_trace_orders_versions(spark):
    raw = stamp(docs(spark, [("W1", "1", None)])).unionByName(stamp(docs(spark, [("W1", "2", None)]), "r2", T2))
    dim = spark.createDataFrame([("W1", "r2")], "worker_id string, ingested_run_id string")
    assert [r["raw_run_id"] for r in landing.audit_trace(dim, raw).collect()] == ["r1", "r2"]


def test_materialize_and_cut_lineage(spark, tmp_path):
    df = spark.range(10).withColumn("m", (F.col("id") % 2).cast("string"))
    view = materialize(df, "v_test")
    assert spark.table("v_test").count() == view.count() == 10
    out = materialize(df, "t_test", "table", str(tmp_path / "t"), ("m",))
    assert rows(out.select("id", "m")) == rows(df)
    spark.sql("drop table t_test")
    cut = cut_lineage(df)
    assert rows(cut) == rows(df) and "Range" not in plan(cut)
    assert shared_folder(spark) == shared_folder(spark)


def test_scratch_goes_with_its_scope(spark):
    def made():
        return {x.rsplit("-", 1)[0] for x in os.listdir(shared_folder(spark).removeprefix("file:"))} & {"outside", "outer", "inner", "broken"}

    cut_lineage(spark.range(3), "outside")
    with scratch_scope(spark):
        outer = cut_lineage(spark.range(10), "outer")
        with scratch_scope(spark):
            assert cut_lineage(outer, "inner").count() == 10 and made() == {"outside", "outer", "inner"}
        assert outer.count() == 10 and made() == {"outside", "outer"}
    assert made() == {"outside"}
    with pytest.raises(RuntimeError), scratch_scope(spark):
        cut_lineage(outer.sparkSession.range(1), "broken")
        raise RuntimeError
    assert made() == {"outside"}


def test_rounds_keep_the_last_table_alone(spark):
    folder = shared_folder(spark).removeprefix("file:")
    count = lambda: sum(x.startswith("rounds-") for x in os.listdir(folder))
    rounds, before = Rounds("rounds"), count()
    df = rounds.save(spark.range(1, 5))
    for _ in range(3):
        df = rounds.save(df.selectExpr("id * 2 as id"))
    assert count() == before + 1 and sorted(r.id for r in df.collect()) == [8, 16, 24, 32]


def test_shared_folder_must_be_configured_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_extract_files_are_parsed_once(spark, tmp_path):
    """Parents, children and rejects come from stored documents, which are gone after the run."""
    folder = tmp_path / "in"
    folder.mkdir()
    history = [{"effective_date": "2024-01-01", "worker_id": "own", "source_updated_at": "x"}, None, {"effective_date": "2024-02-01"}]
    lines = [
        {"worker_id": "w1", "person_external_id": "p1", "extra": 1, "profile_history": history},
        {"worker_id": "w2", "profile_history": []},
        {"worker_id": "w3", "profile_history": None},
        {"worker_id": "w4"},
    ]
    (folder / "workday_workers.json").write_text("\n".join([*map(json.dumps, lines), '{"worker_id": "cut']))
    for name in ("persons", "employment_events"):
        (folder / f"workday_{name}.json").write_text("")
    at = dt.datetime(2024, 6, 1)
    with scratch_scope(spark):
        objects = extract_objects(spark, "hris_workday", str(folder), at)
        assert not [name for name, df in objects.items() if "text" in plan(df) or "from_json" in plan(df)]
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    ingest(spark, "hris_workday", str(folder), str(tmp_path / "raw"), at, "run")
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before
    raw = raw_tables(spark, str(tmp_path / "raw"), ("hris_workday",))
    assert sorted(r._source_record_id for r in raw["workers"].collect()) == ["w1", "w2", "w3", "w4"]
    got = sorted((r._source_record_id, json.loads(r.raw_payload)) for r in raw["profile_versions"].collect())
    stamp = {"source_updated_at": "2024-06-01T00:00:00.000000+00:00", "person_external_id": "p1"}
    assert got == [
        ("own|2024-01-01", {"effective_date": "2024-01-01", "worker_id": "own", "profile_version_id": "own|2024-01-01", **stamp}),
        ("w1|2024-02-01", {"effective_date": "2024-02-01", "worker_id": "w1", "profile_version_id": "w1|2024-02-01", **stamp}),
    ]
    assert [r["count"] for r in rejected(spark, str(tmp_path / "raw")).collect()] == [1]


def test_stored_table_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    table = cut_lineage(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())
    assert not shuffled() - before and table.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
