"""Landing, flattening and deduplication of source records made from the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from hrflow.operators.dedupe import latest_record
from hrflow.operators.quality import check_not_null
from hrflow.operators.storage import materialize, scratch_path
from hrflow.plans import core
from hrflow.plans.reports import q11
from hrflow.sources import landing
from hrflow.sources.commits import CommitLog
from hrflow.sources.documents import as_documents, field_text, unfurl
from hrflow.sources.ingest import REJECTS, ingest, raw_tables
from hrflow.sources.flatten import base_model, json_field, json_field_cast, json_field_try_cast
from hrflow.streaming.events import (
    check_deliveries,
    first_deliveries,
    land_committed,
    land_events,
    read_events,
    reconcile_events,
)
from workload.checks import check, key
from workload.registry import query
from workload.views import AS_OF, table

RUN_1 = dt.datetime(2001, 12, 30, 6)
RUN_2 = dt.datetime(2001, 12, 31, 6)


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def _moment(c: str):
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def job_documents(spark, sf):
    """Parts as requisition documents."""
    p = table(spark, sf, "part")
    return p.select(
        F.concat(F.lit("REQ"), F.col("p_partkey").cast("string")).alias("requisition_id"),
        F.col("p_name").alias("job_title"),
        F.concat(F.lit("IC"), F.col("p_size").cast("string")).alias("job_level"),
        F.nullif("p_brand", F.lit("Brand#3")).alias("department"),
        F.col("p_type").alias("function"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size")).cast("string").alias("opened_at"),
        # An empty text is not a date: the forgiving cast turns it into null.
        F.when(F.col("p_retailprice") > 950, F.date_add(F.lit("1996-01-01").cast("date"), F.col("p_size")).cast("string"))
        .otherwise("")
        .alias("closed_at"),
        F.lit("open").alias("status"),
        F.array(F.concat(F.lit("W"), F.col("p_size").cast("string"))).alias("hired_worker_ids"),
        F.lit("2001-12-29T00:00:00Z").alias("source_updated_at"),
    )


def application_documents(spark, sf):
    """Orders as application documents with their stage history as a nested array."""
    o = table(spark, sf, "orders")
    step = lambda frm, to, days: F.struct(
        F.lit(frm).cast("string").alias("from_stage"),
        F.lit(to).alias("to_stage"),
        F.concat(F.date_format(F.date_add("o_orderdate", days), "yyyy-MM-dd"), F.lit("T09:30:00+00:00")).alias(
            "transitioned_at"
        ),
    )
    history = F.array_compact(
        F.array(
            step(None, "applied", 0),
            F.when(F.col("o_orderstatus") != "O", step("applied", "recruiter_screen", 3)),
            F.when(F.col("o_orderstatus") == "F", step("recruiter_screen", "offer", 10)),
        )
    )
    return o.select(
        F.col("o_orderkey").alias("application_id"),
        F.col("o_custkey").alias("candidate_id"),
        F.col("o_orderpriority").alias("requisition_id"),
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", history).alias("stage_history"),
        _moment("o_orderdate").alias("source_updated_at"),
    )


def event_documents(spark, sf):
    """Orders as HR event documents."""
    o = table(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("E"), F.col("o_custkey").cast("string"), F.lit("-"), F.col("o_orderpriority")).alias("event_id"),
        F.concat(F.lit("W"), F.col("o_custkey").cast("string")).alias("worker_id"),
        F.lower("o_orderstatus").alias("event_type"),
        _day("o_orderdate").alias("effective_date"),
        F.col("o_orderkey").cast("string").alias("job_title"),
        _moment("o_orderdate").alias("source_updated_at"),
    )


_EVENT_JSON = """'{"effective_date":"' || strftime(o_orderdate, '%Y-%m-%d') || '","event_id":"' || id ||
    '","event_type":"' || lower(o_orderstatus) || '","job_title":"' || o_orderkey || '","source_updated_at":"' ||
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00","worker_id":"W' || o_custkey || '"}'"""
_EVENT_RAW = f"""(select timestamp '2001-12-30 06:00:00' as _ingested_at_utc, 'hris_workday' as _source_system,
        'employment_events' as _source_object, 'run-1' as _run_id, 'full' as _extract_mode, id as _source_record_id,
        o_orderdate as _source_updated_at, sha256({_EVENT_JSON}) as _payload_hash, o.*
    from (select *, 'E' || o_custkey || '-' || o_orderpriority as id from orders) o)"""


def event_raw(spark, sf):
    return landing.stamp(
        event_documents(spark, sf), "hris_workday", "employment_events", "run-1", "event_id", RUN_1
    )


@query(
    "land_metadata",
    f"""select _ingested_at_utc, _source_system, _source_object, _run_id, _extract_mode, _source_record_id,
               _source_updated_at, _payload_hash, o_orderkey::varchar as title from {_EVENT_RAW}""",
)
def _land(t, spark, sf):
    """Stamped raw rows; the payload is checked through its hash and one extracted field."""
    raw = event_raw(spark, sf)
    return raw.withColumn("title", F.get_json_object("raw_payload", "$.job_title")).drop("raw_payload")


@query(
    "latest_per_record",
    f"""select _source_record_id, _source_updated_at, _payload_hash, o_orderkey::varchar as title from {_EVENT_RAW}
        qualify row_number() over (partition by _source_record_id
            order by _source_updated_at desc nulls last, _ingested_at_utc desc, _payload_hash desc) = 1""",
)
def _latest(t, spark, sf):
    """Newest version per record id; several orders share an id."""
    return latest_record(event_raw(spark, sf)).select(
        "_source_record_id",
        "_source_updated_at",
        "_payload_hash",
        F.get_json_object("raw_payload", "$.job_title").alias("title"),
    )


@query(
    "flatten_json",
    """select 'REQ' || p_partkey as requisition_id, p_name as job_title, 'IC' || p_size as job_level,
              nullif(p_brand, 'Brand#3') as department, p_type as function_name,
              date '1995-01-01' + p_size as opened_at,
              case when p_retailprice > 950 then date '1996-01-01' + p_size end as closed_at, 'open' as status,
              '["W' || p_size || '"]' as hired_worker_ids_json, timestamp '2001-12-29' as source_updated_at,
              timestamp '2001-12-31 06:00:00' as ingested_at_utc, 'run-2' as ingested_run_id
       from part""",
)
def _flatten(t, spark, sf):
    """Requisitions landed twice as JSON, flattened to typed columns once per id."""
    docs = job_documents(spark, sf)
    old = landing.stamp(docs.withColumn("status", F.lit("stale")), "ats_ashby", "jobs", "run-1", "requisition_id", RUN_1)
    new = landing.stamp(docs, "ats_ashby", "jobs", "run-2", "requisition_id", RUN_2)
    return base_model(old.unionByName(new), "jobs")


@query(
    "flatten_fields",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, json_extract_string(props, '$.k') as k_text,
              try_cast(json_extract_string(props, '$.k') as date) as k_date, json_extract_string(props, '$.none') as none
       from events""",
)
def _flatten_fields(t, spark, sf):
    """Field accessors on the JSON column of the events table."""
    not_a_day = F.when(F.length(json_field("props", "k")) < 4, F.concat(F.lit("x"), json_field("props", "k")))
    return table(spark, sf, "events").select(
        "event_id",
        json_field_cast("props", "k", "bigint").alias("k"),
        json_field("props", "k").alias("k_text"),
        F.coalesce(not_a_day.try_cast("date"), json_field_try_cast(F.to_json(F.struct("value")), "none", "date")).alias(
            "k_date"
        ),
        json_field("props", "none").alias("none"),
    )


@query(
    "unfurl_children",
    """select o_orderkey || '|' || moment || '|' || to_stage as stage_event_id, o_orderkey as application_id,
              o_custkey as candidate_id, o_orderpriority as requisition_id, from_stage, to_stage, moment as transitioned_at,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' as source_updated_at
       from (select *, strftime(cast(o_orderdate as date) + add_days, '%Y-%m-%d') || 'T09:30:00+00:00' as moment
             from orders, (values (null, 'applied', 0, 'FOP'), ('applied', 'recruiter_screen', 3, 'FP'),
                                  ('recruiter_screen', 'offer', 10, 'F')) s(from_stage, to_stage, add_days, wanted)
             where contains(wanted, o_orderstatus) and o_orderpriority <> '5-LOW')""",
)
def _unfurl(t, spark, sf):
    """Stage events out of nested application documents; documents without a history have none."""
    _, children = unfurl(
        application_documents(spark, sf),
        "stage_history",
        ["application_id", "candidate_id", "requisition_id"],
        ("stage_event_id", ["application_id", "transitioned_at", "to_stage"]),
    )
    fields = "stage_event_id application_id candidate_id requisition_id from_stage to_stage transitioned_at source_updated_at"
    return children.select(*fields.split())


def _field(name: str):
    text = field_text(name)
    return (text.cast("long") if name in ("application_id", "candidate_id") else text).alias(name)


@query(
    "unfurl_parents",
    """select o_orderkey as application_id, o_custkey as candidate_id, o_orderpriority as requisition_id, o_orderstatus,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' as source_updated_at from orders""",
)
def _unfurl_parents(t, spark, sf):
    """The documents without their nested array."""
    docs = as_documents(application_documents(spark, sf))
    parents = unfurl(docs, "stage_history", ["application_id"], ("stage_event_id", ["application_id"]))[0]
    return parents.select(
        *[_field(f) for f in "application_id candidate_id requisition_id o_orderstatus source_updated_at".split()]
    )


@query(
    "raw_to_fact",
    f"""select {key("id")} as employment_event_key, {key("'W' || o_custkey")} as employee_key, id as event_id,
               lower(o_orderstatus) as event_type, cast(o_orderdate as date) as effective_date,
               o_orderkey::varchar as job_title, o_orderdate as recorded_at_utc
        from {_EVENT_RAW}
        qualify row_number() over (partition by _source_record_id
            order by _source_updated_at desc nulls last, _payload_hash desc) = 1""",
)
def _raw_to_fact(t, spark, sf):
    """Documents landed to a raw table on disk, then base, staging and fact."""
    path = scratch_path(spark, "raw")
    landing.land(event_raw(spark, sf), path, truncate_first=True)
    raw = spark.read.parquet(path)
    fact = core.fact_employment_event(base_model(raw, "employment_events"))
    return fact.select(
        "employment_event_key",
        "employee_key",
        "event_id",
        "event_type",
        "effective_date",
        "job_title",
        "recorded_at_utc",
    )


# -- extracts written as files and taken in --------------------------------------------------------


def _write_lines(docs, path: str) -> None:
    """One document a line, as an extractor leaves them; nulls are written."""
    docs.select(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})).write.text(path)


def _worker_rows(spark, sf):
    """Customers as workers without their history."""
    number = F.col("c_custkey").cast("string")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("W"), number).alias("worker_id"),
        F.concat(F.lit("P"), number).alias("person_external_id"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("current_department"),
        F.lit("2001-12-29T00:00:00Z").alias("source_updated_at"),
        "c_custkey",
    )


def _worker_documents(spark, sf):
    """Customers as worker documents, their orders as profile history."""
    history = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(_day("o_orderdate").alias("effective_date"), F.col("o_orderkey").cast("string").alias("job_title"))
                )
            ).alias("profile_history")
        )
    )
    return _worker_rows(spark, sf).join(history, F.col("c_custkey") == F.col("o_custkey"), "left").drop("c_custkey", "o_custkey")


def _ingested(spark, sf, system: str):
    """Raw tables of a system whose extract files were written from the driver's tables; also the raw folder."""
    folder = scratch_path(spark, "extract")
    workers = _worker_documents(spark, sf)
    line = F.to_json(F.struct(*workers.columns), {"ignoreNullFields": "false"})
    # Every 50th worker's line was cut off in transfer.
    cut = F.substring("worker_id", 2, 20).cast("long") % 50 == 0
    if system == "hris_workday":
        workers.select(F.when(cut, F.left(line, F.lit(40))).otherwise(line)).write.text(f"{folder}/workday_workers.json")
        _write_lines(_worker_rows(spark, sf).select("person_external_id", "source_updated_at"), f"{folder}/workday_persons.json")
        _write_lines(event_documents(spark, sf), f"{folder}/workday_employment_events.json")
    else:
        _write_lines(job_documents(spark, sf), f"{folder}/ashby_jobs.json")
        _write_lines(_worker_rows(spark, sf).select(F.col("worker_id").alias("candidate_id")), f"{folder}/ashby_candidates.json")
        _write_lines(application_documents(spark, sf), f"{folder}/ashby_applications.json")
        _write_lines(_worker_rows(spark, sf).select(F.col("worker_id").alias("offer_id")), f"{folder}/ashby_offers.json")
    raw = f"{folder}/raw"
    for run in ("run-0", "run-1"):  # the second run replaces what the first landed, but for its rejects
        ingest(spark, system, folder, raw, RUN_1, run_id=run, truncate_first=run == "run-1")
    return raw_tables(spark, raw, (system,)), raw


_METADATA = """timestamp '2001-12-30 06:00:00' as _ingested_at_utc, '{}' as _source_system, '{}' as _source_object,
               'run-1' as _run_id, 'full' as _extract_mode, 64 as hash_length"""


def _landed(raw, *fields: str):
    return raw.select(
        "_ingested_at_utc",
        "_source_system",
        "_source_object",
        "_run_id",
        "_extract_mode",
        F.length("_payload_hash").alias("hash_length"),
        "_source_record_id",
        "_source_updated_at",
        *[F.get_json_object("raw_payload", f"$.{f}").alias(f) for f in fields],
    )


@query(
    "ingest_workers",
    f"""select {_METADATA.format("hris_workday", "workers")}, 'W' || c_custkey as _source_record_id,
               timestamp '2001-12-29' as _source_updated_at, 'P' || c_custkey as person_external_id,
               nullif(c_mktsegment, 'BUILDING') as current_department, null::varchar as profile_history
        from customer where c_custkey % 50 <> 0""",
)
def _ingest_workers(t, spark, sf):
    """Raw workers after an ingest of files, without the history that became an object of its own."""
    raw, _ = _ingested(spark, sf, "hris_workday")
    return _landed(raw["workers"], "person_external_id", "current_department", "profile_history")


@query(
    "ingest_profile_versions",
    f"""select {_METADATA.format("hris_workday", "profile_versions")},
               'W' || o_custkey || '|' || strftime(o_orderdate, '%Y-%m-%d') as _source_record_id,
               timestamp '2001-12-30 06:00:00' as _source_updated_at, 'W' || o_custkey as worker_id,
               'P' || o_custkey as person_external_id, o_orderkey::varchar as job_title
        from orders where o_custkey % 50 <> 0""",
)
def _ingest_versions(t, spark, sf):
    """Raw profile versions, split off the workers' documents."""
    raw, _ = _ingested(spark, sf, "hris_workday")
    return _landed(raw["profile_versions"], "worker_id", "person_external_id", "job_title")


@query(
    "ingest_applications",
    f"""select {_METADATA.format("ats_ashby", "applications")}, o_orderkey::varchar as _source_record_id,
               o_orderdate as _source_updated_at, o_custkey::varchar as candidate_id, o_orderpriority as requisition_id,
               null::varchar as stage_history
        from orders""",
)
def _ingest_applications(t, spark, sf):
    """Raw applications after an ingest of files."""
    raw, _ = _ingested(spark, sf, "ats_ashby")
    return _landed(raw["applications"], "candidate_id", "requisition_id", "stage_history")


@query(
    "ingest_rejects",
    """select run as _run_id, 'workers' as _source_object, '{"worker_id":"W' || c_custkey || '"' as text_start, 40 as text_length
       from customer, (values ('run-0'), ('run-1')) r(run) where c_custkey % 50 = 0""",
)
def _ingest_rejects(t, spark, sf):
    """Lines that are no documents are kept as text, for each run."""
    _, folder = _ingested(spark, sf, "hris_workday")
    return spark.read.parquet(f"{folder}/{REJECTS}").select(
        "_run_id",
        "_source_object",
        F.regexp_extract("raw_text", '^[^,]*', 0).alias("text_start"),
        F.length("raw_text").alias("text_length"),
    )


@query(
    "empty_ids",
    "select o_orderkey::varchar as title from orders where o_orderpriority = '5-LOW' or o_orderstatus = 'P'",
)
def _empty_ids(t, spark, sf):
    """Records without an id, missing or blank, land under the empty text and fail the check for it."""
    docs = event_documents(spark, sf).withColumn(
        "event_id",
        F.when(F.col("event_id").endswith("5-LOW"), F.lit(None))
        .when(F.col("event_type") == "p", F.lit(""))
        .otherwise(F.col("event_id")),
    )
    raw = landing.stamp(docs, "hris_workday", "employment_events", "run-1", "event_id", RUN_1)
    failed = check_not_null(raw, ["_source_record_id"], empty=True)
    return failed.select(F.get_json_object("raw_payload", "$.job_title").alias("title"))


@query(
    "hash_dedupe_landing",
    """select 'C' || c_custkey as _source_record_id, c_mktsegment as segment, case when c_acctbal < 0 then 0.0 else c_acctbal end
              as balance
       from customer where c_acctbal < 0 or c_mktsegment = 'BUILDING'""",
)
def _hash_dedupe(t, spark, sf):
    """Second extract of the customers: only changed and new records are landed again."""
    c = table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    first = landing.stamp(c.where("segment <> 'BUILDING'"), "crm", "customers", "run-1", "id", RUN_1)
    now = c.withColumn("balance", F.greatest("balance", F.lit(0.0)))
    second = landing.stamp(now, "crm", "customers", "run-2", "id", RUN_2)
    return landing.only_changed(second, first).select(
        "_source_record_id",
        F.get_json_object("raw_payload", "$.segment").alias("segment"),
        F.get_json_object("raw_payload", "$.balance").cast("double").alias("balance"),
    )


@query(
    "watermark_read",
    """select o_orderkey, case when o_orderpriority <> '5-LOW' then o_orderdate end as o_orderdate from orders
       where o_orderpriority = '5-LOW' or o_orderdate > timestamp '1999-06-30 00:00:00'""",
)
def _watermark(t, spark, sf):
    """Orders after the stored mark, and those without a time."""
    o = table(spark, sf, "orders").withColumn(
        "o_orderdate", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
    )
    return landing.since_watermark(o, "o_orderdate", dt.datetime(1999, 6, 30)).select("o_orderkey", "o_orderdate")


@query(
    "audit_trace",
    check(
        f"""select w.worker_id as dim_worker_id, 'run-2' as dim_run_id, r.moment as _ingested_at_utc, r.run as raw_run_id,
                   w.source_updated_at as _source_updated_at, w.current_department as department
            from workers w, (values (timestamp '2001-12-30 06:00:00', 'run-1'),
                                    (timestamp '2001-12-31 06:00:00', 'run-2')) r(moment, run)
            where r.run = 'run-2' or w.hire_date <= date '1996-12-31'"""
    ),
)
def _audit(t, spark, sf):
    """Raw versions behind every worker of the dimension."""
    return q11(_with_raw(t), AS_OF).select(
        "dim_worker_id",
        "dim_run_id",
        "_ingested_at_utc",
        "raw_run_id",
        "_source_updated_at",
        F.get_json_object("raw_payload", "$.current_department").alias("department"),
    )


@query(
    "q11",
    check(
        """select w.worker_id as dim_worker_id, 'run-2' as dim_run_id, max(r.moment) as last_load, count(*) as versions
           from workers w, (values (timestamp '2001-12-30 06:00:00', 'run-1'),
                                   (timestamp '2001-12-31 06:00:00', 'run-2')) r(moment, run)
           where r.run = 'run-2' or w.hire_date <= date '1996-12-31' group by 1"""
    ),
)
def _q11(t, spark, sf):
    """Landed versions and last load per worker."""
    return q11(_with_raw(t), AS_OF).groupBy("dim_worker_id", "dim_run_id").agg(
        F.max("_ingested_at_utc").alias("last_load"), F.count(F.lit(1)).alias("versions")
    )


def _with_raw(t):
    """The tables plus a raw table in which early hires were landed twice."""
    docs = t["stg_workers"].select(
        "worker_id",
        "person_external_id",
        F.col("hire_date").cast("string").alias("hire_date"),
        "current_department",
        _moment("source_updated_at").alias("source_updated_at"),
    )
    first = docs.where("hire_date <= '1996-12-31'")
    raw = landing.stamp(first, "hris_workday", "workers", "run-1", "worker_id", RUN_1).unionByName(
        landing.stamp(docs, "hris_workday", "workers", "run-2", "worker_id", RUN_2)
    )
    dims = t["dim_employee"].withColumn("ingested_run_id", F.lit("run-2"))
    return {"dim_employee": dims, "raw_workers": raw}


def _delivered(spark, sf) -> str:
    """The events as files of a stream folder: newest first, every event twice, so most are late."""
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = scratch_path(spark, "stream")
    for late in (False, True):
        e.where(F.dayofmonth("ts") <= 15 if late else F.dayofmonth("ts") > 15).write.mode("append").parquet(path)
    e.write.mode("append").parquet(path)
    return path


def _landed_stream(spark, sf):
    """All deliveries, landed one file a batch."""
    path = _delivered(spark, sf)
    schema = spark.read.parquet(path).schema
    target = f"{path}-landed"
    land_events(read_events(spark, path, schema, max_files=1), target, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(target)


@query("stream_event_dedupe", "select distinct event_id, ts, user_id, event_type, value, props from events")
def _stream(t, spark, sf):
    """Events delivered out of order and twice, landed in full, then one row per event."""
    return first_deliveries(_landed_stream(spark, sf), "event_id", "ts")


@query(
    "stream_delivery_check",
    """select 2 * count(*) as row_count, count(distinct event_id) as distinct_ids from events
       where ts > timestamp '2024-01-15 00:00:00' - interval 24 hour and ts <= timestamp '2024-01-15 00:00:00'
       having count(*) > 0""",
)
def _delivery_check(t, spark, sf):
    """The landed stream before its repeats are removed fails the check of the last 24 hours."""
    return check_deliveries(_landed_stream(spark, sf), "event_id", "ts", dt.datetime(2024, 1, 15))


@query("stream_reconcile", "select event_id, 'missing' as status from events where event_type = 'error'")
def _stream_reconcile(t, spark, sf):
    """Full extract against a landed stream that lost one kind of event."""
    landed = first_deliveries(_landed_stream(spark, sf), "event_id", "ts").where("event_type <> 'error'")
    return reconcile_events(table(spark, sf, "events"), landed, ["event_id"])


@query(
    "materialized_table",
    """select o_orderpriority, o_orderstatus, 2 * count(*) as n from orders group by 1, 2""",
)
def _materialized(t, spark, sf):
    """A partitioned table at a path of the shared folder, and rows appended to a catalog table."""
    counts = table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    name, path = f"counts_{uuid.uuid4().hex}", scratch_path(spark, "counts")
    stored = materialize(counts, name, "table", path, partition_by=("o_orderpriority",))
    landing.land_table(stored, f"{name}_twice")
    landing.land_table(stored, f"{name}_twice")
    return spark.table(f"{name}_twice").groupBy("o_orderpriority", "o_orderstatus").agg(F.sum("n").alias("n"))


def _extract(spark, sf, run, at, broken=False, keep="true"):
    """Customers and orders of one run; a broken run dies after the first object has been staged."""

    def make():
        c = table(spark, sf, "customer").where(keep).select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"))
        o = table(spark, sf, "orders").select(F.concat(F.lit("O"), "o_orderkey").alias("id"), F.col("o_orderstatus").alias("kind"))
        stamped = {n: landing.stamp(df, "crm", n, run, "id", at) for n, df in (("customers", c), ("orders", o))}
        if broken:
            fail = F.raise_error(F.lit("broken run")).cast("string")
            stamped["orders"] = stamped["orders"].withColumn("raw_payload", fail)
        return stamped

    return make


@query(
    "ingest_rerun",
    """with r(run, later) as (values ('run-2', false), ('run-3', true))
       select 'customers' as _source_object, run as _run_id, 'C' || c_custkey as _source_record_id, c_mktsegment as kind
       from customer, r where not later or c_acctbal > 0
       union all
       select 'orders', run, 'O' || o_orderkey, o_orderstatus from orders, r""",
)
def _rerun(t, spark, sf):
    """Runs that break between objects, that break while they replace, and that are repeated: each lands once or not at all."""
    log = CommitLog(spark, scratch_path(spark, "runs"))
    later = "c_acctbal > 0"

    def attempt(run, at, truncate_first=False, **how):
        try:
            log.run(run, _extract(spark, sf, run, at, **how), truncate_first)
        except Exception as error:
            if "broken run" not in str(error):
                raise

    attempt("run-1", RUN_1, broken=True)
    attempt("run-1", RUN_1)
    attempt("run-1", RUN_1)  # committed already
    attempt("run-2", RUN_2, truncate_first=True, broken=True)
    attempt("run-2", RUN_2, truncate_first=True)
    attempt("run-2", RUN_2, truncate_first=True)
    attempt("run-3", RUN_2, keep=later, broken=True)
    attempt("run-3", RUN_2, keep=later)
    rows = log.read("customers").unionByName(log.read("orders"))
    return rows.select("_source_object", "_run_id", "_source_record_id", F.get_json_object("raw_payload", "$.kind").alias("kind"))


@query("stream_committed", "select event_id, ts, user_id, event_type, value, props, 2 as deliveries from events")
def _stream_committed(t, spark, sf):
    """Batches of the stream as runs of the log; a second stream with the same name replays them all and adds nothing."""
    path = _delivered(spark, sf)
    schema = spark.read.parquet(path).schema
    log = CommitLog(spark, f"{path}-log")
    for attempt in (1, 2):
        events = read_events(spark, path, schema, max_files=1)
        land_committed(events, log, "events", f"{path}-checkpoint-{attempt}", "events").awaitTermination()
    return log.read("events").groupBy(*schema.names).agg(F.count(F.lit(1)).cast("int").alias("deliveries"))
