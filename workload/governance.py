"""Data-quality checks on inputs with violations, privacy, identity and reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hrflow.functions import surrogate_key
from hrflow.operators import identity, privacy, quality, reconcile
from hrflow.operators.snapshot import daily_totals
from hrflow.plans.core import LINEAGE
from hrflow.sources import landing
from workload.checks import check, key
from workload.landing import RUN_1, RUN_2, event_raw
from workload.registry import query
from workload.views import AS_OF, table

NOW = dt.datetime(2001, 12, 31, 12)


# -- quality ---------------------------------------------------------------------------------------


@query("dq_not_null", check("select * from jobs where department is null"))
def _not_null(t, spark, sf):
    return quality.check_not_null(t["stg_jobs"], ["requisition_id", "department"])


@query(
    "dq_unique",
    """select o_custkey, o_orderdate, count(*) as row_count from orders group by all having count(*) > 1""",
)
def _unique(t, spark, sf):
    return quality.check_unique(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query(
    "dq_unique_expression",
    """select l_orderkey || '|' || l_linenumber as key_0, count(*) as row_count from lineitem
       group by all having count(*) > 1""",
)
def _unique_expression(t, spark, sf):
    composite = F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return quality.check_unique(table(spark, sf, "lineitem"), [composite])


@query(
    "dq_accepted_values",
    check(
        """select event_type, count(*) as row_count from employment_events
           where event_type not in ('hire', 'rehire', 'promotion', 'termination') group by 1"""
    ),
)
def _accepted(t, spark, sf):
    return quality.check_accepted_values(
        t["stg_employment_events"], "event_type", ["hire", "rehire", "promotion", "termination"]
    )


@query(
    "dq_relationships",
    """select o_custkey, count(*) as row_count from orders
       where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'FURNITURE') group by 1""",
)
def _relationships(t, spark, sf):
    parents = table(spark, sf, "customer").where("c_mktsegment <> 'FURNITURE'")
    return quality.check_relationships(table(spark, sf, "orders"), "o_custkey", parents, "c_custkey")


@query(
    "dq_freshness",
    """select max(ts) as max_loaded_at, epoch_us(timestamp '2024-02-01 12:00:00' - max(ts)) / 3600000000.0 as age_hours,
              case when age_hours > 72 then 'error' when age_hours > 36 then 'warn' else 'pass' end as status
       from events""",
)
def _freshness(t, spark, sf):
    events = table(spark, sf, "events")
    return quality.check_freshness(events, dt.datetime(2024, 2, 1, 12), 36, 72, "ts")


_BROKEN_SCD = """(select employee_profile_key, employee_key, valid_from_date,
        case when job_level = 'P' then valid_to_date + 45 else valid_to_date end as valid_to_date from scd)"""


@query(
    "dq_scd2_overlap",
    check(
        f"""with b as {_BROKEN_SCD}
            select x.employee_key, x.employee_profile_key as profile_a, y.employee_profile_key as profile_b,
                   x.valid_from_date as a_from, x.valid_to_date as a_to, y.valid_from_date as b_from,
                   y.valid_to_date as b_to
            from b x join b y on y.employee_key = x.employee_key and x.employee_profile_key < y.employee_profile_key
            where x.valid_from_date < coalesce(y.valid_to_date, date '9999-12-31')
              and y.valid_from_date < coalesce(x.valid_to_date, date '9999-12-31')"""
    ),
)
def _scd_overlap(t, spark, sf):
    """History in which one kind of version ends 45 days late."""
    late = F.when(F.col("job_level") == "P", F.date_add("valid_to_date", 45)).otherwise(F.col("valid_to_date"))
    return quality.check_scd2_overlap(t["dim_employee_profile_scd"].withColumn("valid_to_date", late), pairs=True)


@query(
    "dq_scd2_overlap_rows",
    check(
        f"""with b as (select employee_key, employee_profile_key as id, valid_from_date as a,
                          coalesce(valid_to_date, date '9999-12-31') as z from {_BROKEN_SCD} broken)
            select distinct x.employee_key, x.id, x.a as start
            from b x join b y on y.employee_key = x.employee_key and y.id <> x.id
            where x.a < y.z and y.a < x.z and x.a < x.z and y.a < y.z and (y.a < x.a or (y.a = x.a and y.id < x.id))"""
    ),
)
def _scd_overlap_rows(t, spark, sf):
    """The same history, one row per version that meets an earlier one."""
    late = F.when(F.col("job_level") == "P", F.date_add("valid_to_date", 45)).otherwise(F.col("valid_to_date"))
    found = quality.check_scd2_overlap(t["dim_employee_profile_scd"].withColumn("valid_to_date", late))
    return found.select("employee_key", "id", "start").distinct()


@query(
    "dq_episode_overlap",
    check(
        """with e as (select person_key, employment_episode_key as id, hire_date as a, termination_date as b,
                          coalesce(termination_date, date '9999-12-31') as z from episodes)
           select x.person_key, x.id, x.a as start, x.b as "end", y.id as other_id, y.a as other_start, y.b as other_end
           from e x join e y on y.person_key = x.person_key and y.id <> x.id
                and ((y.a < x.a and y.z > x.a)
                     or (y.a = x.a and x.z > x.a and (y.z > x.z or (y.z = x.z and y.id < x.id))))
           qualify row_number() over (partition by x.id order by y.a = x.a desc, y.z desc, y.id) = 1"""
    ),
)
def _episode_overlap(t, spark, sf):
    return quality.check_episode_overlap(t["dim_employment_episode"])


@query(
    "dq_scd2_grain",
    check(
        """select worker_id, effective_date as valid_from_date, count(*) as row_count from all_profile_versions
           group by all having count(*) > 1"""
    ),
)
def _scd_grain(t, spark, sf):
    """Versions before the second dedupe."""
    return quality.check_scd2_grain(
        t["stg_all_profile_versions"].withColumnRenamed("effective_date", "valid_from_date")
    )


@query(
    "dq_snapshot_unique",
    check(
        """select snapshot_date, employee_key, cast(2 as bigint) as n from snapshot
           where worker_type = 'part_time' and job_level = 'P'"""
    ),
)
def _snapshot_unique(t, spark, sf):
    """Snapshot in which one slice was loaded twice."""
    held = t["active_intervals"].select("employee_key", "worker_type", "job_level", "from_date", "to_date")
    return quality.check_snapshot_unique(held.unionByName(held.where("worker_type = 'part_time' and job_level = 'P'")))


@query(
    "dq_snapshot_active",
    check(
        """select snapshot_date, employee_key from snapshot
           where termination_date is not null and snapshot_date >= termination_date - 30"""
    ),
)
def _snapshot_active(t, spark, sf):
    """Snapshot against episodes that end 30 days earlier."""
    episodes = t["dim_employment_episode"].withColumn("termination_date", F.date_sub("termination_date", 30))
    return quality.check_intervals_active(t["active_intervals"], episodes)


@query(
    "dq_non_negative",
    check("select date_day, net_headcount_change from mart_workforce where net_headcount_change < 0"),
)
def _non_negative(t, spark, sf):
    mart = t["mart_workforce_metrics_daily"].select("date_day", "net_headcount_change")
    return quality.check_non_negative(mart, ["net_headcount_change"])


@query(
    "dq_delta_band",
    check(
        """select * from (select snapshot_date, n, n - lag(n) over (order by snapshot_date) as delta
                          from (select snapshot_date, count(*) as n from snapshot group by 1))
           where not delta between 0 and 1"""
    ),
)
def _delta_band(t, spark, sf):
    """Days on which head count falls, or grows by more than one."""
    return quality.check_delta_band(daily_totals(t["active_intervals"], {}), "snapshot_date", "n", 0, 1)


@query(
    "dq_run_counts",
    """select * exclude (moment) from (select 'web' as _source_system, event_type as _source_object, d as _run_id, n as row_count, d as moment,
                lag(n) over (partition by event_type order by d) as previous_count,
                n / lag(n) over (partition by event_type order by d) - 1 as change
         from (select event_type, strftime(ts, '%Y-%m-%d') as d, count(*) as n from events group by all))
       where change < -0.1 or change > 0.1""",
)
def _run_counts(t, spark, sf):
    """Daily loads per event type that moved by more than a tenth."""
    raw = table(spark, sf, "events").select(
        F.lit("web").alias("_source_system"),
        F.col("event_type").alias("_source_object"),
        F.date_format("ts", "yyyy-MM-dd").alias("_run_id"),
        F.col("ts").alias("_ingested_at_utc"),
    )
    return quality.check_run_counts(raw, 0.1, 0.1)


@query(
    "dq_payload_keys",
    """select * from (select 'job_title' as key, 'new' as change, count(*) as row_count from orders
                      union all select 'manager', 'missing', 0)""",
)
def _payload_keys(t, spark, sf):
    """Payload keys against a tracked set that lacks one and expects another."""
    tracked = ["event_id", "worker_id", "event_type", "effective_date", "source_updated_at", "manager"]
    return quality.check_payload_keys(event_raw(spark, sf), tracked)


@query(
    "dq_report",
    check(
        """select 'department_present' as check_name, 'jobs' as model, 'warn' as severity, 'recruiting' as owner,
                  count(*) as failures, case when count(*) = 0 then 'pass' else 'warn' end as status
           from jobs where department is null
           union all
           select 'requisition_id_unique', 'jobs', 'error', null, count(*), case when count(*) = 0 then 'pass' else 'error' end
           from (select requisition_id from jobs group by 1 having count(*) > 1)"""
    ),
)
def _report(t, spark, sf):
    jobs = t["stg_jobs"]
    return quality.check_report(
        [
            quality.Check(
                "department_present", "jobs", quality.check_not_null(jobs, ["department"]), "warn", "recruiting"
            ),
            quality.Check("requisition_id_unique", "jobs", quality.check_unique(jobs, ["requisition_id"])),
        ]
    )


# -- privacy ---------------------------------------------------------------------------------------


@query(
    "mask_email_name",
    """select c_custkey, case when c_name = '' then '' else substr(lower(c_name), 1, 1) || '***@example.com' end as email,
              substr(c_name, 1, 1) || '***' as name, lower(c_name) || '@example.com' as clear_email, lower(c_name) as no_domain
       from customer""",
)
def _mask(t, spark, sf):
    """Masks for an analyst, clear text for a privileged role, text without a domain unchanged."""
    email = F.concat(F.lower("c_name"), F.lit("@example.com"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        privacy.mask_email(email, "PA_ANALYST").alias("email"),
        privacy.mask_name(F.col("c_name"), "PA_ANALYST").alias("name"),
        privacy.mask_email(email, "PA_AUDITOR").alias("clear_email"),
        privacy.mask_email(F.lower("c_name"), "PA_ANALYST").alias("no_domain"),
    )


@query(
    "apply_masks",
    check(
        """select employee_key, substr(first_name, 1, 1) || '***' as first_name,
                  substr(last_name, 1, 1) || '***' as last_name,
                  substr(work_email, 1, 1) || '***@example.com' as work_email from employees"""
    ),
)
def _apply_masks(t, spark, sf):
    masked = privacy.apply_masks(t["dim_employee"], privacy.PII_TAGS["dim_employee"], "PA_ANALYST")
    return masked.select("employee_key", "first_name", "last_name", "work_email")


def _requests(t):
    """Persons with a negative balance ask to be erased; so does one who is not an employee."""
    asked = t["stg_workers"].where("current_worker_type = 'part_time'").select("person_external_id").distinct()
    unknown = asked.select(F.lit("nobody").alias("person_external_id")).distinct()
    return asked.unionByName(unknown).select(
        "person_external_id", F.concat(F.lit("T-"), "person_external_id").alias("ticket_id")
    )


def _raw(t, name, id_col, run=RUN_1):
    docs = t[f"stg_{name}"].select(
        *[F.col(c).cast("string").alias(c) for c in t[f"stg_{name}"].columns if c not in LINEAGE]
    )
    return landing.stamp(docs, "hris_workday", name, "run-1", id_col, run)


def _erased(t, scope="default"):
    tables = {
        "dim_person": t["dim_person"],
        "dim_employee": t["dim_employee"],
        "raw_workers": _raw(t, "workers", "worker_id"),
        "raw_persons": _raw(t, "persons", "person_external_id"),
        "raw_employment_events": _raw(t, "employment_events", "event_id"),
    }
    return privacy.erase_person(tables, _requests(t), NOW, "engineer", scope)


_GONE = "(select person_external_id from workers where current_worker_type = 'part_time')"


@query(
    "erase_person",
    check(
        f"""select 'dim_employee' as relation, worker_id as id, case when g then 'ERASED' else first_name end as first_name,
                   case when g then 'erased+' || employee_key || '@example.invalid' else work_email end as email
            from (select *, person_external_id in {_GONE} as g from employees)
            union all
            select 'dim_person', person_external_id, case when g then 'ERASED' else first_name end,
                   case when g then 'erased+' || {key("person_external_id")} || '@example.invalid' else personal_email end
            from (select *, person_external_id in {_GONE} as g from persons)
            union all
            select 'raw_workers', worker_id, null, null from workers where person_external_id not in {_GONE}
            union all
            select 'raw_persons', person_external_id, null, null from persons where person_external_id not in {_GONE}
            union all
            select distinct 'erasure_log', 'T-' || person_external_id, null, null from workers
            where person_external_id in {_GONE}"""
    ),
)
def _erase(t, spark, sf):
    """All tables after an erasure, as (relation, id, name, e-mail)."""
    new = _erased(t)
    none = F.lit(None).cast("string")

    def part(relation, id_col, first=none, email=none):
        df = new[relation]
        return df.select(
            F.lit(relation).alias("relation"), F.col(id_col).alias("id"), first.alias("first_name"), email.alias("email")
        )

    return (
        part("dim_employee", "worker_id", F.col("first_name"), F.col("work_email"))
        .unionByName(part("dim_person", "person_external_id", F.col("first_name"), F.col("personal_email")))
        .unionByName(part("raw_workers", "_source_record_id"))
        .unionByName(part("raw_persons", "_source_record_id"))
        .unionByName(part("erasure_log", "ticket_id"))
    )


@query(
    "erasure_stability",
    check(
        f"""select * from (
                select current_department, first_name, cast(sum(b) as bigint) as count_before,
                       cast(sum(a) as bigint) as count_after
                from (select current_department, first_name, 1 as b, 0 as a from workers union all
                      select current_department, case when person_external_id in {_GONE} then 'ERASED'
                             else first_name end, 0, 1 from workers) group by 1, 2)
            where count_before <> count_after"""
    ),
)
def _stability(t, spark, sf):
    """Groups whose employee count moved through the erasure; grouping by a name must show the move."""
    return privacy.stability_check(t["dim_employee"], _erased(t)["dim_employee"], ["current_department", "first_name"])


@query(
    "payload_tombstone",
    check(
        """select worker_id, '__ERASED__' as first_name, '__ERASED__' as work_email, current_department,
                  current_fte, '[]' as worker_ids from workers"""
    ),
)
def _tombstone(t, spark, sf):
    """Payloads with personal values replaced; other fields keep value and type."""
    docs = t["stg_workers"].select(
        "worker_id", "first_name", "work_email", "current_department", "current_fte", F.array("worker_id").alias("worker_ids")
    )
    text = privacy.tombstone(landing.payload_json(docs))
    cols = ["worker_id", "first_name", "work_email", "current_department"]
    return docs.select(text.alias("p")).select(
        *[F.get_json_object("p", f"$.{c}").alias(c) for c in cols],
        F.get_json_object("p", "$.current_fte").cast("double").alias("current_fte"),
        F.get_json_object("p", "$.worker_ids").alias("worker_ids"),
    )


@query(
    "erasure_guard",
    check(
        f"""select person_external_id as _source_record_id, person_external_id in {_GONE} as blocked from persons"""
    ),
)
def _guard(t, spark, sf):
    """Person records that arrive again after an erasure."""
    log = _erased(t)["erasure_log"]
    clean, blocked = privacy.guard_erased(_raw(t, "persons", "person_external_id", RUN_2), log)
    return clean.select("_source_record_id", F.lit(False).alias("blocked")).unionByName(
        blocked.select("_source_record_id", F.lit(True).alias("blocked"))
    )


@query(
    "erasure_guard_workers",
    check(
        f"""select worker_id as _source_record_id, 'workers' as object, person_external_id in {_GONE} as blocked from workers
            union all
            select id, 'employment_events', w.person_external_id in {_GONE}
            from (select distinct event_id as id, worker_id from events_fact) e join workers w using (worker_id)"""
    ),
)
def _guard_workers(t, spark, sf):
    """Worker rows and their events that arrive again after an erasure; events name the worker only."""
    log = _erased(t)["erasure_log"]
    aliases = t["dim_employee"].select("person_external_id", "worker_id")
    documents = t["fact_employment_event"].select("event_id", "worker_id").distinct()
    landed = _raw(t, "workers", "worker_id", RUN_2).unionByName(
        landing.stamp(documents, "hris_workday", "employment_events", "run-2", "event_id", RUN_2)
    )
    clean, blocked = privacy.guard_erased(landed, log, aliases)
    part = lambda df, hit: df.select("_source_record_id", F.col("_source_object").alias("object"), F.lit(hit).alias("blocked"))
    return part(clean, False).unionByName(part(blocked, True))


@query(
    "erase_person_all",
    check(
        f"""select worker_id as _source_record_id, person_external_id in {_GONE} as erased,
                   case when person_external_id in {_GONE} and first_name is not null then '__ERASED__' else first_name end as first_name
            from workers"""
    ),
)
def _erase_all(t, spark, sf):
    """Scope "all": payloads of other raw tables that name the person become tombstones."""
    tables = {
        "dim_person": t["dim_person"],
        "dim_employee": t["dim_employee"],
        "raw_profiles": _raw(t, "workers", "worker_id"),
    }
    new = privacy.erase_person(tables, _requests(t), NOW, "engineer", "all")
    return new["raw_profiles"].select(
        "_source_record_id",
        F.col("_is_erased").alias("erased"),
        F.get_json_object("raw_payload", "$.first_name").alias("first_name"),
    )


@query(
    "k_anonymity",
    """select *  exclude (x), case when n >= 5 then x end as avg_balance,
              case when n < 5 then 'below_threshold' end as suppressed_reason
       from (select c_nationkey, c_mktsegment, c_acctbal < 0 as negative, count(*) as n, floor(avg(c_acctbal)) as x
             from customer group by all)""",
)
def _k_anonymity(t, spark, sf):
    groups = (
        table(spark, sf, "customer")
        .groupBy("c_nationkey", "c_mktsegment", (F.col("c_acctbal") < 0).alias("negative"))
        .agg(F.count(F.lit(1)).alias("n"), F.floor(F.avg("c_acctbal")).cast("double").alias("avg_balance"))
    )
    return privacy.suppress_small(groups, "n", ["avg_balance"], 5)


@query(
    "retention",
    "select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '2001-12-31' - interval 25 month",
)
def _retention(t, spark, sf):
    return privacy.retain(table(spark, sf, "orders"), 25, AS_OF, "o_orderdate").select("o_orderkey", "o_orderdate")


# -- identity and reconciliation -------------------------------------------------------------------

_REG = "'crm' as source_system, 'customers' as source_object, 'C' || c_custkey as source_record_id"


def _records(df):
    return df.select(
        F.lit("crm").alias("source_system"),
        F.lit("customers").alias("source_object"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("source_record_id"),
        "*",
    )


def _registry(customers):
    """Registry of the customers that are not in BUILDING, mapped to a person each."""
    known = _records(customers.where("c_mktsegment <> 'BUILDING'"))
    return known.select(
        surrogate_key(*identity.REGISTRY_KEYS).alias("bridge_person_source_key"),
        *identity.REGISTRY_KEYS,
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("person_key"),
        F.lit("seed").alias("match_method"),
        F.lit(1.0).alias("match_confidence"),
        F.lit(RUN_1).cast("timestamp").alias("created_at_utc"),
        F.lit(None).cast("timestamp").alias("updated_at_utc"),
    )


@query(
    "identity_merge",
    f"""select {key("source_system", "source_object", "source_record_id")} as bridge_person_source_key,
               source_system, source_object, source_record_id,
               case when matched then 'Q' else 'P' end || c_custkey as person_key,
               case when matched then 'email' else 'seed' end as match_method,
               cast(case when matched then 0.5 else 1.0 end as double) as match_confidence,
               case when known then timestamp '2001-12-30 06:00:00' else timestamp '2001-12-31 12:00:00' end as created_at_utc,
               case when known and matched then timestamp '2001-12-31 12:00:00' end as updated_at_utc
        from (select {_REG}, c_custkey, c_mktsegment <> 'BUILDING' as known, c_acctbal > 1000 as matched from customer)
        where known or matched""",
)
def _merge(t, spark, sf):
    """Registry after matches for the customers with a good balance."""
    c = table(spark, sf, "customer")
    matches = _records(c.where("c_acctbal > 1000")).select(
        *identity.REGISTRY_KEYS,
        F.concat(F.lit("Q"), F.col("c_custkey").cast("string")).alias("resolved_person_key"),
        F.lit("email").alias("match_method"),
        F.lit(0.5).alias("match_confidence"),
    )
    return identity.upsert_registry(_registry(c), matches, NOW)


@query(
    "identity_match",
    f"""with c as (select *, {_REG}, case when c_acctbal < 3000 then lower(c_name) else c_mktsegment || c_nationkey end as mail
                   from customer),
             mails as (select mail, min('P' || c_custkey) as lo, max('P' || c_custkey) as hi from c
                       where c_acctbal < 6000 group by 1)
        select source_record_id,
               case when c_mktsegment <> 'BUILDING' then 'existing_mapping' when m.lo is not null then 'email'
                    when c_acctbal > 9000 then 'hire_link' else 'new_person' end as match_method,
               case when c_mktsegment <> 'BUILDING' then 'P' || c_custkey when m.lo is not null then m.lo
                    when c_acctbal > 9000 then 'H' || c_custkey
                    else {key("source_system", "source_object", "source_record_id")} end as resolved_person_key
        from c left join mails m on m.mail = c.mail
        where not (c_mktsegment = 'BUILDING' and m.lo is not null and m.lo <> m.hi)""",
)
def _match(t, spark, sf):
    """Cascade over mapping, e-mail and hire link; ambiguous e-mails go to review."""
    resolved, _ = _cascade(spark, sf)
    return resolved.select("source_record_id", "match_method", "resolved_person_key")


@query(
    "identity_review",
    f"""with c as (select *, {_REG}, case when c_acctbal < 3000 then lower(c_name) else c_mktsegment || c_nationkey end as mail
                   from customer)
        select source_record_id, 'email' as match_method from c
        where c_mktsegment = 'BUILDING' and mail in
              (select mail from c where c_acctbal < 6000 group by 1 having count(distinct c_custkey) > 1)""",
)
def _review(t, spark, sf):
    """Records that more than one person matches."""
    _, review = _cascade(spark, sf)
    return review.select("source_record_id", "match_method")


def _cascade(spark, sf):
    c = table(spark, sf, "customer")
    shared = F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))
    mail = F.when(F.col("c_acctbal") < 3000, F.lower("c_name")).otherwise(shared)
    incoming = _records(c).select(*identity.REGISTRY_KEYS, F.concat(F.lit(" "), F.upper(mail)).alias("email"))
    emails = c.where("c_acctbal < 6000").select(
        mail.alias("email"), F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("person_key")
    )
    links = _records(c.where("c_acctbal > 9000")).select(
        "source_record_id", F.concat(F.lit("H"), F.col("c_custkey").cast("string")).alias("person_key")
    )
    return identity.match_identities(incoming, _registry(c), emails, links)


@query(
    "identity_number",
    f"""with c as (select *, {_REG}, case when c_acctbal < 3000 then 'E' || (c_custkey // 2) end as number from customer),
             numbers as (select 'E' || (c_custkey // 2) as number, min('P' || c_custkey) as lo, max('P' || c_custkey) as hi
                         from c where c_acctbal < 5000 group by 1)
        select source_record_id,
               case when n.lo is null then 'new_person' when n.lo = n.hi then 'employee_number' else 'review' end as outcome,
               case when n.lo is null then {key("source_system", "source_object", "source_record_id")}
                    when n.lo = n.hi then n.lo end as person_key
        from c left join numbers n using (number)""",
)
def _number(t, spark, sf):
    """Cascade by employee number alone; numbers that lead to two persons go to review."""
    c = table(spark, sf, "customer")
    number = F.concat(F.lit("E"), F.floor(F.col("c_custkey") / 2).cast("string"))
    incoming = _records(c).select(
        *identity.REGISTRY_KEYS,
        F.lit(None).cast("string").alias("email"),
        F.when(F.col("c_acctbal") < 3000, F.concat(F.lit(" "), F.lower(number))).alias("employee_number"),
    )
    person = F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("person_key")
    numbers = c.where("c_acctbal < 5000").select(number.alias("employee_number"), person)
    nobody = c.limit(0)
    resolved, review = identity.match_identities(
        incoming,
        _registry(nobody),
        nobody.select(F.col("c_name").alias("email"), person),
        nobody.select(F.col("c_name").alias("source_record_id"), person),
        numbers,
    )
    return resolved.select("source_record_id", F.col("match_method").alias("outcome"), F.col("resolved_person_key").alias("person_key")).union(
        review.select("source_record_id", F.lit("review"), F.lit(None).cast("string"))
    )


_GRAPH = f"""with recursive c as (
        select {_REG}, {key("'crm'", "'customers'", "'C' || c_custkey")} as node,
               case when c_acctbal < 6000 then 'm' || (c_custkey // 3) end as mail,
               case when c_acctbal > 2000 then 'p' || ((c_custkey + 1) // 4) end as phone,
               case when c_nationkey % 5 = 0 then 'N' || (c_custkey // 10) end as number
        from customer),
    link as (select a.node as a, b.node as b from c a join c b on a.mail = b.mail or a.phone = b.phone or a.number = b.number),
    reach(root, node) as (select node, node from c union select r.root, l.b from reach r join link l on l.a = r.node),
    named as (select node, min(root) as component from reach group by 1)
    select source_record_id, component as person_key, records, conflict
    from c join named using (node)
         join (select component, count(*) as records, count(distinct number) > 1 as conflict
               from c join named using (node) group by 1) using (component)"""


@query("identity_graph", _GRAPH)
def _graph(t, spark, sf):
    """Customers linked by shared e-mail, phone and employee number, over any number of steps; two numbers are a conflict."""
    c = table(spark, sf, "customer")
    group = lambda prefix, k: F.concat(F.lit(prefix), F.floor(k).cast("string"))
    key_ = F.col("c_custkey")
    records = _records(c).select(
        *identity.REGISTRY_KEYS,
        F.when(F.col("c_acctbal") < 6000, group("m", key_ / 3)).alias("mail"),
        F.when(F.col("c_acctbal") > 2000, group("p", (key_ + 1) / 4)).alias("phone"),
        F.when(F.col("c_nationkey") % 5 == 0, group("N", key_ / 10)).alias("number"),
    )
    graph = identity.identity_graph(records, ["mail", "phone", "number"], single=["number"])
    return graph.select("source_record_id", "person_key", "records", "conflict")


@query(
    "reconcile_diff",
    """select c_custkey, case when c_mktsegment = 'BUILDING' then 'missing' else 'extra' end as status
       from customer where (c_mktsegment = 'BUILDING') = (c_acctbal > 0)""",
)
def _reconcile(t, spark, sf):
    """Extract of the customers with a positive balance against a warehouse without BUILDING."""
    c = table(spark, sf, "customer")
    return reconcile.reconcile(c.where("c_acctbal > 0"), c.where("c_mktsegment <> 'BUILDING'"), ["c_custkey"])


@query(
    "hard_delete_marks",
    "select c_custkey, c_mktsegment, c_acctbal <= 0 as is_deleted from customer",
)
def _deletes(t, spark, sf):
    """Warehouse customers that a full extract no longer has."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return reconcile.mark_deleted(c, c.where("c_acctbal > 0"), ["c_custkey"]).drop("c_acctbal")


@query(
    "restatement_diff",
    """with p as (select cast(date_trunc('month', o_orderdate) as date) as month, o_orderpriority as department,
                         count(*) filter (o_orderstatus <> 'P') as n from orders group by all),
            r as (select cast(date_trunc('month', o_orderdate) as date) as month, o_orderpriority as department,
                         count(*) as n from orders where o_orderpriority <> '5-LOW' group by all)
       select coalesce(r.month, p.month) as month, coalesce(r.department, p.department) as department,
              case when p.month is null then 'added' when r.month is null then 'removed' else 'changed' end as change,
              p.n as old_n, r.n as n, timestamp '2001-12-31 12:00:00' as restated_at_utc,
              'late_data' as restatement_reason
       from p full join r on r.month = p.month and r.department = p.department
       where p.n is distinct from r.n""",
)
def _restate(t, spark, sf):
    """A published monthly mart against its rebuild."""
    o = table(spark, sf, "orders")
    month = F.trunc("o_orderdate", "month").alias("month")
    department = F.col("o_orderpriority").alias("department")
    published = o.groupBy(month, department).agg(F.count_if(F.col("o_orderstatus") != "P").alias("n"))
    rebuilt = o.where("o_orderpriority <> '5-LOW'").groupBy(month, department).agg(F.count(F.lit(1)).alias("n"))
    return reconcile.restate(published, rebuilt, ["month", "department"], ["n"], NOW, "late_data")
