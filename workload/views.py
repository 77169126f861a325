"""The driver's star-schema tables seen as HR and recruiting records.

Customers are employment stints (two per person), orders are profile versions and HR events, parts are
requisitions, orders with their line items are applications and offers, and ``events`` are funnel stage
transitions. Every view is one SQL text that Spark and the checking database both run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from hrflow.operators.dedupe import latest_version
from hrflow.plans.warehouse import Tables, warehouse

AS_OF = dt.date(2001, 12, 31)
START = dt.date(1995, 1, 1)
BASE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")

_MANAGER = "'W' || cast(cast(floor(o.o_custkey / case when o.o_orderstatus = 'F' then 5 else 4 end) as bigint) as string)"
_LINEAGE = "{updated} as source_updated_at, {updated} as ingested_at_utc, 'run-1' as ingested_run_id"


def _lineage(updated: str) -> str:
    return _LINEAGE.format(updated=updated)


VIEWS = {
    "workers": f"""
        select 'W' || cast(c.c_custkey as string) as worker_id,
               'P' || cast(cast(floor(c.c_custkey / 2) as bigint) as string) as person_external_id,
               c.c_mktsegment as first_name, n.n_name as last_name,
               lower(c.c_name) || '@example.com' as work_email,
               lower(c.c_name) || '@mail.example' as personal_email,
               s.first_day as hire_date,
               case when c.c_mktsegment in ('BUILDING', 'MACHINERY') then s.last_day end as termination_date,
               case when c.c_mktsegment = 'BUILDING' then 'voluntary_resignation'
                    when c.c_mktsegment = 'MACHINERY' then 'involuntary_layoff' end as termination_reason,
               r.r_name as current_department, c.c_mktsegment as current_function,
               n.n_name as current_job_title, 'IC1' as current_job_level,
               case when c.c_custkey > 4
                    then 'W' || cast(cast(floor(c.c_custkey / 5) as bigint) as string) end as current_manager_worker_id,
               case when c.c_acctbal < 0 then 'part_time' else 'full_time' end as current_worker_type,
               cast(case when c.c_acctbal < 0 then 0.5 else 1.0 end as double) as current_fte,
               n.n_name as current_location_city, cast(null as string) as current_location_region,
               r.r_name as current_location_country,
               {_lineage("s.last_order")}
        from {{customer}} c
        join (select o_custkey, cast(min(o_orderdate) as date) as first_day,
                     cast(max(o_orderdate) as date) as last_day, max(o_orderdate) as last_order
              from {{orders}} group by o_custkey) s on s.o_custkey = c.c_custkey
        join {{nation}} n on n.n_nationkey = c.c_nationkey
        join {{region}} r on r.r_regionkey = n.n_regionkey""",
    "persons": f"""
        select 'P' || cast(cast(floor(c_custkey / 2) as bigint) as string) as person_external_id,
               min(c_mktsegment) as first_name, max(c_mktsegment) as last_name,
               min(lower(c_name)) || '@mail.example' as personal_email,
               '["W' || cast(min(c_custkey) as string) || '","W' || cast(max(c_custkey) as string) || '"]' as worker_ids_json,
               {_lineage("cast('2001-12-31 00:00:00' as timestamp)")}
        from {{customer}} group by cast(floor(c_custkey / 2) as bigint)""",
    "all_profile_versions": f"""
        select cast(o.o_orderkey as string) as profile_version_id,
               'W' || cast(o.o_custkey as string) as worker_id,
               'P' || cast(cast(floor(o.o_custkey / 2) as bigint) as string) as person_external_id,
               cast(o.o_orderdate as date) as effective_date,
               o.o_orderpriority as department, c.c_mktsegment as function_name,
               o.o_orderpriority || ' ' || o.o_orderstatus as job_title, o.o_orderstatus as job_level,
               case when o.o_custkey > 4 then {_MANAGER} end as manager_worker_id,
               case when c.c_acctbal < 0 then 'part_time' when c.c_mktsegment = 'FURNITURE' then 'contractor'
                    else 'full_time' end as worker_type,
               cast(case when c.c_acctbal < 0 then 0.5 else 1.0 end as double) as fte,
               cast(null as string) as location_city, cast(null as string) as location_region,
               n.n_name as location_country,
               case o.o_orderstatus when 'F' then 'promotion' when 'O' then 'transfer' else 'lateral' end as event_type,
               {_lineage("o.o_orderdate")}
        from {{orders}} o join {{customer}} c on c.c_custkey = o.o_custkey
        join {{nation}} n on n.n_nationkey = c.c_nationkey""",
    "employment_events": f"""
        select 'E' || cast(o.o_orderkey as string) as event_id,
               'W' || cast(o.o_custkey as string) as worker_id,
               'P' || cast(cast(floor(o.o_custkey / 2) as bigint) as string) as person_external_id,
               case when o.o_orderpriority = '1-URGENT' then 'hire'
                    when o.o_orderpriority = '2-HIGH' then 'rehire'
                    when o.o_orderpriority = '3-MEDIUM' then 'promotion'
                    when o.o_orderpriority = '5-LOW' then 'termination'
                    when o.o_orderstatus = 'P' then 'lateral' else 'transfer' end as event_type,
               cast(o.o_orderdate as date) as effective_date,
               c.c_mktsegment as department, o.o_orderpriority as function_name,
               o.o_orderpriority || ' ' || o.o_orderstatus as job_title, o.o_orderstatus as job_level,
               case when o.o_custkey > 4 then {_MANAGER} end as manager_worker_id,
               case when o.o_orderpriority = '5-LOW' then
                    case o.o_orderstatus when 'F' then 'voluntary' when 'O' then 'voluntary_resignation'
                         else 'involuntary_layoff' end end as termination_reason,
               {_lineage("o.o_orderdate")}
        from {{orders}} o join {{customer}} c on c.c_custkey = o.o_custkey""",
    "jobs": f"""
        select p_partkey as requisition_id, p_name as job_title, 'IC' || cast(p_size as string) as job_level,
               nullif(p_brand, 'Brand#3') as department, p_type as function_name,
               cast('1995-01-01' as date) + p_size as opened_at,
               case when p_retailprice > 950 then cast('1996-01-01' as date) + p_size end as closed_at,
               case when p_retailprice > 950 then 'filled' else 'open' end as status,
               '[]' as hired_worker_ids_json,
               {_lineage("cast('2001-12-31 00:00:00' as timestamp)")}
        from {{part}}""",
    "candidates": f"""
        select c_custkey as candidate_id, c_mktsegment as first_name, c_name as last_name,
               lower(c_name) || '@mail.example' as email, cast(null as string) as linkedin_url,
               c_mktsegment as candidate_source,
               case when c_acctbal >= 0
                    then 'P' || cast(cast(floor(c_custkey / 2) as bigint) as string) end as person_external_id,
               {_lineage("cast('2001-12-31 00:00:00' as timestamp)")}
        from {{customer}}""",
    "applications": f"""
        select o.o_orderkey as application_id, o.o_custkey as candidate_id, l.part as requisition_id,
               o.o_orderdate as submitted_at,
               case o.o_orderstatus when 'F' then 'hired' when 'P' then 'offer' else 'applied' end as current_stage,
               case o.o_orderstatus when 'F' then 'hired' when 'P' then 'rejected' else 'active' end as status,
               cast(null as string) as final_outcome_reason, o.o_orderpriority as application_source,
               o.o_orderstatus = 'F' as is_winning,
               case when o.o_orderstatus <> 'O' then l.last_ship end as closed_at,
               {_lineage("o.o_orderdate")}
        from {{orders}} o
        left join (select l_orderkey, min(l_partkey) as part, max(l_shipdate) as last_ship
                   from {{lineitem}} group by l_orderkey) l on l.l_orderkey = o.o_orderkey""",
    "offers": f"""
        select l.l_orderkey as offer_id, l.l_orderkey as application_id, o.o_custkey as candidate_id,
               l.part as requisition_id, l.first_ship as extended_at,
               case when l.a > 0 or l.n > 0 then l.last_ship end as responded_at,
               case when l.a > 0 then 'accepted' when l.n = 0 then 'pending'
                    when l.o > 0 then 'declined' else 'expired' end as status,
               l.price as base_salary_amount, 'CAD' as base_salary_currency,
               case when l.a > 0
                    then 'P' || cast(cast(floor(o.o_custkey / 2) as bigint) as string) end as accepted_person_external_id,
               {_lineage("l.last_ship")}
        from (select l_orderkey, min(l_partkey) as part, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship,
                     sum(case when l_returnflag = 'A' then 1 else 0 end) as a,
                     sum(case when l_returnflag = 'N' then 1 else 0 end) as n,
                     sum(case when l_linestatus = 'O' then 1 else 0 end) as o, max(l_extendedprice) as price
              from {{lineitem}} group by l_orderkey) l
        join {{orders}} o on o.o_orderkey = l.l_orderkey""",
    "application_stage_events": f"""
        select event_id as stage_event_id, user_id as application_id, user_id as candidate_id,
               user_id as requisition_id, cast(null as string) as from_stage,
               case event_type when 'signup' then 'applied' when 'view' then 'recruiter_screen'
                    when 'click' then 'technical_interview' when 'error' then 'offer' else 'hired' end as to_stage,
               ts as transitioned_at, {_lineage("ts")}
        from {{events}}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The views as staging relations, defined when asked for."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    base = Tables({b: lambda b=b: table(spark, sf_dir, b) for b in BASE_TABLES})

    def build(sql: str):
        used = [b for b in BASE_TABLES if "{" + b + "}" in sql]
        return lambda: spark.sql(sql, **{b: base[b] for b in used})

    t = Tables({name: build(sql) for name, sql in VIEWS.items()})
    t.builders["profile_versions"] = lambda: latest_version(t["all_profile_versions"])
    return t


def all_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Staging relations (prefix ``stg_``), core tables and marts of the whole data set."""
    stg = staging_tables(spark, sf_dir)
    t = warehouse(stg, AS_OF, START, calendar=(START, AS_OF))
    for name in (*VIEWS, "profile_versions"):
        t.builders[f"stg_{name}"] = lambda name=name: stg[name]
    return t
