"""Calendar, identity, history, head count and hierarchy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hrflow.operators import history
from hrflow.operators.calendar import dim_date, time_spine
from hrflow.operators.hierarchy import (
    attrition_by_manager,
    manager_chain,
    manager_chain_intervals,
    org_by_period,
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
    last_snapshot,
    last_termination,
)
from hrflow.plans import core
from hrflow.plans.people_metrics import attrition_annualised, mobility_rate, workforce_on
from workload.checks import check, key, key_if
from workload.registry import DAY_PIN, query
from workload.views import AS_OF, START, table


@query(
    "dim_date",
    """select cast(g as date) as date_day, cast(year(g) as integer) as year_number,
              cast(quarter(g) as integer) as quarter_number, cast(month(g) as integer) as month_number,
              monthname(g) as month_name, cast(day(g) as integer) as day_of_month,
              cast(dayofweek(g) as integer) as day_of_week, dayname(g) as day_name,
              cast(week(g) as integer) as iso_week, dayofweek(g) not in (0, 6) as is_weekday,
              cast(date_trunc('month', g) as date) as first_day_of_month,
              cast(date_trunc('quarter', g) as date) as first_day_of_quarter,
              cast(date_trunc('year', g) as date) as first_day_of_year, n.orders
       from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders) b,
            generate_series(b.lo, b.hi, interval 1 day) as s(g)
       left join (select cast(o_orderdate as date) as d, count(*) as orders from orders group by 1) n
            on n.d = cast(g as date)""",
)
def _dim_date(t, spark, sf):
    """Calendar over the range of the order dates, with the orders of each day."""
    orders = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date_day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    lo, hi = orders.agg(F.min("date_day"), F.max("date_day")).first()
    return dim_date(spark, lo, hi).join(orders, "date_day", "left")


@query(
    "time_spine",
    """select cast(g as date) as date_day, count(o_orderkey) as orders
       from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders) b,
            generate_series(b.lo, b.hi, interval 1 day) as s(g)
       left join orders on cast(o_orderdate as date) = cast(g as date) group by 1""",
)
def _time_spine(t, spark, sf):
    """Orders per day, with the days that have none."""
    orders = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    lo, hi = orders.agg(F.min("date_day"), F.max("date_day")).first()
    return time_spine(spark, lo, hi).join(orders, "date_day", "left").select(
        "date_day", F.coalesce("n", F.lit(0)).cast("bigint").alias("orders")
    )


@query(
    "dim_person",
    check(
        f"""select {key("person_external_id")} as person_key, person_external_id, first_name, last_name,
                   personal_email, worker_ids_json, source_updated_at, ingested_at_utc, ingested_run_id
            from persons"""
    ),
)
def _dim_person(t, spark, sf):
    return t["dim_person"]


@query(
    "dim_employee",
    check(
        f"""select employee_key, person_key, worker_id, person_external_id, first_name, last_name, work_email,
                   hire_date, termination_date, termination_reason,
                   termination_date is null as is_currently_employed, current_department, current_function,
                   current_job_title, current_job_level, current_manager_worker_id,
                   {key_if("current_manager_worker_id")} as current_manager_employee_key, current_worker_type,
                   current_fte, current_location_city, current_location_region, current_location_country,
                   source_updated_at, ingested_at_utc, ingested_run_id
            from employees"""
    ),
)
def _dim_employee(t, spark, sf):
    return t["dim_employee"]


@query("employment_episodes", check("select * from episodes"))
def _episodes(t, spark, sf):
    return t["dim_employment_episode"]


@query(
    "employment_events",
    check(
        f"""select {key("event_id")} as employment_event_key, {key("worker_id")} as employee_key,
                   {key("person_external_id")} as person_key, event_id, worker_id, person_external_id, event_type,
                   effective_date, department, function_name, job_title, job_level, manager_worker_id,
                   {key_if("manager_worker_id")} as manager_employee_key, termination_reason,
                   source_updated_at as recorded_at_utc, ingested_run_id
            from employment_events"""
    ),
)
def _events(t, spark, sf):
    return t["fact_employment_event"]


_SCD_COLUMNS = """employee_profile_key, employee_key, worker_id, person_external_id,
    cast(version_number as integer) as version_number, valid_from_date, valid_to_date,
    valid_to_date is null as is_current, department, function_name, job_title, job_level, manager_worker_id,
    manager_employee_key, worker_type, fte, location_city, location_region, location_country,
    event_type as version_event_type, source_updated_at as recorded_at_utc, ingested_run_id"""


@query("latest_by_business_key", check("select * from profile_versions"))
def _latest_version(t, spark, sf):
    """One profile version per worker and effective date."""
    return t["stg_profile_versions"]


@query("scd2_history", check(f"select {_SCD_COLUMNS} from scd"))
def _scd(t, spark, sf):
    return t["dim_employee_profile_scd"]


@query(
    "as_of_filter",
    check(
        f"""select {_SCD_COLUMNS} from scd where valid_from_date <= date '1998-06-30'
            and (valid_to_date is null or valid_to_date > date '1998-06-30')"""
    ),
)
def _as_of(t, spark, sf):
    return history.as_of(t["dim_employee_profile_scd"], "1998-06-30")


@query(
    "department_scd",
    """with d as (
           select o_orderpriority as department_id, cast(date_trunc('month', o_orderdate) as date) as effective_date,
                  count(*) as size, round(sum(o_totalprice)) as budget
           from orders group by 1, 2)
       select md5(department_id || '|' || cast(effective_date as varchar)) as department_version_key,
              md5(department_id) as department_key, department_id,
              cast(row_number() over w as integer) as version_number, effective_date as valid_from_date,
              lead(effective_date) over w as valid_to_date, lead(effective_date) over w is null as is_current,
              size, budget
       from d window w as (partition by department_id order by effective_date)""",
)
def _department_scd(t, spark, sf):
    """Department versions, one per month with its size and budget."""
    versions = (
        table(spark, sf, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("department_id"), F.trunc("o_orderdate", "month").alias("effective_date")
        )
        .agg(F.count(F.lit(1)).alias("size"), F.floor(F.sum("o_totalprice") + 0.5).cast("double").alias("budget"))
    )
    return core.department_scd(versions)


@query(
    "as_of_join",
    check(
        """select e.event_id, e.worker_id, e.event_type, e.effective_date, s.employee_profile_key as then_employee_profile_key,
                  s.department as then_department, s.manager_employee_key as then_manager_employee_key
           from events_fact e join scd s on s.employee_key = e.employee_key and s.valid_from_date <= e.effective_date
                and (s.valid_to_date is null or s.valid_to_date > e.effective_date)"""
    ),
)
def _as_of_join(t, spark, sf):
    """Every HR event with the profile that was valid on its date."""
    events = t["fact_employment_event"].select("event_id", "worker_id", "event_type", "effective_date")
    return history.as_of_join(
        events,
        t["dim_employee_profile_scd"],
        "worker_id",
        "effective_date",
        ["employee_profile_key", "department", "manager_employee_key"],
        prefix="then_",
    )


@query(
    "bitemporal_as_of",
    check(
        """select * exclude (next_date) from (
               select *, lead(effective_date) over (partition by worker_id order by effective_date) as next_date
               from (select worker_id, effective_date, profile_version_id, department, recorded_at
                     from (select *, source_updated_at
                                  + interval 1 day * case when job_level = 'P' then 90 else 10 end as recorded_at
                           from all_profile_versions)
                     where recorded_at <= timestamp '1998-06-30'
                     qualify row_number() over (partition by worker_id, effective_date
                         order by recorded_at desc, profile_version_id desc) = 1))
           where effective_date <= date '1998-05-31' and (next_date is null or next_date > date '1998-05-31')"""
    ),
)
def _bitemporal(t, spark, sf):
    """Profiles at the end of May as known at the end of June; one kind of change is entered 90 days late."""
    lag = F.when(F.col("job_level") == "P", F.expr("interval 90 days")).otherwise(F.expr("interval 10 days"))
    versions = t["stg_all_profile_versions"].select(
        "worker_id",
        "effective_date",
        "profile_version_id",
        "department",
        (F.col("source_updated_at") + lag).alias("recorded_at"),
    )
    found = history.bitemporal_as_of(
        versions,
        ["worker_id"],
        "effective_date",
        "recorded_at",
        "1998-05-31",
        "1998-06-30 00:00:00",
        "profile_version_id",
    )
    return found.select(versions.columns)


@query(
    "active_intervals",
    check(
        f"""select p.employee_profile_key, e.employment_episode_key, p.department, p.manager_employee_key, p.fte,
                   greatest(p.valid_from_date, e.hire_date) as from_date,
                   least(coalesce(p.valid_to_date, date '9999-12-31') - 1,
                         coalesce(e.termination_date, date '9999-12-31') - 1,
                         (select coalesce(max(termination_date), date '{AS_OF}') from workers)) as to_date
            from scd p join episodes e on e.employee_key = p.employee_key where from_date <= to_date"""
    ),
)
def _intervals(t, spark, sf):
    """Day intervals in which profile versions were active."""
    return t["active_intervals"].select(
        "employee_profile_key",
        "employment_episode_key",
        "department",
        "manager_employee_key",
        "fte",
        "from_date",
        "to_date",
    )


@query(
    "headcount_snapshot",
    check(
        """select snapshot_date, department, job_level, worker_type, count(*) as headcount, sum(fte) as fte,
                  cast(sum(episode_number) as bigint) as episode_numbers,
                  cast(sum(cast('0x' || left(employee_profile_key, 8) as bigint)) as bigint) as profile_checksum,
                  cast(sum(cast('0x' || left(employment_episode_key, 8) as bigint)) as bigint) as episode_checksum,
                  cast(sum(cast('0x' || left(manager_employee_key, 8) as bigint)) as bigint) as manager_checksum,
                  max(hire_date) as last_hire
           from snapshot group by 1, 2, 3, 4"""
    ),
)
def _snapshot(t, spark, sf):
    """The whole daily head count fact, per day and profile slice, with sums over its keys."""
    number = lambda c: F.conv(F.left(c, F.lit(8)), 16, 10).cast("bigint")
    keys = {
        "profile_checksum": "employee_profile_key",
        "episode_checksum": "employment_episode_key",
        "manager_checksum": "manager_employee_key",
    }
    intervals = active_intervals(
        t["dim_employee_profile_scd"], t["dim_employment_episode"], START, last_termination(t["stg_workers"], AS_OF)
    )
    daily = explode_days(intervals.withColumns({name: number(F.col(c)) for name, c in keys.items()}))
    return daily.groupBy("snapshot_date", "department", "job_level", "worker_type").agg(
        F.count(F.lit(1)).alias("headcount"),
        F.sum("fte").alias("fte"),
        F.sum("episode_number").alias("episode_numbers"),
        *[F.sum(name).alias(name) for name in keys],
        F.max("hire_date").alias("last_hire"),
    )


@query(
    "headcount_sweep",
    check(
        """select snapshot_date, department, worker_type, count(*) as n, sum(fte) as fte
           from snapshot group by all"""
    ),
)
def _sweep(t, spark, sf):
    """Daily head count and FTE by department and worker type, without expanding intervals."""
    totals = daily_totals(t["active_intervals"], {"fte": exact(F.col("fte"))}, ["department", "worker_type"])
    return totals.withColumn("fte", F.col("fte").cast("double"))


@query(
    "manager_chain",
    check(
        """select snapshot_date, depth, count(*) as n from chain group by all"""
    ),
)
def _chain(t, spark, sf):
    """Daily chain size per depth over the whole history, from chain intervals."""
    chain = manager_chain_intervals(t["active_intervals"], grain=None)
    return daily_totals(chain, {}, ["depth"]).select("snapshot_date", "depth", "n")


@query(
    "manager_chain_ancestors",
    check(
        """select cast(date_trunc('month', snapshot_date) as date) as month, ancestor_employee_key, depth,
                  count(*) as employee_days, count(distinct employee_key) as employees,
                  min(employee_key) as least_employee, max(employee_key) as greatest_employee
           from chain group by all"""
    ),
)
def _chain_ancestors(t, spark, sf):
    """Organisation below every ancestor and depth per month, from chain intervals."""
    return org_by_period(manager_chain_intervals(t["active_intervals"], grain=None), "month")


def _today(t):
    return last_snapshot(t["active_intervals"], last_termination(t["stg_workers"], AS_OF))


@query("manager_chain_day", check("select * from last_chain"))
def _chain_day(t, spark, sf):
    """Chain rows of the last snapshot day."""
    return manager_chain(_today(t))


@query(
    "org_pyramid",
    check(
        "select depth as levels_above, count(distinct employee_key) as employees from last_chain group by depth"
    ),
)
def _pyramid(t, spark, sf):
    return org_pyramid(manager_chain(_today(t)))


@query(
    "span_of_control",
    check(
        """select m.first_name || ' ' || m.last_name as manager, m.current_department as department,
                  count(*) as direct_reports
           from last_snapshot s join employees m on m.employee_key = s.manager_employee_key group by all"""
    ),
)
def _span(t, spark, sf):
    return span_of_control(_today(t), t["dim_employee"])


@query(
    "org_size",
    check(
        """select snapshot_date, ancestor_employee_key as manager_employee_key,
                  count(distinct employee_key) filter (depth = 1) as direct_reports,
                  count(distinct employee_key) as total_org_size
           from last_chain group by all"""
    ),
)
def _org_size(t, spark, sf):
    return org_size(manager_chain(_today(t)))


@query(
    "span_stats",
    check(
        """select m.department, count(*) as managers, avg(span) as avg_span, quantile_cont(span, 0.5) as median_span,
                  quantile_cont(span, 0.9) as p90_span, max(span) as max_span
           from (select manager_employee_key, count(distinct employee_key) as span from last_snapshot
                 where manager_employee_key is not null group by all) x
           join last_snapshot m on m.employee_key = x.manager_employee_key group by m.department"""
    ),
)
def _span_stats(t, spark, sf):
    return span_stats(_today(t))


@query(
    "survivor_resolution",
    """with recursive m as (
           select 'P' || cast(c_custkey as varchar) as merged_key,
                  case when c_acctbal < 5000 and c_custkey > 0
                       then 'P' || cast(cast(floor(c_custkey / 3) as bigint) as varchar) end as survivor_key
           from customer),
       walk as (
           select merged_key, survivor_key, 1 as n from m where survivor_key is not null
           union all
           select w.merged_key, m.survivor_key, w.n + 1 from walk w join m on m.merged_key = w.survivor_key
           where m.survivor_key is not null)
       select m.merged_key, arg_max(w.survivor_key, w.n) as survivor_key from m left join walk w using (merged_key) group by 1""",
)
def _survivors(t, spark, sf):
    """All persons, followed to the survivor; those that were merged into nobody have none and end the chains."""
    person = lambda k: F.concat(F.lit("P"), k.cast("bigint").cast("string"))
    merged = F.when((F.col("c_acctbal") < 5000) & (F.col("c_custkey") > 0), person(F.floor(F.col("c_custkey") / 3)))
    return resolve_survivors(
        table(spark, sf, "customer").select(person(F.col("c_custkey")).alias("merged_key"), merged.alias("survivor_key"))
    )


@query(
    "attrition_by_subtree",
    check(
        f"""select m.manager_employee_key, e.first_name || ' ' || e.last_name as manager_name,
                   h.n as avg_active_headcount, coalesce(l.voluntary, 0) as voluntary_terms,
                   coalesce(l.regrettable, 0) as regrettable_voluntary_terms,
                   coalesce(l.voluntary, 0) / nullif(h.n, 0) as voluntary_attrition_rate_annualised
            from (select distinct c.ancestor_employee_key as manager_employee_key
                  from last_chain c join scd p on p.employee_key = c.ancestor_employee_key
                  where c.depth <= 2 and p.department like '%-M%' and p.valid_from_date <= date '{AS_OF}'
                    and (p.valid_to_date is null or p.valid_to_date > date '{AS_OF}')) m
            left join (select p.manager_employee_key as k,
                              count(*) filter (termination_reason like 'voluntary%') as voluntary,
                              count(*) filter (termination_reason like 'voluntary%' and x.function_name = '5-LOW')
                                  as regrettable
                       from events_fact x join scd p on p.employee_key = x.employee_key
                            and p.valid_from_date <= x.effective_date
                            and (p.valid_to_date is null or p.valid_to_date > x.effective_date)
                       where x.event_type = 'termination'
                         and x.effective_date >= date '{AS_OF}' - interval 12 month
                       group by 1) l on l.k = m.manager_employee_key
            left join (select manager_employee_key as k, cast(count(distinct employee_key) as double) as n from snapshot
                       where snapshot_date >= date '{AS_OF}' - interval 12 month group by 1) h
                 on h.k = m.manager_employee_key
            left join employees e on e.employee_key = m.manager_employee_key"""
    ),
    pin=DAY_PIN,
)
def _attrition_subtree(t, spark, sf):
    return attrition_by_manager(
        manager_chain(_today(t)),
        t["dim_employee_profile_scd"],
        t["fact_employment_event"].where("event_type = 'termination'"),
        t["active_intervals"],
        t["dim_employee"],
        AS_OF,
        "%-M%",
        2,
        voluntary=F.col("termination_reason").startswith("voluntary"),
        regrettable=F.col("function_name") == "5-LOW",
    )


_D1, _D2 = dt.date(1999, 1, 1), dt.date(1999, 12, 31)


def _rate_check(condition: str, count_name: str, rate_name: str) -> str:
    return check(
        f"""select s.department, s.a as start_headcount, s.b as end_headcount, coalesce(e.n, 0) as {count_name},
                   coalesce(e.n, 0) / nullif((s.a + s.b) / 2, 0) as {rate_name}
            from (select function_name as department, count(*) filter (snapshot_date = date '{_D1}') as a,
                         count(*) filter (snapshot_date = date '{_D2}') as b
                  from snapshot where snapshot_date in (date '{_D1}', date '{_D2}') group by 1) s
            left join (select department, count(*) as n from employment_events
                       where effective_date between date '{_D1}' and date '{_D2}' and {condition} group by 1) e
                 on e.department = s.department"""
    )


def _by_segment(t):
    return t["active_intervals"].drop("department").withColumnRenamed("function_name", "department")


@query(
    "attrition_annualised",
    _rate_check("event_type = 'termination'", "terminations", "attrition_rate_annualised"),
)
def _attrition(t, spark, sf):
    return attrition_annualised(_by_segment(t), t["fact_employment_event"], _D1, _D2, 12)


@query(
    "mobility_rate",
    _rate_check("event_type in ('transfer', 'promotion', 'lateral')", "internal_moves", "mobility_rate_annualised"),
)
def _mobility(t, spark, sf):
    return mobility_rate(_by_segment(t), t["fact_employment_event"], _D1, _D2, 12)


@query(
    "workforce_totals",
    check(
        f"""select department, count(distinct employee_key) filter (worker_type in ('full_time', 'part_time', 'intern'))
                       as active_headcount, count(distinct employee_key) as total_workforce_active
            from snapshot where snapshot_date = date '{_D2}' group by 1"""
    ),
)
def _workforce(t, spark, sf):
    """Employees and total workforce by department."""
    return workforce_on(t["active_intervals"], _D2, "department")


@query("mart_workforce", check("select * from mart_workforce"))
def _mart_workforce(t, spark, sf):
    return t["mart_workforce_metrics_daily"]
