"""The analytic query surface. ``t`` maps table names to DataFrames; dates are arguments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.functions import band, rank_in, round_away, safe_ratio, trailing
from hrflow.operators.hierarchy import manager_chain, org_pyramid, span_of_control
from hrflow.operators.history import as_of as valid_on
from hrflow.operators.snapshot import last_day, last_snapshot, last_termination, person_days
from hrflow.sources.landing import audit_trace

Tables = Mapping[str, DataFrame]

# Stage order of the funnel, tenure bands.
STAGES = (
    "applied",
    "recruiter_screen",
    "hiring_manager_screen",
    "technical_interview",
    "final_round",
    "offer",
    "hired",
)
TENURE_EDGES = (365, 730, 1825, 3650)
TENURE_LABELS = ("< 1 year", "1-2 years", "2-5 years", "5-10 years", "10+ years")

# Columns of the reporting extracts (personal e-mail addresses stay out).
EXTRACTS = {
    "dim_employee": """employee_key person_key worker_id first_name last_name hire_date termination_date
        is_currently_employed current_department current_function current_job_title current_job_level
        current_worker_type current_fte""",
    "dim_employment_episode": """employment_episode_key employee_key person_key worker_id episode_number
        hire_date termination_date tenure_days is_active_episode""",
    "dim_job_requisition": """requisition_key requisition_id job_title job_level department function_name
        opened_at closed_at status days_open""",
    "fact_application": """application_key candidate_key requisition_key application_id candidate_id
        requisition_id submitted_at current_stage status application_source is_winning closed_at
        days_in_funnel""",
    "fact_application_stage_history": """stage_event_id application_id candidate_id requisition_id
        from_stage to_stage transitioned_at next_transition_at hours_in_stage""",
    "mart_recruiting_funnel_daily": "*",
    "mart_workforce_metrics_daily": "*",
}


def extract(t: Tables, name: str) -> DataFrame:
    """Columns of a core or mart table that reporting tools may see."""
    return t[name].select(*EXTRACTS[name].split())


def last_loaded(df: DataFrame, col: str, cond: Column | None = None) -> Column:
    """Latest value of ``col`` (under a condition) as a scalar subquery."""
    return (df if cond is None else df.where(cond)).agg(F.max(col)).scalar()


def _mart(t: Tables) -> DataFrame:
    return t["mart_workforce_metrics_daily"]


def _loaded(t: Tables) -> DataFrame:
    return _mart(t).where("active_headcount > 0")


def _last_loaded_day(t: Tables) -> Column:
    return last_loaded(_mart(t), "date_day", F.col("active_headcount") > 0)


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def month_start_only(df: DataFrame, col: str = "date_day") -> DataFrame:
    """Rows dated on the first of a month."""
    return df.where(F.col(col) == F.trunc(col, "month"))


def q01(t: Tables, as_of: dt.date) -> DataFrame:
    """Last 14 loaded days."""
    return (
        _mart(t)
        .where(trailing("date_day", _last_loaded_day(t), 13))
        .select(
            "date_day", "active_headcount", "total_fte", "hires", "rehires", "terminations", "net_headcount_change"
        )
        .orderBy(F.col("date_day").desc())
    )


def q02(t: Tables, as_of: dt.date) -> DataFrame:
    """Monthly flows of the trailing 12 months."""
    return (
        _mart(t)
        .where(trailing("date_day", _last_loaded_day(t), 12, "month"))
        .groupBy(F.col("first_day_of_month").alias("month"))
        .agg(
            *_sums("hires", "rehires", "terminations"),
            F.sum("net_headcount_change").alias("net_change"),
        )
        .orderBy("month")
    )


def q02_all_months(t: Tables, as_of: dt.date) -> DataFrame:
    """Monthly hires, terminations, their balance and the highest head count, all loaded months."""
    return (
        _loaded(t)
        .groupBy(F.trunc("date_day", "month").alias("month"))
        .agg(
            F.sum("hires").alias("hires"),
            F.sum("terminations").alias("terms"),
            (F.sum("hires") - F.sum("terminations")).alias("net"),
            F.max("active_headcount").alias("eom_headcount"),
        )
        .orderBy("month")
    )


def q03(t: Tables, as_of: dt.date, days: int = 365) -> DataFrame:
    """Attrition of the trailing 12 months by department: terminations over person-days / ``days``."""
    anchor = last_day(t["active_intervals"])
    terms = (
        t["fact_employment_event"]
        .where((F.col("event_type") == "termination") & trailing("effective_date", anchor, 12, "month"))
        .groupBy("department")
        .agg(F.count(F.lit(1)).alias("terms"))
    )
    staff = person_days(t["active_intervals"], F.add_months(anchor, -12), anchor, ["department"])
    average = F.col("person_days").cast("double") / float(days)
    n = F.coalesce("terms", F.lit(0)).cast("bigint")
    return (
        staff.join(terms, "department", "left")
        .select(
            "department",
            n.alias("terms_12m"),
            round_away(average, 1).alias("avg_headcount_12m"),
            safe_ratio(n, average, 3).alias("attrition_rate"),
        )
        .orderBy(F.col("attrition_rate").desc_nulls_last(), "department")
    )


def q04(t: Tables, as_of: dt.date, k: int = 20) -> DataFrame:
    """Managers with the most direct reports on the last day."""
    today = last_snapshot(t["active_intervals"], last_termination(t["dim_employee"], as_of))
    spans = span_of_control(today, t["dim_employee"])
    return spans.orderBy(F.col("direct_reports").desc(), "manager", "department").limit(k)


def q05(t: Tables, as_of: dt.date) -> DataFrame:
    """Employees per level below the top on the last day."""
    today = last_snapshot(t["active_intervals"], last_termination(t["dim_employee"], as_of))
    return org_pyramid(manager_chain(today)).orderBy("levels_above")


def q06(t: Tables, as_of: dt.date, k: int = 20) -> DataFrame:
    """Names with more than one employment episode. Namesakes count together."""
    return (
        t["dim_employment_episode"]
        .select("employee_key", "hire_date")
        .join(t["dim_employee"].select("employee_key", "first_name", "last_name"), "employee_key")
        .groupBy("first_name", "last_name")
        .agg(
            F.count(F.lit(1)).alias("episode_count"),
            F.min("hire_date").alias("first_hire"),
            F.max("hire_date").alias("most_recent_hire"),
        )
        .where("episode_count > 1")
        .select(
            F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
            "episode_count",
            "first_hire",
            "most_recent_hire",
        )
        .orderBy(F.col("episode_count").desc(), F.col("most_recent_hire").desc(), "full_name")
        .limit(k)
    )


def q06_persons(t: Tables, as_of: dt.date) -> DataFrame:
    """All episodes of persons with more than one."""
    episodes = t["dim_employment_episode"].drop("person_external_id")
    persons = t["dim_person"].select("person_key", "person_external_id", "first_name", "last_name")
    joined = episodes.join(persons, "person_key")
    again = joined.groupBy("person_external_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        joined.join(again, "person_external_id", "left_semi")
        .select(
            "person_external_id",
            F.concat("first_name", F.lit(" "), "last_name").alias("name"),
            "episode_number",
            "worker_id",
            "hire_date",
            "termination_date",
            "tenure_days",
        )
        .orderBy("person_external_id", "episode_number")
    )


def q07(t: Tables, as_of: dt.date) -> DataFrame:
    """Every profile version of the employee with the most versions."""
    scd = t["dim_employee_profile_scd"]
    top = (
        scd.groupBy("employee_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "employee_key")
        .limit(1)
        .select("employee_key")
    )
    return (
        scd.join(F.broadcast(top), "employee_key")  # one row
        .select(
            "employee_key",
            "version_number",
            "version_event_type",
            "department",
            "job_title",
            "job_level",
            "manager_employee_key",
            "valid_from_date",
            "valid_to_date",
            "is_current",
        )
        .orderBy("valid_from_date")
    )


def q08(t: Tables, as_of: dt.date) -> DataFrame:
    """Employees per department by the profile valid at ``as_of``; leavers keep their last profile."""
    return (
        valid_on(t["dim_employee_profile_scd"], as_of)
        .groupBy("department")
        .agg(F.countDistinct("employee_key").alias("headcount_on_date"))
        .orderBy(F.col("headcount_on_date").desc(), "department")
    )


def q09(t: Tables, as_of: dt.date) -> DataFrame:
    """Active episodes by tenure band."""
    return (
        t["dim_employment_episode"]
        .where("is_active_episode")
        .groupBy(band(F.col("tenure_days"), TENURE_EDGES, TENURE_LABELS).alias("tenure_band"))
        .agg(F.count(F.lit(1)).alias("employees"), F.min("tenure_days").alias("_least"))
        .orderBy("_least")
        .drop("_least")
    )


def q10(t: Tables, as_of: dt.date) -> DataFrame:
    """Head count by worker type on the last loaded day."""
    return (
        _loaded(t)
        .select(
            "date_day",
            "full_time_headcount",
            "part_time_headcount",
            "contractor_headcount",
            "intern_headcount",
            "contingent_headcount",
            "active_headcount",
        )
        .orderBy(F.col("date_day").desc())
        .limit(1)
    )


def q11(t: Tables, as_of: dt.date) -> DataFrame:
    """Raw versions behind dimension rows."""
    return audit_trace(t["dim_employee"], t["raw_workers"])


def q12(t: Tables, as_of: dt.date) -> DataFrame:
    """Coverage and totals of the loaded days."""
    return _loaded(t).agg(
        F.min("date_day").alias("first_day"),
        F.max("date_day").alias("last_day"),
        F.max("active_headcount").alias("peak_headcount"),
        F.sum("hires").alias("total_hires"),
        F.sum("terminations").alias("total_terms"),
    )


def q12_last_days(t: Tables, as_of: dt.date, k: int = 7) -> DataFrame:
    """The last ``k`` loaded days."""
    return (
        _loaded(t)
        .select("date_day", "active_headcount", "total_fte", "hires", "terminations", "net_headcount_change")
        .orderBy(F.col("date_day").desc())
        .limit(k)
    )


def q13(t: Tables, as_of: dt.date) -> DataFrame:
    """Head count and FTE on the first of each month."""
    return month_start_only(_loaded(t)).select("date_day", "active_headcount", "total_fte").orderBy("date_day")


def q14(t: Tables, as_of: dt.date) -> DataFrame:
    """Monthly hires, terminations and net change."""
    return (
        _loaded(t)
        .groupBy(F.col("first_day_of_month").alias("month"))
        .agg(*_sums("hires", "terminations"), F.sum("net_headcount_change").alias("net_change"))
        .orderBy("month")
    )


def q14_moves(t: Tables, as_of: dt.date) -> DataFrame:
    """Monthly promotions and transfers, months with any."""
    return (
        _loaded(t)
        .groupBy(F.col("first_day_of_month").alias("month"))
        .agg(*_sums("promotions", "transfers"))
        .where("promotions + transfers > 0")
        .orderBy("month")
    )


def q15(t: Tables, as_of: dt.date) -> DataFrame:
    """Composition by worker type on the last loaded day, as one row."""
    names = {
        "full_time": "full_time_headcount",
        "part_time": "part_time_headcount",
        "contractors": "contractor_headcount",
        "interns": "intern_headcount",
        "contingent": "contingent_headcount",
    }
    return (
        _mart(t)
        .where(F.col("date_day") == _last_loaded_day(t))
        .agg(*[F.max(c).alias(name) for name, c in names.items()])
    )


def q16(t: Tables, as_of: dt.date) -> DataFrame:
    """Active episodes by current department."""
    return (
        t["dim_employment_episode"]
        .where("is_active_episode")
        .select("employee_key")
        .join(t["dim_employee"].select("employee_key", "current_department"), "employee_key")
        .groupBy(F.col("current_department").alias("department"))
        .agg(F.count(F.lit(1)).alias("headcount"))
        .orderBy(F.col("headcount").desc(), "department")
    )


def q17(t: Tables, as_of: dt.date) -> DataFrame:
    """Headline totals of all loaded days."""
    return _loaded(t).agg(
        F.max("active_headcount").alias("peak_headcount"),
        F.sum("hires").alias("total_hires"),
        F.sum("terminations").alias("total_terminations"),
        F.sum("promotions").alias("total_promotions"),
    )


def q17_last_year(t: Tables, as_of: dt.date, days: int = 365) -> DataFrame:
    """Headline totals of the ``days`` before ``as_of``."""
    return (
        _loaded(t)
        .where(F.col("date_day") >= F.date_sub(F.lit(as_of), days))
        .agg(
            F.max("active_headcount").alias("current_headcount"),
            F.max("total_fte").alias("current_fte"),
            F.sum("hires").alias("total_hires"),
            F.sum("terminations").alias("total_terms"),
        )
    )


def q18(t: Tables, as_of: dt.date) -> DataFrame:
    """Stage entries in funnel order."""
    return (
        t["fact_application_stage_history"]
        .groupBy(F.col("to_stage").alias("stage"))
        .agg(F.count(F.lit(1)).alias("candidates"))
        .orderBy(rank_in(F.col("stage"), STAGES).asc_nulls_last(), "stage")
    )


def _funnel(t: Tables) -> DataFrame:
    return t["mart_recruiting_funnel_daily"]


def _funnel_months(df: DataFrame):
    return df.groupBy(F.trunc("event_date", "month").alias("month"))


def q19(t: Tables, as_of: dt.date) -> DataFrame:
    """Monthly applications, hires and offers, months with applications."""
    return (
        _funnel_months(_funnel(t))
        .agg(
            F.sum("applications_submitted").alias("applications"),
            F.sum("hires").alias("hires"),
            F.sum("offers_extended").alias("offers"),
        )
        .where("applications > 0")
        .orderBy("month")
    )


def q20(t: Tables, as_of: dt.date) -> DataFrame:
    """Pipeline volume by department; days are averaged over daily averages."""
    return (
        _funnel(t)
        .where("applications_submitted > 0")
        .groupBy("department")
        .agg(
            F.sum("applications_submitted").alias("applications"),
            F.sum("hires").alias("hires"),
            F.sum("offers_extended").alias("offers"),
            round_away(F.avg("avg_days_in_funnel"), 1).alias("avg_days"),
        )
        .orderBy(F.col("applications").desc(), "department")
    )


def _percent(top: str, bottom: str) -> Column:
    return round_away(safe_ratio(F.sum(top) * 100, F.sum(bottom)), 1)


def q21(t: Tables, as_of: dt.date) -> DataFrame:
    """Monthly hire and acceptance rates in percent."""
    return (
        _funnel_months(_funnel(t).where("applications_submitted > 0"))
        .agg(
            _percent("hires", "applications_submitted").alias("hire_rate_pct"),
            _percent("offers_accepted", "offers_extended").alias("offer_accept_pct"),
        )
        .orderBy("month")
    )


def q22(t: Tables, as_of: dt.date) -> DataFrame:
    """Monthly mean of the daily days-in-funnel averages."""
    return (
        _funnel_months(_funnel(t).where("avg_days_in_funnel is not null"))
        .agg(round_away(F.avg("avg_days_in_funnel"), 1).alias("avg_days_to_hire"))
        .orderBy("month")
    )


def q23(t: Tables, as_of: dt.date, k: int = 10) -> DataFrame:
    """Requisition titles with the most applications."""
    per_app = (
        t["fact_application"]
        .select("requisition_key", "application_id", (F.col("current_stage") == "hired").alias("hired"))
        .join(t["dim_job_requisition"].select("requisition_key", "job_title", "department", "status"), "requisition_key")
        .groupBy("job_title", "department", "status", "application_id")
        .agg(F.bool_or("hired").alias("hired"))
        .where("application_id is not null")
    )
    return (
        per_app.groupBy(F.col("job_title").alias("requisition"), "department", "status")
        .agg(F.count(F.lit(1)).alias("applications"), F.count_if("hired").alias("hires"))
        .orderBy(
            F.col("applications").desc(),
            F.col("requisition").asc_nulls_last(),
            F.col("department").asc_nulls_last(),
            F.col("status").asc_nulls_last(),
        )
        .limit(k)
    )


def q24(t: Tables, as_of: dt.date, days: int = 365) -> DataFrame:
    """Recruiting summary of the ``days`` before ``as_of``."""
    return (
        _funnel(t)
        .where((F.col("event_date") >= F.date_sub(F.lit(as_of), days)) & (F.col("applications_submitted") > 0))
        .agg(
            F.sum("applications_submitted").alias("total_applications"),
            F.sum("hires").alias("total_hires"),
            round_away(F.avg("avg_days_in_funnel"), 1).alias("avg_days_to_hire"),
            round_away(F.avg("offer_acceptance_rate") * 100, 1).alias("offer_accept_pct"),
        )
    )


REPORTS = {
    name: fn for name, fn in list(globals().items()) if name[:1] == "q" and name[1:3].isdigit()
}
