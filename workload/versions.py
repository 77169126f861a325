"""Queries over stored versions: merges in buckets, digest trees, restated months, supersession, erasure by file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hrflow.operators import identity, supersede
from hrflow.operators.digests import reconcile_stored, restate_stored, store_with_digests
from hrflow.operators.file_index import erase_in_files, index_files
from hrflow.operators.registry import merge_registry, read_registry
from hrflow.operators.snapshot import active_intervals, daily_totals, last_termination
from hrflow.operators.storage import cut_lineage, scratch_path
from hrflow.plans import core
from hrflow.plans.restatement import clipped, dirty_months, publish_daily, read_daily, restate_months
from hrflow.sources.commits import CommitLog
from workload.checks import check
from workload.governance import NOW, _records, _registry
from workload.landing import RUN_1
from workload.registry import CHECKS, query
from workload.views import AS_OF, START, table


def _log(spark, name: str) -> CommitLog:
    return CommitLog(spark, scratch_path(spark, name))


def _matches(customers, letter: str, method: str, confidence: float):
    return _records(customers).select(
        *identity.REGISTRY_KEYS,
        F.concat(F.lit(letter), F.col("c_custkey").cast("string")).alias("resolved_person_key"),
        F.lit(method).alias("match_method"),
        F.lit(confidence).alias("match_confidence"),
    )


@query("registry_merge", CHECKS["identity_merge"])
def _registry_merge(t, spark, sf):
    """The registry as a stored table: seeded, merged with the customers of a good balance, one run repeated."""
    c = table(spark, sf, "customer")
    log = _log(spark, "registry")
    merge_registry(log, _matches(c.where("c_mktsegment <> 'BUILDING'"), "P", "seed", 1.0), RUN_1, "seed", buckets=16)
    for _ in range(2):
        merge_registry(log, _matches(c.where("c_acctbal > 1000"), "Q", "email", 0.5), NOW, "merge", buckets=16)
    return read_registry(log).select(_registry(c).columns)


@query("reconcile_digests", CHECKS["reconcile_diff"])
def _reconcile_digests(t, spark, sf):
    """The same difference as ``reconcile_diff`` from stored tables, by their digest trees."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    log = _log(spark, "digests")
    store_with_digests(log, c.where("c_acctbal > 0"), "extract", ["c_custkey"], "extract", ["c_mktsegment"], depth=1)
    store_with_digests(log, c.where("c_mktsegment <> 'BUILDING'"), "warehouse", ["c_custkey"], "warehouse", ["c_mktsegment"], depth=1)
    return reconcile_stored(log, "extract", "warehouse", ["c_custkey"], depth=1)


@query(
    "restate_digests",
    """select o_orderkey, 'changed' as change, o_totalprice as old_o_totalprice, o_totalprice + 1 as o_totalprice,
              timestamp '2001-12-31 12:00:00' as restated_at_utc, 'late_data' as restatement_reason
       from orders where o_orderkey % 1000 = 7""",
)
def _restate_digests(t, spark, sf):
    """Few changed orders among all, found by the digests of keys and values."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    late = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    log = _log(spark, "digests")
    for name, df in (("published", o), ("rebuilt", late)):
        store_with_digests(log, df, name, ["o_orderkey"], name, ["o_totalprice"], depth=1)
    return restate_stored(log, "published", "rebuilt", ["o_orderkey"], ["o_totalprice"], NOW, "late_data", depth=1)


EDIT = (dt.date(1998, 3, 10), dt.date(1998, 4, 20))


def _restated(t, spark) -> CommitLog:
    """Daily head count by department, published and frozen, then restated after back-dated changes of departments."""
    log = _log(spark, "published")
    scd = t["dim_employee_profile_scd"]
    edited = F.col("valid_from_date").between(*map(F.lit, EDIT)) & (F.col("job_level") == "F")
    episodes = core.employment_stints(t["stg_workers"], AS_OF)
    end = last_termination(t["stg_workers"], AS_OF)
    new_scd = scd.withColumn("department", F.when(edited, "Moved").otherwise(F.col("department")))
    names = ["employee_key", "department", "from_date", "to_date"]
    old, new = (cut_lineage(active_intervals(s, episodes, START, end).select(names), "intervals") for s in (scd, new_scd))
    by_department = lambda df: daily_totals(df, {}, ["department"])
    publish_daily(log, "headcount", by_department(old), "snapshot_date", "v1", tag="board")
    months = dirty_months(old, new, ["employee_key", "department"], "from_date", "to_date", START, AS_OF)
    for _ in range(2):
        restate_months(
            log, "headcount", lambda a, b: by_department(clipped(new, a, b)), months, "snapshot_date", ["department"], "v2", NOW, "back_dated"
        )
    return log


_EDITED = f"""(select s.snapshot_date, s.department,
        case when p.valid_from_date between date '{EDIT[0]}' and date '{EDIT[1]}' and p.job_level = 'F' then 'Moved'
             else s.department end as moved
    from snapshot s join scd p on p.employee_profile_key = s.employee_profile_key)"""


@query(
    "restated_range",
    check(
        f"""with e as {_EDITED},
             o as (select snapshot_date, department, count(*) as n from e group by all),
             r as (select snapshot_date, moved as department, count(*) as n from e group by all)
        select r.snapshot_date, r.department, r.n,
               case when o.n is distinct from r.n then timestamp '2001-12-31 12:00:00' end as restated_at_utc,
               case when o.n is distinct from r.n then 'back_dated' end as restatement_reason
        from r left join o on o.snapshot_date = r.snapshot_date and o.department is not distinct from r.department"""
    ),
)
def _restated_range(t, spark, sf):
    """The mart after the months that the changes touch have been rebuilt; all others were left alone."""
    return read_daily(_restated(t, spark), "headcount")


@query(
    "restated_frozen",
    check("select snapshot_date, department, count(*) as n from snapshot group by all"),
)
def _restated_frozen(t, spark, sf):
    """The version that was frozen for the board, read after the restatement."""
    return read_daily(_restated(t, spark), "headcount", "board").select("snapshot_date", "department", "n")


FIRST, GONE, BACK = (dt.datetime(2001, 12, d) for d in (1, 10, 20))


def _replayed(spark, sf):
    """Customers landed once, some missing from a later full extract, some landed again after that."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    at = lambda df, moment: df.withColumn("updated_at", F.lit(moment).cast("timestamp"))
    first = at(c, FIRST)
    again = at(c.where("c_acctbal < -500 or (c_mktsegment = 'BUILDING' and c_acctbal > 0)"), BACK)
    events = supersede.deletions(first, c.where("c_acctbal > 0"), ["c_custkey"], GONE, "updated_at")
    return supersede.replay(first.unionByName(again), events, ["c_custkey"], "updated_at")


_AGAIN = "(c_acctbal < -500 or (c_mktsegment = 'BUILDING' and c_acctbal > 0))"


@query(
    "supersession",
    f"""select c_custkey, timestamp '2001-12-01 00:00:00' as valid_from,
               case when c_acctbal <= 0 then timestamp '2001-12-10 00:00:00'
                    when {_AGAIN} then timestamp '2001-12-20 00:00:00' end as valid_to,
               case when c_acctbal <= 0 then 'deletion' when {_AGAIN} then 'version' end as closed_by,
               c_acctbal > 0 and not {_AGAIN} as is_active
        from customer
        union all
        select c_custkey, timestamp '2001-12-20 00:00:00', null, null, true from customer where {_AGAIN}""",
)
def _supersession(t, spark, sf):
    """Validity of every customer version after deletions at the source and returns."""
    return _replayed(spark, sf).select("c_custkey", "valid_from", "valid_to", "closed_by", "is_active")


@query(
    "supersession_dimension",
    """select c_custkey as candidate_id, not (c_acctbal <= 0 and c_acctbal >= -500) as is_active,
              case when c_acctbal <= 0 and c_acctbal >= -500 then timestamp '2001-12-10 00:00:00' end as inactive_since
       from customer""",
)
def _supersession_dimension(t, spark, sf):
    """The candidate dimension with rows of deleted customers marked inactive."""
    dim = t["dim_candidate"].select(F.col("candidate_id").cast("long").alias("candidate_id"))
    replayed = _replayed(spark, sf).withColumnRenamed("c_custkey", "candidate_id")
    return supersede.mark_inactive(dim, replayed, ["candidate_id"])


@query(
    "erase_by_file",
    """select c_custkey, case when c_custkey in (17, 400) then '__ERASED__' else c_name end as c_name from customer""",
)
def _erase_by_file(t, spark, sf):
    """Two customers erased in an indexed table of many files; only files that may hold them are rewritten."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    log = _log(spark, "files")
    log.run("load", lambda: {"customers": c.repartitionByRange(16, "c_custkey")})
    index_files(log, "customers", lambda: F.col("c_custkey"), "index")
    persons = c.where("c_custkey in (17, 400)").select("c_custkey")
    name = F.when(F.col("c_custkey").isin(17, 400), "__ERASED__").otherwise(F.col("c_name"))
    erase_in_files(log, "customers", persons, "c_custkey", lambda df: df.withColumn("c_name", name), "erase")
    return log.read("customers")
