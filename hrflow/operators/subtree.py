"""Subtree labels: organisation sizes without a row per ancestor and employee.

The managers of a group (a day, say) form a forest. Its Euler tour, which enters and leaves every manager once, is one list a
tree; sums from an element to the end of its list are found by pointer doubling, a join a round, and the difference between
entering and leaving is what lies below a manager. Employees without reports are no elements, they are the weight of their manager.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrflow.operators.hierarchy import manager_chain, org_size
from hrflow.operators.storage import cut_lineage

#: Siblings are put in order in this many parts, so the managers below one person are no single task's work.
PARTS = 1024


def _enter(key: str) -> Column:
    return F.concat(F.lit("+"), F.col(key))


def _leave(key: str) -> Column:
    return F.concat(F.lit("-"), F.col(key))


def _siblings(kids: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(group, parent, first child) and (group, parent, child, next child), in an order of its own."""
    kids = kids.withColumn("part", F.pmod(F.xxhash64("employee_key"), F.lit(PARTS)))
    group = [*on, "parent"]
    heads = kids.groupBy(*group, "part").agg(F.min("employee_key").alias("head"))
    first = heads.groupBy(*group).agg(F.min_by("head", "part").alias("first"))
    following = heads.withColumn("next_head", F.lead("head").over(Window.partitionBy(*group).orderBy("part"))).drop("head")
    inside = F.lead("employee_key").over(Window.partitionBy(*group, "part").orderBy("employee_key"))
    ordered = kids.withColumn("inside", inside).join(following, [*group, "part"])
    return first, ordered.select(*group, "employee_key", F.coalesce("inside", "next_head").alias("sibling"))


def _tour(links: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Managers with their direct reports, and the elements of the tours with their successors.

    A person with several managers in a group follows itself: no list through that person ends, as none does through a cycle.
    """
    node = [*on, "employee_key"]
    staff = links.groupBy(*on, F.col("parent").alias("employee_key")).agg(F.count(F.lit(1)).alias("direct"))
    above = links.groupBy(*node).agg(F.count(F.lit(1)).alias("parents"), F.min("parent").alias("parent"))
    nodes = staff.join(above, node, "full").where("direct is not null or parents > 1")
    nodes = cut_lineage(nodes.select(*node, F.coalesce("direct", F.lit(0)).alias("direct"), "parents", "parent"), "managers")
    first, ordered = _siblings(links.join(nodes.select(*node), node, "left_semi"), on)
    entered = nodes.join(first.withColumnRenamed("parent", "employee_key"), node, "left").select(
        *on,
        _enter("employee_key").alias("id"),
        F.coalesce(_enter("first"), _leave("employee_key")).alias("next"),
        F.lit(1).cast("bigint").alias("managers"),
        F.col("direct").alias("staff"),
        F.lit(None).cast("string").alias("tree"),
    )
    after = F.coalesce(_enter("sibling"), _leave("parent"))
    left = nodes.join(ordered, [*on, "parent", "employee_key"], "left").select(
        *on,
        _leave("employee_key").alias("id"),
        F.when(F.col("parents") > 1, _leave("employee_key")).otherwise(after).alias("next"),
        F.lit(0).cast("bigint").alias("managers"),
        F.lit(0).cast("bigint").alias("staff"),
        F.when(F.col("parents").isNull(), F.col("employee_key")).alias("tree"),
    )
    return nodes, cut_lineage(entered.unionByName(left), "tour")


def _sums_to_end(elements: DataFrame, on: list[str]) -> DataFrame:
    """Every element with the sums from itself to the end of its list, and the tree that ends there.

    Each round doubles the distance covered; only elements that have not reached an end are joined. Lists that end lose
    open elements in every round, so once a round closes none, what is open lies before a cycle and is left out.
    """
    pending, closed = elements.where("next is not null"), elements.where("next is null")
    count, before = pending.count(), -1
    while count and count != before:
        a, b = pending.alias("a"), closed.unionByName(pending).alias("b")
        same = F.col("a.next") == F.col("b.id")
        for name in on:
            same &= F.col(f"a.{name}") == F.col(f"b.{name}")
        step = a.join(b, same).select(
            *[F.col(f"a.{name}") for name in on],
            "a.id",
            "b.next",
            *[(F.col(f"a.{name}") + F.col(f"b.{name}")).alias(name) for name in ("managers", "staff")],
            "b.tree",
        )
        step = cut_lineage(step, "tour")
        closed, pending = closed.unionByName(step.where("next is null")), step.where("next is not null")
        before, count = count, pending.count()
    return closed


def subtree_labels(snapshot: DataFrame, on: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """One row per manager and group: (on, manager_employee_key, tree, low, high, direct_reports, total_org_size).

    ``high`` numbers the managers of a tree, ``tree`` is the person at its top. Manager x is at or below manager m just where
    both have one tree and ``x.high`` lies between ``m.low`` and ``m.high``. Managers above a cycle, or above a person with
    several managers, have no subtree: ``tree``, ``low``, ``high`` and ``total_org_size`` are null. So may be others that come before these in
    the tour; labels that are given are right. Repeated rows count once; rows without a manager, an employee or a group take no part. Depth is not limited.
    """
    on = list(on)
    known = [F.col(name).isNotNull() for name in (*on, "employee_key", "manager_employee_key")]
    links = snapshot
    for condition in known:
        links = links.where(condition)
    links = cut_lineage(links.select(*on, F.col("manager_employee_key").alias("parent"), "employee_key").distinct(), "links")
    nodes, elements = _tour(links, on)
    sums = _sums_to_end(elements, on)
    enters = F.col("id").startswith("+")
    ends = sums.groupBy(*on, F.substr("id", F.lit(2)).alias("employee_key")).agg(
        F.max(F.when(enters, F.col("managers"))).alias("high"),
        F.max(F.when(enters, F.col("tree"))).alias("tree"),
        (F.max(F.when(~enters, F.col("managers"))) + 1).alias("low"),
        (F.max(F.when(enters, F.col("staff"))) - F.max(F.when(~enters, F.col("staff")))).alias("total"),
    )
    return nodes.where("direct > 0").join(ends, [*on, "employee_key"], "left").select(
        *on,
        F.col("employee_key").alias("manager_employee_key"),
        "tree",
        F.when(F.col("high").isNotNull(), F.col("low")).alias("low"),
        "high",
        F.col("direct").alias("direct_reports"),
        F.col("total").alias("total_org_size"),
    )


def org_size_by_labels(snapshot: DataFrame) -> DataFrame:
    """Direct reports and whole organisation per manager and day, as ``org_size`` of the chain gives them.

    Managers without a label are counted by the chain, on their days only. Labels know no limit of depth, the chain does:
    in a tree of more than ``MAX_DEPTH`` levels labels also count those that the chain no longer reaches.
    """
    names = ["snapshot_date", "manager_employee_key", "direct_reports", "total_org_size"]
    labels = cut_lineage(subtree_labels(snapshot), "labels")
    sizes = labels.where("high is not null").select(names)
    without = labels.where("high is null")
    if without.isEmpty():
        return sizes
    chain = manager_chain(snapshot.join(without.select("snapshot_date").distinct(), "snapshot_date", "left_semi"))
    above = without.select("snapshot_date", F.col("manager_employee_key").alias("ancestor_employee_key"))
    counted = org_size(chain.join(above, ["snapshot_date", "ancestor_employee_key"], "left_semi"))
    return sizes.unionByName(counted.select(names))


def managers_below(labels: DataFrame, managers: DataFrame, on: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """(on, manager_employee_key, below): the managers at or below each of ``managers``, by ranges of labels.

    ``managers`` holds the group columns and ``manager_employee_key``; those without a label have no rows.
    """
    on = list(on)
    asked = labels.join(managers.select(*on, "manager_employee_key").distinct(), [*on, "manager_employee_key"], "left_semi")
    same = F.col("a.tree") == F.col("x.tree")
    for name in on:
        same &= F.col(f"a.{name}") == F.col(f"x.{name}")
    inside = F.col("x.high").between(F.col("a.low"), F.col("a.high"))
    return (
        asked.alias("a")
        .join(labels.alias("x"), same & inside)
        .select(*[F.col(f"a.{name}") for name in on], "a.manager_employee_key", F.col("x.manager_employee_key").alias("below"))
    )
