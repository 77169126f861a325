"""Digest trees of tables: equal parts of two tables are told without reading them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.operators.reconcile import reconcile, restate
from hrflow.sources.commits import CommitLog

#: Children of a node of the tree.
FANOUT = 16
BUCKET = "_bucket"


def _hash(columns: Sequence[str], seed: int) -> Column:
    """A hash that tells nulls from values and keeps their places apart."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def bucket_of(keys: Sequence[str], depth: int) -> Column:
    return F.pmod(_hash(keys, 0), F.lit(FANOUT**depth)).cast("int")


def digest_tree(df: DataFrame, keys: Sequence[str], values: Sequence[str] = (), depth: int = 2) -> DataFrame:
    """level, bucket, n and digests of all rows of a bucket, for every level from the root (0) to the leaves (``depth``).

    A digest is the sum of two hashes of each row, so it does not depend on the order, counts repeated rows, and adds up from
    buckets to their parent. ``key_*`` digests the keys alone, ``row_*`` keys and values. Rows are summed before the
    shuffle; what is shuffled is at most one row for each task and leaf.
    """
    sums = ("n", "key_a", "key_b", "row_a", "row_b")
    hashed = df.select(
        bucket_of(keys, depth).alias("bucket"),
        F.lit(1).cast("decimal(38,0)").alias("n"),
        *[_hash(c, s).cast("decimal(38,0)").alias(f"{n}_{x}") for n, c in (("key", keys), ("row", (*keys, *values))) for x, s in (("a", 1), ("b", 2))],
    )
    leaves = hashed.groupBy("bucket").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in sums])
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    spread = leaves.select(levels, "bucket", *sums).withColumn("bucket", F.floor(F.col("bucket") / F.pow(F.lit(FANOUT), depth - F.col("level"))).cast("int"))
    return spread.groupBy("level", "bucket").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in sums])


def differing_buckets(a: DataFrame, b: DataFrame, depth: int = 2, by_rows: bool = False) -> list[int]:
    """Leaves in which two trees differ, found from the root down: children are compared below nodes that differ alone.

    The driver holds names of nodes, at most ``FANOUT`` ** ``depth`` of them. Equal tables cost one comparison of two rows.
    """
    digests = ["n", "key_a", "key_b", *(("row_a", "row_b") if by_rows else ())]
    nodes = [0]
    for level in range(depth + 1):
        if not nodes:
            return []
        here = [df.where((F.col("level") == level) & F.col("bucket").isin(nodes)).select("bucket", *digests) for df in (a, b)]
        odd = here[0].unionByName(here[1]).groupBy("bucket", *digests).count().where("count = 1").select("bucket").distinct()
        found = sorted(r.bucket for r in odd.collect())
        if level == depth:
            return found
        nodes = [n * FANOUT + i for n in found for i in range(FANOUT)]
    return []


def _digests(table: str) -> str:
    return f"{table}__digests"


def store_with_digests(
    log: CommitLog, df: DataFrame, table: str, keys: Sequence[str], run_id: str, values: Sequence[str] = (), depth: int = 2
) -> int:
    """Replace a table of the log by ``df``, a folder for each leaf, together with its digest tree."""
    done = log.committed(run_id)
    if done is not None:
        return done
    staged = log.stage(df.withColumn(BUCKET, bucket_of(keys, depth)), table, by=BUCKET)
    # The tree is made of what has been written, which a second run of ``df`` need not equal.
    schema = df.withColumn(BUCKET, bucket_of(keys, depth)).schema
    written = log.spark.read.schema(schema).parquet(*[f"{log.root}/{e.path}" for e in staged]) if staged else log.spark.createDataFrame([], schema)
    tree = log.stage(digest_tree(written, keys, values, depth), _digests(table))
    return log.commit(run_id, [*staged, *tree], replace_tables=[table, _digests(table)])


def _parts(log: CommitLog, a: str, b: str, depth: int, by_rows: bool) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in leaves that differ. A table without rows takes the columns of the other."""
    odd = [str(i) for i in differing_buckets(log.read(_digests(a)), log.read(_digests(b)), depth, by_rows)]
    shape = log.read(a if a in log.state().schemas else b, parts=[]).schema
    return tuple(log.read(t, parts=odd, schema=shape).drop(BUCKET) for t in (a, b))


def reconcile_stored(log: CommitLog, extract: str, warehouse: str, keys: Sequence[str], depth: int = 2) -> DataFrame:
    """The rows of ``reconcile`` for two tables of the log; folders of leaves with equal digests are not read."""
    a, b = _parts(log, extract, warehouse, depth, by_rows=False)
    return reconcile(a, b, keys)


def restate_stored(
    log: CommitLog, published: str, rebuilt: str, keys: Sequence[str], values: Sequence[str], restated_at: dt.datetime, reason: str, depth: int = 2
) -> DataFrame:
    """The rows of ``restate`` for two tables of the log, with digests over keys and ``values``; equal leaves are not read."""
    a, b = _parts(log, published, rebuilt, depth, by_rows=True)
    return restate(a, b, keys, values, restated_at, reason)
