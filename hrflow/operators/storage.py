"""Materialisation: views, tables and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Session setting under which shuffle files are removed when the query that wrote them ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the session names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a private temporary folder; on a cluster such a folder
    would be gone with the machine, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hrflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for an intermediate table; inside ``scratch_scope`` the folder is removed at the scope's end."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _SCOPE.get()) is not None:
        paths.append(path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables that operators store inside the ``with`` block when it ends, by an error too.

    Results must have been written or collected by then: a DataFrame that is defined inside reads those tables. An inner scope
    removes its own tables only. Tables of other threads, of other sessions and of callers outside a scope are left alone.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            _remove(spark, path)


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Iterative operators call this per round. The written table survives lost executors, keeps the plan
    of the next round short, and gives the planner real sizes to choose join strategies from.
    """
    return _stored(df, scratch_path(df.sparkSession, name))


def _stored(df: DataFrame, path: str) -> DataFrame:
    """``df``, written and read back. The shuffle files of the writing go with it; else they stay until the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Rounds:
    """Tables of an iteration, each derived from the one before alone.

    A round's table is removed once the next is written in full, so an iteration occupies two tables however many rounds it takes,
    and nothing that may still be recomputed loses its input. The last table stays.
    """

    def __init__(self, name: str):
        self.name = name
        self.path: str | None = None

    def save(self, df: DataFrame) -> DataFrame:
        spark, before = df.sparkSession, self.path
        path = scratch_path(spark, self.name)
        out = _stored(df, path)
        self.path = path
        if before is not None:
            _remove(spark, before)
        return out


def materialize(
    df: DataFrame,
    name: str,
    kind: str = "view",
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Publish ``df`` as a temporary view or as a parquet table (managed, or external at ``path``)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}")
    if partition_by:
        # Brings the rows of a partition value together, so not every task writes a file per value.
        # Rebalancing splits values that are too large for one task, which ``repartition`` would not.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
