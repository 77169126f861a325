"""Event landing with deduplication, and its scheduled reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hrflow.operators.dedupe import latest
from hrflow.operators.reconcile import reconcile
from hrflow.sources.commits import CommitLog


def read_events(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Stream of event files that arrive in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def first_deliveries(landed: DataFrame, id_col: str, ts_col: str) -> DataFrame:
    """One row per event id, the earliest; of equal times the one with the smallest hash of all columns.

    The stream lands every delivery, however late, and repeats are removed here. A watermark in the stream would drop
    events that come behind it for the first time.
    """
    return latest(landed, [id_col], [F.col(ts_col).asc_nulls_last(), F.xxhash64(*landed.columns)])


def check_deliveries(events: DataFrame, id_col: str, ts_col: str, as_of: dt.datetime, hours: int = 24) -> DataFrame:
    """One row if the events of the last ``hours`` before ``as_of`` hold an id more than once: rows and distinct ids."""
    end = F.lit(as_of).cast("timestamp")
    recent = events.where((F.col(ts_col) > end - F.expr(f"interval {int(hours)} hours")) & (F.col(ts_col) <= end))
    per_id = recent.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    totals = per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("distinct_ids"))
    return totals.where("row_count <> distinct_ids")


def land_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every delivery available now, repeats and late ones too, and stop.

    A rerun continues where the checkpoint ends.
    """
    return (
        events.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_committed(events: DataFrame, log: CommitLog, table: str, checkpoint: str, stream: str) -> StreamingQuery:
    """Like :func:`land_events` for a commit log: a batch is a run of its own, named by ``stream`` and its number.

    A batch that is replayed after a failure finds its run in the log and lands nothing twice.
    """

    def batch(rows: DataFrame, number: int) -> None:
        log.run(f"{stream}-{number}", lambda: {table: rows})

    return (
        events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def reconcile_events(full_extract: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Event ids that only the full extract or only the landed stream has."""
    return reconcile(full_extract, landed, keys)
