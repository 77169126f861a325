"""An index of stored files by key: an erasure reads and rewrites only the files that may hold the person."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hrflow.sources.commits import CommitLog, Entry

#: Bits of a bitmap of ``bitmap_construct_agg``, and the seeds of the filter's positions.
BITS = 32_768
SEEDS = (1, 2, 3, 4, 5)


def _index(table: str) -> str:
    return f"{table}__files"


def _positions(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(s), key), F.lit(BITS)) for s in SEEDS])


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(blocks))


def file_filters(rows: DataFrame, key: Column, path: Column, blocks: int = 4) -> DataFrame:
    """path, low, high, block and bits: range and Bloom filter of the keys in each file, a row for each block of the filter in use.

    A key sets five bits in one of ``blocks`` blocks of 32,768 bits, all built by native bitmap aggregates: what is shuffled is at
    most one bitmap a file, block and task. Null keys are in no filter.
    """
    text = key.cast("string")
    keyed = rows.select(path.alias("path"), text.alias("key")).where("key is not null")
    bits = keyed.select("path", "key", _block(F.col("key"), blocks).alias("block"), F.explode(_positions(F.col("key"))).alias("bit"))
    made = bits.groupBy("path", "block").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.bitmap_construct_agg("bit").alias("bits"))
    return made.withColumn("blocks", F.lit(blocks))


def files_that_may_hold(filters: DataFrame, keys: DataFrame, key: str) -> list[str]:
    """Paths of the files whose range and filter admit one of the keys; a file that holds one is never left out.

    ``keys`` meet the filters by block, not each with each. The driver gets paths.
    """
    wanted = keys.select(F.col(key).cast("string").alias("key")).where("key is not null").distinct()
    per = filters.select("blocks").distinct()
    asked = wanted.join(F.broadcast(per)).select("key", "blocks", F.pmod(F.xxhash64(F.lit(0), "key"), F.col("blocks")).alias("block"))
    found = filters.join(asked, ["blocks", "block"]).where("key between low and high")
    byte = lambda p: F.conv(F.hex(F.substring("bits", (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.forall(_positions(F.col("key")), lambda p: F.getbit(byte(p), (p % 8).cast("int")) == 1)
    return sorted(r.path for r in found.where(held).select("path").distinct().collect())


def _file_of(log: CommitLog) -> Column:
    """The path of a row's file below the log's root."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/[0-9a-f]{32}/.*)$", 1)


def index_files(log: CommitLog, table: str, key: Callable[[], Column], run_id: str, blocks: int = 4) -> int:
    """Bring the file index of a table up to date: files that are in no index row yet are read, once."""
    if (done := log.committed(run_id)) is not None:
        return done
    state = log.state()
    files = [replace(e, path=p) for e in state.entries.get(table, ()) for p in _files(log, e)]
    known = {r.path for r in log.read(_index(table), state.version).select("path").distinct().collect()} if _index(table) in state.schemas else set()
    new = [e for e in files if e.path not in known]
    if not new:
        return log.commit(run_id)
    found = None
    for shape in sorted({e.schema for e in new}):
        rows = _read(log, [e for e in new if e.schema == shape])
        made = file_filters(rows.select("*", _file_of(log).alias("_file")), key(), F.col("_file"), blocks)
        found = made if found is None else found.unionByName(made)
    # A file without any key has a row of its own, so it counts as known.
    paths = log.spark.createDataFrame([(e.path,) for e in new], "path string")
    return log.commit(run_id, log.stage(paths.join(found, "path", "left"), _index(table)))


def _files(log: CommitLog, entry: Entry) -> list[str]:
    if entry.path.endswith(".parquet"):
        return [entry.path]
    return [f"{entry.path}/{n}" for n in log._names(f"{log.root}/{entry.path}") if n.endswith(".parquet")]


def _read(log: CommitLog, entries: list[Entry]) -> DataFrame:
    return log.spark.read.schema(T.StructType.fromJson(json.loads(entries[0].schema))).parquet(*[f"{log.root}/{e.path}" for e in entries])


def erase_in_files(
    log: CommitLog, table: str, persons: DataFrame, key: str, rewrite: Callable[[DataFrame], DataFrame], run_id: str
) -> tuple[int, list[str]]:
    """Apply ``rewrite`` to the files that may hold one of ``persons`` (column ``key``); the version and the files that went.

    The table must be indexed up to date by the same key (:func:`index_files`); files that the index does not know are rewritten too. All
    others stay as they are and are not read. ``rewrite`` gets the rows of those files and must leave rows of other persons as they
    are, as the filter may admit a file in error. Erased values are gone from the disk after ``log.sweep``.
    """
    if (done := log.committed(run_id)) is not None:
        return done, []
    state = log.state()
    entries = state.entries.get(table, [])
    filters = log.read(_index(table), state.version)
    by_file = {p: e for e in entries for p in _files(log, e)}
    indexed = {r.path for r in filters.select("path").distinct().collect()}
    hit = {*files_that_may_hold(filters, persons, key), *(p for p in by_file if p not in indexed)} & set(by_file)
    staged, gone = [], []
    for e in entries:
        files = [p for p, owner in by_file.items() if owner is e]
        touched = [p for p in files if p in hit]
        if not touched:
            continue
        gone.append(e)
        staged += [replace(e, path=p) for p in files if p not in hit]  # the same files, listed one by one from now on
        new = log.stage(rewrite(_read(log, [replace(e, path=p) for p in touched])), table)
        staged += [replace(n, part=e.part) for n in new]
    return log.commit(run_id, staged, remove=gone, since=state.version), sorted(hit)
