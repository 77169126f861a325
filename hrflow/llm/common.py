"""Helpers that several operators of this subpackage share: row keys, scratch tables, word hashes."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hrflow.operators.storage import shared_folder

#: One run of the characters that separate words: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def with_row_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (null becomes empty) and the columns ``k1``, ``k2`` that identify a row.

    Ids may be null or repeated. Rows with the same id and different texts differ in ``k2``; rows that agree in
    both are repeats of each other and share a key. All other columns are dropped, so names cannot clash.
    """
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).withColumns(
        {"k1": F.coalesce("doc_id", F.lit(0)), "k2": F.xxhash64("doc_id", "text")}
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def beside_row_key(docs: DataFrame, keyed: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """``docs`` with all its columns and its row keys under new names, ``keyed`` with its k1, k2 under those names, and the names."""
    a, b = fresh(docs, "row_k1", "row_k2")
    both = docs.withColumns(
        {
            a: F.coalesce(F.col(doc_id).cast("long"), F.lit(0)),
            b: F.xxhash64(F.col(doc_id).cast("long"), text_or_empty(text)),
        }
    )
    return both, keyed.withColumnsRenamed({"k1": a, "k2": b}), [a, b]


class Scratch:
    """Tables in the shared folder that cut the lineage. Files survive the loss of executors.

    ``drop`` removes a table once a later table that was derived from it is written in full, so nothing that may
    still be recomputed loses its input. What is left belongs to the retention rule of the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker and so serves all its tasks."""
    holder = sys.modules.setdefault("_llm_process_cache", types.ModuleType("_llm_process_cache"))
    return holder.__dict__.setdefault(name, {})


def text_chunks(batches, limit: int = 2 << 20, text: str = "text"):
    """Slices of Arrow batches with about ``limit`` bytes of the column ``text`` each, one row at least.

    Keeps the arrays of a task small whatever the batch size is. Only a single longer text exceeds the limit. Memory
    that Arrow holds in reserve goes back at the end, as a worker process serves other stages later.
    """
    for batch in batches:
        sizes = np.diff(offsets_of(batch.column(text)))
        at = 0
        while at < batch.num_rows:
            stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    pa.default_memory_pool().release_unused()


def offsets_of(column: pa.Array) -> np.ndarray:
    """Byte offsets of the values of a string or binary column, without copying the values."""
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffer = column.buffers()[1]
    if buffer is None:
        return np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffer, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a string or binary column without nulls as one byte array, and the offsets into it."""
    offsets = offsets_of(column)
    data = column.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, in order, and the number of words in each text.

    Words are runs of bytes other than those of ``SPACES``; A-Z count as lower case. A word's hash is a polynomial
    in its scrambled bytes modulo 2**64, scrambled again, so equal words have equal hashes everywhere.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    inner = ~is_space(data)
    cut = np.zeros(n + 1, bool)  # a text starts here
    cut[offsets] = True
    before = np.concatenate(([False], inner[:-1])) & ~cut[:-1]
    starts = np.flatnonzero(inner & ~before)
    after = np.concatenate((inner[1:], [False])) & ~cut[1:]
    ends = np.flatnonzero(inner & ~after) + 1
    table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[lowered(data)] * powers(BASE, n), out=sums[1:])
    back = powers(BASE_INVERSE, n)
    hashes = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return hashes, counts
