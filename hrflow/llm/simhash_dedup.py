"""Near-duplicates by SimHash: inverted index over positional bytes with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrflow.llm.common import Scratch, beside_row_key, fresh, text_chunks, with_row_key
from hrflow.llm.components import connected_components

SEED = 42
#: Positional bytes in a fingerprint.
POSITIONS = 8


def fingerprint(text: bytes, width: int = 3, piece: int = 100_000) -> int:
    """SimHash of the word shingles of a text: a bit is 1 if it is set in over half of the shingles' XXH64.

    Words are split at ``[\\x20\\x09-\\x0D]``, A-Z count as lower case, repeats count each time. Fewer words than
    ``width`` make one shingle, no words give zero. Bits are summed piece by piece, so memory follows the text alone.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), piece):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[at : at + piece]], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(shingles)).tolist())


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            values = [fingerprint(t.as_buffer().to_pybytes(), width) for t in batch.column("text")]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k1", "k2")), pa.array(signed)], ["doc_id", "k1", "k2", "fp"])

    return run


def tallies(x: np.ndarray) -> np.ndarray:
    """How many positional bytes each pair shares; ``x`` holds the exclusive or of its fingerprints."""
    return (np.ascontiguousarray(x).view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)


def linked(x: np.ndarray, distance: int) -> np.ndarray:
    """Pairs (as exclusive or) within ``distance`` bits: those that share the guaranteed minimum of bytes are verified.

    Fingerprints at ``distance`` bits differ in at most as many bytes, so the count filter loses none.
    """
    near = tallies(x) >= POSITIONS - distance
    near[near] = np.bitwise_count(x[near]) <= distance
    return near


def _spanning(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that connect what links of at most ``distance`` bits connect: one fewer than members of each class."""
    edges, left = [], np.arange(len(fps))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            found = np.full(len(left), -1)
            for node in front:
                open_ = found < 0
                near = open_ & linked(fps[left] ^ fps[node], distance)
                found[near] = node
            hit = found >= 0
            edges += zip(found[hit].tolist(), left[hit].tolist(), strict=True)
            front, left = left[hit], left[~hit]
    return edges


def _links(distance: int):
    """Verified links inside each run of equal (key, block pair); the input is sorted by them."""

    def emit(fps: np.ndarray, edges: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(fps[pairs[:, 0]].view(np.int64)), pa.array(fps[pairs[:, 1]].view(np.int64))], ["a", "b"])

    def group(fps: np.ndarray, group_ids: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], group_ids[1:] != group_ids[:-1])))
        sizes = np.diff(np.append(starts, len(fps)))
        two = starts[sizes == 2]
        two = two[linked(fps[two] ^ fps[two + 1], distance)]
        edges = list(zip(two.tolist(), (two + 1).tolist(), strict=True))
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            edges += [(at + i, at + j) for i, j in _spanning(fps[at : at + n], distance)]
        return emit(fps, edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not table.num_rows:
                continue
            fps = table.column("fp").to_numpy().view(np.uint64)
            names = [table.column(c).to_numpy() for c in ("key", "low", "high")]
            new = reduce(np.logical_or, [x[1:] != x[:-1] for x in names])
            ids = np.concatenate(([0], np.cumsum(new)))
            last = int(np.searchsorted(ids, ids[-1]))  # the last run may go on in the next batch
            if last:
                yield group(fps[:last], ids[:last])
            rest = table.slice(last).to_batches()[0]
        if rest is not None:
            yield group(rest.column("fp").to_numpy().view(np.uint64), np.zeros(rest.num_rows, np.int64))

    return run


def _index_keys(distance: int, shared: int) -> list[Column]:
    """Keys of the inverted index: ``shared`` positional bytes at once.

    Fingerprints at ``distance`` bits differ in at most as many bytes, so they share at least 8 - distance positional
    bytes. Among any ``shared + distance`` positions they agree in ``shared`` of them, so those positions suffice.
    """
    keys = []
    for i, positions in enumerate(combinations(range(min(POSITIONS, shared + distance)), shared)):
        mask = sum(0xFF << 8 * p for p in positions)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed))))
    return keys


def _members(docs: DataFrame, doc_id: str, text: str, width: int, distance: int, shared: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint (doc_id, k1, k2, fp), and the root fingerprint of each fingerprint (fp, root)."""
    if not 0 <= distance <= POSITIONS - shared:
        raise ValueError("distance + shared must not exceed 8")
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = with_row_key(docs, doc_id, text).select("doc_id", "k1", "k2", F.col("text").cast("binary").alias("text"))
    prints = scratch.save(rows.mapInArrow(_fingerprints(width), "doc_id long, k1 long, k2 long, fp long"), "fingerprints")
    entries = prints.select("fp").distinct()
    keyed = entries.select("fp", F.explode(F.array(*_index_keys(distance, shared))).alias("key"))
    lists = keyed.groupBy("key").count().filter("count > 1").select(F.struct("key").alias("k"), "count")
    blocks = F.ceil(F.col("count") / block).cast("long")
    own = F.pmod(F.xxhash64("fp"), blocks)
    # A block meets itself and every other block; with one block that is one row.
    # Spark sizes ``keyed`` as if it had one row a fingerprint, so left to itself it may broadcast all of the keys.
    posted = (
        keyed.withColumn("k", F.struct("key"))
        .hint("merge")
        .join(lists, "k")
        .select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    )
    dealt = posted.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp")
    links = dealt.mapInArrow(_links(distance), "a long, b long").distinct()
    roots = connected_components(links, scratch)
    # A root is the smallest fingerprint that is reachable.
    return prints, entries.join(roots, entries.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    distance: int = 3,
    shared: int = 4,
    block: int = 1024,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest id reachable over links, of each row.

    Texts link if their fingerprints differ in at most ``distance`` (0 to 4) bits.

    Method: equal fingerprints are one entry. A posting list of the inverted index over byte positions stands for ``shared`` bytes
    at once, out of ``shared + distance`` positions, so pairs with fewer bytes in common never meet. Inside a list the shared
    bytes of each pair are tallied over all 8 positions, pairs that reach the guaranteed minimum of 8 - ``distance`` are
    retained and verified on all bits (``linked``). A list of more than ``block`` entries is dealt into blocks, and each
    pair of blocks is verified on its own. A verified list gives a spanning forest of its links, never all pairs.

    Null and blank texts have fingerprint zero and link like any other. Null ids are never a component_id unless a
    component has nothing else. Repeated rows give repeated rows; an empty table gives an empty result.
    """
    prints, member = _members(docs, doc_id, text, width, distance, shared, block)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    member = member.join(first, "fp")
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    names = member.select("fp", "root").join(named, "root").select(F.struct("fp").alias("k"), "component_id")
    return (
        prints.withColumn("k", F.struct("fp"))
        .join(names, "k")
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    )


def drop_simhash_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, distance: int = 3, shared: int = 4, block: int = 1024
) -> DataFrame:
    """The one row of each component of :func:`simhash_components` that stays, with all its columns.

    It is the row with the smallest id, null ids last, then the smallest hash of its text; of rows that repeat id and text one stays.
    """
    prints, member = _members(docs, doc_id, text, width, distance, shared, block)
    order = F.struct(F.col("doc_id").isNull().alias("gap"), "doc_id", "k1", "k2")
    first = prints.groupBy("fp").agg(F.min(order).alias("first")).join(member, "fp")
    stays = first.groupBy("root").agg(F.min("first").alias("first")).select("first.k1", "first.k2")
    rows, stays, key = beside_row_key(docs, stays, doc_id, text)
    (number,) = fresh(rows, "number")
    kept = rows.join(stays, key, "left_semi")
    return kept.withColumn(number, F.row_number().over(Window.partitionBy(*key).orderBy(key[1]))).filter(F.col(number) == 1).select(*docs.columns)
