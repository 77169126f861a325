"""Exact top-k inner-product search, pruned by segment statistics from coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.llm.common import Scratch

#: Up to this sum of products float64 is exact for integers.
EXACT = float(1 << 53)
#: Bytes of candidates that one task holds.
SLOT = 32 << 20


def scaled(df: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """``vec_id`` and ``v``, the components as floor(scale * x); without vectors that hold nulls, NaN or infinities."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        df.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
        .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine)
        .select("vec_id", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"))
    )


def _rows(df: DataFrame, most: int | None = None) -> DataFrame:
    """``vec_id``, ``v`` and ``nth``, which counts equal rows from 1; trailing zeros of ``v`` go, so vectors equal when filled up are equal.

    Rows are counted before they are numbered, so a row that a third of all rows repeat is one row a task in the shuffle.
    """
    last = F.array_position(F.reverse(F.transform("v", lambda c: c != 0)), True)
    short = F.slice("v", 1, F.when(last > 0, F.size("v") - last + 1).otherwise(0).cast("int"))
    counted = df.select("vec_id", short.alias("v")).groupBy("vec_id", "v").count()
    copies = F.col("count") if most is None else F.least("count", F.lit(most))
    return counted.select("vec_id", "v", F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long"))).alias("nth"))


def _packed(size: int):
    """Blocks of up to ``size`` vectors as one row: ids, numbers of copies and components as binary, filled up with zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column("v")
                lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                matrix = np.zeros((len(lengths), max(1, int(lengths.max(initial=0)))), np.int64)
                matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
                small = np.abs(matrix).max(initial=0) < 1 << 31
                yield pa.RecordBatch.from_pydict(
                    {
                        "dims": pa.array([matrix.shape[1]]),
                        "ids": pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()),
                        "nth": pa.array([part.column("nth").to_numpy().tobytes()], pa.binary()),
                        "vectors": pa.array([matrix.astype(np.int32 if small else np.int64).tobytes()], pa.binary()),
                    }
                )

    return run


def _matrix(ids: np.ndarray, blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, np.int32 if len(blob) == 4 * len(ids) * dims else np.int64).reshape(len(ids), dims)


def _widened(x: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, dims - x.shape[1])))


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment mean and deviation, each times the root of the segment's length, side by side.

    For two vectors the product of these rows bounds their inner product from above: within a segment of length m it is
    m * mean * mean plus the inner product of the centred parts, which is at most m * deviation * deviation. As
    distances these are lower bounds, since |q - x|^2 = |q|^2 + |x|^2 - 2 q.x.
    """
    edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part = x[:, a:b].astype(np.float64)
        mean = part.mean(axis=1)
        out += [mean * np.sqrt(b - a), np.sqrt(np.square(part - mean[:, None]).sum(axis=1))]
    return np.stack(out, axis=1)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: in float64 as long as no sum can leave the range of exact integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


class _Best:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, nth: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.nth, self.vectors, self.k = ids, nth, vectors, k
        self.score = np.full((len(ids), 0), 0, np.int64)
        self.found = np.full((len(ids), 0), 0, np.int64)
        self.valid = np.zeros((len(ids), 0), bool)

    def offer(self, score: np.ndarray, found: np.ndarray, valid: np.ndarray) -> None:
        """Merges candidates (one row a query); ties go to the smaller id."""
        score, found = np.hstack([self.score, score]), np.hstack([self.found, found])
        valid = np.hstack([self.valid, valid])
        order = np.lexsort((found, -score, ~valid), axis=1)[:, : self.k]
        self.score, self.found, self.valid = (np.take_along_axis(x, order, 1) for x in (score, found, valid))

    def floor(self) -> np.ndarray:
        """What a candidate has to reach; minus infinity while a query has fewer than k."""
        if self.score.shape[1] < self.k:
            return np.full(len(self.ids), -np.inf)
        return np.where(self.valid[:, -1], self.score[:, -1], -np.inf)

    def _others(self, ids: np.ndarray, nth: np.ndarray, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """False where a candidate is the query's own row: id, vector and number among equal rows agree."""
        other = np.ones((len(self.ids), len(ids)), bool)
        same = (self.ids[:, None] == ids) & (self.nth[:, None] == nth)
        for i, j in zip(*np.nonzero(same), strict=True):
            other[i, j] = not np.array_equal(q[i], x[j])
        return other

    def search(self, ids: np.ndarray, nth: np.ndarray, x: np.ndarray, resolutions: tuple[int, ...]) -> None:
        q = self.vectors
        dims = max(q.shape[1], x.shape[1])
        q, x = _widened(q, dims), _widened(x, dims)
        columns, floor = np.arange(len(ids)), self.floor()
        for segments in resolutions:
            if segments > dims or np.isneginf(floor).all() or not len(columns):
                continue
            bound = _statistics(q, segments) @ _statistics(x[columns], segments).T
            slack = 1e-9 * np.abs(bound).max(initial=1.0) + 1e-6
            columns = columns[(bound + slack >= floor[:, None]).any(axis=0)]
        if len(columns):
            score = _scores(q, x[columns])
            found = np.broadcast_to(ids[columns], score.shape)
            self.offer(score, found, self._others(ids[columns], nth[columns], q, x[columns]) & (score >= floor[:, None]))

    def rows(self) -> pa.RecordBatch:
        at, rank = np.nonzero(self.valid)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[at]), pa.array(at), pa.array(self.found[at, rank]), pa.array(self.score[at, rank])],
            ["query_id", "place", "vec_id", "score"],
        )


def _search(k: int, resolutions: tuple[int, ...], step: int):
    """The best of each query block over all candidate blocks of its slot; of a slot the candidates (no block number) come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):  # row by row: only what is held is copied
                row = {c: batch.column(c)[at].as_py() for c in ("slot", "block", "dims", "ids", "nth", "vectors")}
                if row["slot"] != slot:
                    slot, held = row["slot"], []
                ids, nth = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["nth"], np.int64)
                x = _matrix(ids, row["vectors"], row["dims"])
                if row["block"] is None:
                    held.append((ids, nth, x))
                    continue
                best = _Best(ids, nth, x, k)
                for other, numbers, y in held:
                    for i in range(0, len(other), step):
                        best.search(other[i : i + step], numbers[i : i + step], y[i : i + step], resolutions)
                found = best.rows()
                yield found.add_column(0, "block", pa.array([row["block"]] * found.num_rows, pa.int64()))

    return run


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
    query_block: int = 256,
    block: int = 2048,
    resolutions: tuple[int, ...] = (1, 4, 16),
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of ``vectors`` with the largest integer inner product for each query.

    Components count as floor(scale * x). Ties go to the smaller vec_id; a query is not its own candidate (id, vector and, among
    equal rows, the copy are its own); with fewer than ``k`` candidates all are returned.

    Method: both sides are packed into blocks of rows, and every block of queries meets every block of candidates: a task holds its
    slot of candidates while all query blocks pass. There, means and deviations of 1, 4 and 16 segments bound the inner products from above, coarse to fine; only candidates
    whose bound reaches some query's k-th best score so far are scored exactly. A task's rows are k for each query
    it saw, whatever the number of candidates.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do rows without an id. Every row
    counts, also where rows share an id: each is a candidate, and as a query each has its own ranks under that id. Of equal rows
    k + 1 are compared, as more cannot be among the first k. Shorter vectors count as filled up with zeros. Empty tables
    give an empty result.
    """
    scratch = Scratch(vectors.sparkSession, "top-k")

    def side(df: DataFrame, size: int, name: str, most: int | None = None) -> DataFrame:
        rows = _rows(scaled(df, vec_id, vector, scale), most)
        packed = rows.mapInArrow(_packed(size), "dims long, ids binary, nth binary, vectors binary")
        return scratch.save(packed, name)

    right = side(vectors, block, "candidates", k + 1)
    left = side(queries, query_block, "queries").withColumn("block", F.monotonically_increasing_id())
    left = scratch.save(left, "query-blocks")
    # Candidates are dealt into slots of about ``SLOT`` bytes, more if there are cores for them; each slot receives all query blocks
    # once. Both go by exchange: Spark sizes the copies of the queries as one copy, so in a join it may broadcast them all.
    blocks, size = right.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("vectors").cast("long")), F.lit(0))).first()
    slots = max(1, min(blocks, max(2 * vectors.sparkSession.sparkContext.defaultParallelism, -(-size // SLOT))))
    dealt = right.select(F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot"), F.lit(None).cast("long").alias("block"), *right.columns)
    asked = left.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), "block", *right.columns)
    met = dealt.union(asked).repartitionById(slots, "slot").sortWithinPartitions("slot", F.col("block").asc_nulls_first())
    found = met.mapInArrow(_search(k, resolutions, 512), "block long, query_id long, place long, vec_id long, score long")
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    return (
        found.groupBy("query_id", "block", "place")
        .agg(best.alias("best"))
        .select("query_id", F.posexplode("best").alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))
    )
