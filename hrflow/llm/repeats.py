"""Repeated passages: enhanced suffix arrays over content-chosen anchors, one common-prefix interval tree a class."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.llm.common import BASE, BASE_INVERSE, Scratch, beside_row_key, fresh, mixed, powers, text_chunks, with_row_key

#: Windows that are examined at once; their positions fit into the low bits of a packed minimum.
CHUNK = 1 << 20
LOW = (1 << 21) - 1


class Anchors:
    """Chooses anchors: the gram with the smallest hash, the last of equal ones, of every string of ``length`` bytes.

    The choice depends on the string's bytes alone, so equal strings have equal anchors at equal offsets.
    """

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.window = length, gram, length - gram + 1
        self.up, self.down = powers(BASE, 0), powers(BASE_INVERSE, 0)
        self.table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.up) < n:
            self.up, self.down = powers(BASE, n), powers(BASE_INVERSE, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:n], out=sums[1:])
        return mixed((sums[self.gram :] - sums[: -self.gram]) * self.down[: n - self.gram + 1])

    def _minima(self, x: np.ndarray) -> np.ndarray:
        """Minimum of each ``window`` neighbours: of the end of one block and the beginning of the next."""
        w = self.window
        full = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
        full[: len(x)] = x
        blocks = full.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(x) - w + 1
        return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors of a text."""
        places, values = [], []
        for at in range(0, max(0, len(data) - self.length + 1), CHUNK):
            grams = self._hashes(data[at : at + CHUNK + self.length - 1])
            packed = (grams & np.uint64(~LOW & (1 << 64) - 1)) | (np.uint64(LOW) - np.arange(len(grams), dtype=np.uint64))
            chosen = (np.uint64(LOW) - (self._minima(packed) & np.uint64(LOW))).astype(np.int64)
            chosen = chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))]
            places.append(chosen + at)
            values.append(grams[chosen])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        place, first = np.unique(np.concatenate(places), return_index=True)
        return place, np.concatenate(values)[first]


def _bytes(scalar: pa.Scalar) -> bytes:
    return scalar.as_buffer().to_pybytes()


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        for batch in text_chunks(batches):
            found = [anchors.of(np.frombuffer(t.as_buffer(), np.uint8)) for t in batch.column("text")]
            row = pa.array(np.repeat(np.arange(len(found)), [len(p) for p, _ in found]))
            place = np.concatenate([p for p, _ in found] or [np.zeros(0, np.int64)])
            value = np.concatenate([v for _, v in found] or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(row), batch.column("k2").take(row), pa.array(place), pa.array(value.view(np.int64))], ["k1", "k2", "pos", "h"]
            )

    return run


def _contexts(length: int, gram: int):
    """A digest of what surrounds each anchor: all strings of ``length`` bytes that hold it lie inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            rows = []
            for k1, k2, text, marks in zip(
                batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text"), batch.column("marks").to_pylist(), strict=True
            ):
                text = _bytes(text)
                for m in marks:
                    left, right = max(0, m["pos"] - length + gram), min(len(text), m["pos"] + length)
                    if right - left >= length:
                        digest = np.frombuffer(xxhash.xxh3_128_digest(text[left:right]), np.int64)
                        rows.append((k1, k2, m["pos"], m["h"], m["pos"] - left, right - m["pos"], int(digest[0]), int(digest[1])))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "pos", "h", "before", "after", "c1", "c2"])

    return run


def _snippets(length: int, gram: int):
    """The bytes before each anchor, backwards, and those from it on."""
    kinds = [pa.int64()] * 6 + [pa.binary()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            rows = []
            for k1, k2, text, marks in zip(
                batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text"), batch.column("marks").to_pylist(), strict=True
            ):
                text = _bytes(text)
                for m in marks:
                    p = m["pos"]
                    rows.append((m["h"], m["n"], m["m"], k1, k2, p, text[max(0, p - length + gram) : p][::-1], text[p : p + length]))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["h", "n", "m", "k1", "k2", "pos", "left", "right"])

    return run


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def class_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(member, bytes before the anchor, bytes from it on) of the repeats of at least ``length`` bytes in a class.

    ``rights`` is sorted: with the common prefixes of neighbours it is an enhanced suffix array of the class. A stack
    scan visits the intervals of common prefixes from long to short. An interval joins the member sets of its
    children; a repeat is maximal there if members of different children extend to the left alike for just so far.
    Sets are kept in the order of their left contexts and the smaller one is merged into the larger, so a member
    meets the best partner of the whole interval, not only its neighbours in the suffix array. What is
    not reported lies inside a reported repeat of the same member.
    """
    rank = {i: r for r, i in enumerate(sorted(range(len(lefts)), key=lefts.__getitem__))}
    by_rank = {r: i for i, r in rank.items()}
    out: list[tuple[int, int, int]] = []

    def merged(a: list[int], b: list[int], shared: int) -> list[int]:
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        for x in small:
            at = bisect_left(large, x)
            for y in large[max(0, at - 1) : at + 1]:
                before = common_prefix(lefts[by_rank[x]], lefts[by_rank[y]])
                if before + shared >= length:
                    out.extend(((by_rank[x], before, shared), (by_rank[y], before, shared)))
        return sorted(small + large)

    stack: list[tuple[int, list[int]]] = []
    for i in range(len(rights)):
        ahead = common_prefix(rights[i], rights[i + 1]) if i + 1 < len(rights) else -1
        group = [rank[i]]
        while stack and stack[-1][0] >= ahead:
            shared, other = stack.pop()
            group = merged(other, group, shared)
        stack.append((ahead, group))
    return out


INTERVALS = "k1 long, k2 long, start long, end long"


def _intervals(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "start", "end"])


def _trees(length: int):
    """Intervals of each run of equal h; rows are sorted by h and right context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush() -> list[tuple[int, int, int, int]]:
            found = class_repeats([r["left"] for r in held], [r["right"] for r in held], length) if len(held) > 1 else []
            best: dict[tuple[int, int], int] = {}
            for i, before, after in found:
                best[i, before] = max(after, best.get((i, before), 0))
            return [(r["k1"], r["k2"], r["pos"] - b, r["pos"] + a) for (i, b), a in best.items() if (r := held[i])["n"] == 1]

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and row["h"] != held[0]["h"]:
                    out += flush()
                    held = []
                held.append(row)
            yield _intervals(out)
        yield _intervals(flush())

    return run


def _windows(length: int):
    """Every string of ``length`` bytes around an anchor, as a digest; for classes too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text, at = row["left"][::-1] + row["right"], row["pos"] - len(row["left"])
                n = len(text) - length + 1
                starts = np.arange(max(0, n)) + at
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(text[i : i + length]) for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(starts), row["k1"])), pa.array(np.full(len(starts), row["k2"])), pa.array(starts), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())],
                    ["k1", "k2", "start", "w1", "w2"],
                )

    return run


def repeated_intervals(docs: DataFrame, scratch: Scratch, length: int = 400, gram: int = 64, large: int = 8192) -> tuple[DataFrame, DataFrame]:
    """``docs`` (k1, k2, text as binary) that share an anchor, and the byte intervals that repeats cover.

    The union of a row's intervals is exactly what strings of ``length`` bytes cover that start at two places or more.
    """
    gram = max(1, min(gram, length // 2))
    anchors = scratch.save(docs.mapInArrow(_anchor_rows(length, gram), "k1 long, k2 long, pos long, h long"), "anchors")
    again = anchors.groupBy("h").count().filter("count > 1").select(F.struct("h").alias("key"))
    shared = anchors.withColumn("key", F.struct("h")).join(again, "key", "left_semi")
    marks = shared.groupBy("k1", "k2").agg(F.collect_set(F.struct("pos", "h")).alias("marks"))
    suspects = scratch.save(docs.join(marks, ["k1", "k2"]), "suspects")
    contexts = scratch.save(
        suspects.mapInArrow(_contexts(length, gram), "k1 long, k2 long, pos long, h long, before long, after long, c1 long, c2 long"), "contexts"
    )
    context = ("h", "before", "after", "c1", "c2")
    groups = contexts.groupBy(*context).agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "pos")).alias("first"))
    groups = scratch.save(groups, "groups")
    # Equal surroundings: all of them repeats, for every member of the group.
    twice = groups.filter("n > 1").select(F.struct(*context).alias("key"))
    same = contexts.withColumn("key", F.struct(*context)).join(twice, "key", "left_semi")
    same = same.selectExpr("k1", "k2", "pos - before as start", "pos + after as end")
    # Anchors with different surroundings: one member of each group goes into the class of the anchor.
    classes = groups.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1").select(F.struct("h").alias("key"), "m")
    members = groups.withColumn("key", F.struct("h")).join(classes, "key")
    asked = members.groupBy("first.k1", "first.k2").agg(F.collect_list(F.struct("first.pos", "h", "n", "m")).alias("marks"))
    snippets = (
        suspects.drop("marks").join(asked, ["k1", "k2"]).mapInArrow(_snippets(length, gram), "h long, n long, m long, k1 long, k2 long, pos long, left binary, right binary")
    )
    snippets = scratch.save(snippets, "snippets")
    dealt = snippets.filter(F.col("m") <= large).repartition("h").sortWithinPartitions("h", "right")
    parts = dealt.mapInArrow(_trees(length), INTERVALS)
    windows = snippets.filter(F.col("m") > large).mapInArrow(_windows(length), "k1 long, k2 long, start long, w1 long, w2 long")
    frequent = windows.distinct().groupBy("w1", "w2").count().filter("count > 1").select(F.struct("w1", "w2").alias("key"))
    hot = windows.withColumn("key", F.struct("w1", "w2")).join(frequent, "key", "left_semi")
    hot = hot.select("k1", "k2", "start", (F.col("start") + length).alias("end"))
    return suspects.drop("marks"), scratch.save(same.union(parts).union(hot), "intervals")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        rows = []
        for text, marks in zip(batch.column("text"), batch.column("marks").to_pylist(), strict=True):
            text = _bytes(text)
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, [m["start"] for m in marks], 1)
            np.add.at(edge, [m["end"] for m in marks], -1)
            gone = np.cumsum(edge[:-1]) > 0
            spans = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(gone[:1].sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((int(gone.sum()), int(spans), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
            ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept_text"],
        )


def _removed(docs: DataFrame, length: int, gram: int, large: int) -> DataFrame:
    """One row per key that loses bytes: k1, k2, n_removed, n_spans, kept_sha256, kept_text."""
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = docs.select("k1", "k2", F.col("text").cast("binary").alias("text"))
    suspects, intervals = repeated_intervals(texts, scratch, length, gram, large)
    marks = intervals.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("marks"))
    schema = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    return suspects.join(marks, ["k1", "k2"]).mapInArrow(_cut, schema).dropDuplicates(["k1", "k2"])


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, gram: int = 64, large: int = 8192
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept_text of every row: bytes of repeats of ``length`` bytes or more go.

    A byte goes if a string of ``length`` bytes that also starts at another place, in the same text or another,
    covers it. Texts are UTF-8 bytes, a null text is empty; matches do not cross texts, overlaps count, and the
    judgement is on the input. ``kept_text`` is what is left; a character that is cut in part goes in whole there.

    Method: every string of ``length`` bytes names an anchor in it (the gram of ``gram`` bytes with the smallest hash), so two
    places of one string share an anchor. Anchors that occur once are dropped. Those with equal surroundings are settled together;
    one of each surroundings joins the class of its anchor, whose sorted right contexts form an enhanced suffix array.
    A stack scan of its common-prefix intervals finds the maximal repeats of all members (``class_repeats``). A class
    with more than ``large`` different surroundings is decided by counting its strings one by one in a distributed aggregate.

    Rows that repeat id and text are separate texts and so repeats of each other. Ids may be null. An empty table
    gives an empty result.
    """
    rows = with_row_key(docs, doc_id, text)
    changed = _removed(rows, length, gram, large)
    return rows.withColumns({"n_bytes": F.octet_length("text").cast("long"), "whole": F.sha2("text", 256)}).join(
        changed, ["k1", "k2"], "left"
    ).select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        F.coalesce("kept_text", "text").alias("kept_text"),
    )


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, gram: int = 64, large: int = 8192
) -> DataFrame:
    """``docs`` with the repeats cut out of ``text``; all rows and columns stay. A character that is cut in part goes in whole."""
    (new,) = fresh(docs, "kept_text")
    changed = _removed(with_row_key(docs, doc_id, text), length, gram, large).select("k1", "k2", F.col("kept_text").alias(new))
    rows, changed, key = beside_row_key(docs, changed, doc_id, text)
    return rows.join(changed, key, "left").withColumn(text, F.coalesce(new, text)).select(*docs.columns)
