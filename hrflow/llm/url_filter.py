"""URL rules decided by a cascade of Bloom filters, in DataFrame functions alone."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hrflow.llm.common import Scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^/?#]*([^?#]*)", 1)


@dataclass
class Level:
    """One Bloom filter: ``bits`` as signed 64-bit words, ``hashes`` positions a key, ``seed`` of the level."""

    bits: list[int]
    hashes: int
    seed: int

    def positions(self, *key: Column) -> list[Column]:
        size = F.lit(64 * len(self.bits)).cast("long")
        return [F.pmod(F.xxhash64(*key, F.lit(self.seed * 64 + i)), size) for i in range(self.hashes)]

    def holds(self, *key: Column) -> Column:
        # Text that is split and cast is folded into one literal array when the plan is optimised.
        words = F.split(F.lit(",".join(map(str, self.bits))), ",").cast("array<bigint>")
        found = [
            F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1
            for p in self.positions(*key)
        ]
        return reduce(Column.__and__, found)


@dataclass
class Cascade:
    """Exact membership for every key of the universe it was built over."""

    levels: list[Level]

    def contains(self, *key: Column) -> Column:
        answer = F.lit(False)
        for level in reversed(self.levels):
            answer = level.holds(*key) & ~answer
        return answer


def _level(keys: DataFrame, n: int, rate: float, seed: int, max_bits: int) -> Level:
    """A filter of ``n`` keys with about the given rate of false positives."""
    size = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
    if size > max_bits:
        raise ValueError(f"a filter of {n} keys takes {size} bits; max_bits is {max_bits}")
    words = math.ceil(size / 64)
    level = Level([0] * words, max(1, round(math.log2(1 / rate))), seed)
    at = keys.select(F.explode(F.array(*level.positions(*(F.col(c) for c in keys.columns)))).alias("p"))
    bit = F.expr("shiftleft(1L, cast(p % 64 as int))")
    filled = at.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(bit).alias("bits"))
    for row in filled.collect():  # at most max_bits / 64 rows
        level.bits[row.w] = row.bits
    return level


def bloom_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 26) -> Cascade:
    """The cascade that tells ``listed`` from all other keys of ``universe``; both hold distinct keys without nulls.

    Level 1 encodes the listed keys, level 2 the keys of the universe that pass level 1 without being listed, level
    3 the listed keys that pass level 2, and so on until nothing passes wrongly. Level 1 has a rate of false positives
    of about listed / universe, the others one half, so all levels together take O(listed * log2(universe / listed))
    bits, however large the corpus is. That is what the driver and each task hold; ``max_bits`` bounds a level.
    """
    key = listed.columns
    n, total = listed.count(), universe.count()
    if n == 0:
        return Cascade([])
    inside, outside = listed, universe.join(listed, key, "left_anti")
    levels: list[Level] = []
    rate = min(0.5, n / max(1, total) / math.sqrt(2))
    while n:
        level = _level(inside, n, rate, len(levels), max_bits)
        levels.append(level)
        passing = outside.filter(level.holds(*(F.col(c) for c in key)))
        inside, outside, rate = passing, inside, 0.5
        n = passing.count()
    return Cascade(levels)


def url_verdicts(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
    max_bits: int = 1 << 26,
) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages``.

    ``rules`` holds (verdict, host, path) with the verdicts ``allow`` and ``block``. A rule fits its host and all
    subdomains if the path starts with the rule's path; the longest rule wins, of equally long ones the longer host.
    Without a rule ``rule`` is null and ``verdict`` is ``default``: the key is on no list.

    Method: a page has one candidate key for each shape (length of host, length of path) that some rule has. The
    distinct candidates of the whole corpus are the key universe, over which one cascade of Bloom filters a
    verdict is built. A page's keys are then tested from long to short inside its own row, without a join.

    A null url, or one without ``://``, has empty host and path. Rows repeat as they come; an empty table
    gives an empty result and no rules give ``default`` everywhere. Other columns are not used.
    """
    spark: SparkSession = pages.sparkSession
    rules = sorted({(v, h.translate(str.maketrans(UPPER, UPPER.lower())), p) for v, h, p in rules})
    if {v for v, _, _ in rules} - {"allow", "block"}:
        raise ValueError("verdicts are allow and block")
    shapes = sorted({(len(h), len(p)) for _, h, p in rules}, key=lambda x: (-sum(x), -x[0]))
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if not rules:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    host, path = F.col("host"), F.col("path")

    def candidate(shape: tuple[int, int]) -> tuple[Column, Column, Column]:
        """Whether the row has a key of this shape, and the key."""
        h, p = shape
        size = F.char_length(host)
        bounded = (size == h) | (F.substring(host, -h - 1, 1) == ".")
        return (size >= h) & (F.char_length(path) >= p) & bounded, F.right(host, F.lit(h)), F.left(path, F.lit(p))

    keys = [F.when(ok, F.struct(a.alias("h"), b.alias("p"))) for ok, a, b in map(candidate, shapes)]
    scratch = Scratch(spark, "url-filter")
    universe = scratch.save(
        rows.select("host", "path").select(F.explode(F.array_compact(F.array(*keys))).alias("k")).select("k.*").distinct(), "universe"
    )
    cascades = {}
    for verdict in ("block", "allow"):
        own = [(h, p) for v, h, p in rules if v == verdict]
        cascades[verdict] = bloom_cascade(spark.createDataFrame(own, "h string, p string"), universe, max_bits)
    tests = []
    for shape in shapes:
        ok, a, b = candidate(shape)
        for verdict, cascade in cascades.items():
            hit = F.struct(F.concat(a, b).alias("rule"), F.lit(verdict).alias("verdict"))
            tests.append(F.when(ok & cascade.contains(a, b), hit))
    return rows.withColumn("hit", F.coalesce(*tests)).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict")
    )
