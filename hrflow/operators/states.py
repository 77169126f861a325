"""Mergeable states: distinct counts and quantiles of any period from what is stored per day and slice.

A state is a table that is written once a day. States of several days are merged by sums and unions, and the result is that of
the rows themselves, so a month, a quarter and a year are read from states and never from facts again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrflow.operators.windows import number_in_group

#: Keys are numbered in this many parts.
PARTS = 4096
#: Intervals are laid out in pieces of up to 2 ** PIECE_LEVELS days.
PIECE_LEVELS = 5


def dense_ids(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, id): numbers from 1 without gaps for the distinct keys; null keys have none.

    Keys in ``known`` keep their number and new ones follow, so states of earlier days stay valid. No more than 2,147,483,647 keys
    can be numbered; one more is an error.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
    part = F.pmod(F.xxhash64(key), F.lit(PARTS))
    numbered = number_in_group(fresh, [], [F.col(key)], [part], "id")
    if known is None:
        return numbered.select(key, "id")
    last = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    after = numbered.join(F.broadcast(last)).select(key, (F.col("id") + F.col("last")).cast("int").alias("id"))
    return known.select(key, "id").unionByName(after)


def distinct_state(rows: DataFrame, by: Sequence[str], id_col: str = "id") -> DataFrame:
    """(by, block, bits): the ids of each group as bitmaps of 32,768 bits, a row for each block in use.

    Tasks combine their rows first, so at most one bitmap of 4 KB a group, block and task is shuffled, however hot a group is.
    """
    return (
        rows.where(F.col(id_col).isNotNull())
        .select(*by, F.bitmap_bucket_number(id_col).alias("block"), F.bitmap_bit_position(id_col).alias("_bit"))
        .groupBy(*by, "block")
        .agg(F.bitmap_construct_agg("_bit").alias("bits"))
    )


def distinct_state_by_day(intervals: DataFrame, by: Sequence[str], day: str, id_col: str = "id") -> DataFrame:
    """The state that :func:`distinct_state` gives by (``day``, ``by``) for the days of closed intervals, without a row per id and day.

    An interval is laid out in aligned pieces of 1, 2, 4 up to 32 days, a few for each size. Pieces become bitmaps, and a day's
    bitmap is the union of those of the pieces that hold it. Rows are dealt once, by slice and block, and stay there.
    """
    placed = (
        intervals.where(F.col(id_col).isNotNull() & (F.col("from_date") <= F.col("to_date")))
        .select(
            *by,
            F.bitmap_bucket_number(id_col).alias("block"),
            F.bitmap_bit_position(id_col).alias("_bit"),
            F.unix_date("from_date").alias("_first"),
            (F.unix_date("to_date") + 1).alias("_after"),
        )
        .repartition(*by, "block")
    )
    pieces = []
    for level in range(PIECE_LEVELS + 1):
        # Whole pieces of this size inside the interval: from ``low`` on, below ``high``. Pairs are left to the next size.
        low, high = F.shiftright(F.col("_first") + (2**level - 1), level), F.shiftright("_after", level)
        inside = low < high
        if level == PIECE_LEVELS:
            at = F.when(inside, F.sequence(low, high - 1))
        else:
            left, right = F.when(low.bitwiseAND(1) == 1, low), F.when(high.bitwiseAND(1) == 1, high - 1)
            at = F.when(inside, F.array_compact(F.array(left, right)))
        size = F.lit(level).alias("_level")
        pieces.append(F.transform(F.coalesce(at, F.array().cast("array<int>")), lambda x: F.struct(size, x.alias("_at"))))  # noqa: B023
    laid = placed.select(*by, "block", "_bit", F.inline(F.concat(*pieces)))
    bitmaps = laid.groupBy("_level", "_at", *by, "block").agg(F.bitmap_construct_agg("_bit").alias("bits"))
    days = F.expr("sequence(shiftleft(_at, _level), shiftleft(_at + 1, _level) - 1)")
    daily = bitmaps.select(F.explode(days).alias("_day"), *by, "block", "bits")
    return merge_distinct(daily.withColumn(day, F.date_from_unix_date("_day")).drop("_day"), [day, *by])


def merge_distinct(state: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The state of coarser groups: ``by`` are columns of the state or expressions over them."""
    return state.groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(state: DataFrame, by: Sequence[str], out: str = "n") -> DataFrame:
    """Exact number of distinct ids per group of a state."""
    return state.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(out))


def _growth(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError("the error must lie between 0 and 1")
    return (1 + error) / (1 - error)


def value_state(rows: DataFrame, by: Sequence[str], value: str, error: float | None = None) -> DataFrame:
    """(by, value, n): how often each value occurs in a group.

    Without ``error`` values are kept as they are, for integers of a bounded range. With it, a value stands for all that lie
    within that share of it: positive and negative numbers go into intervals that grow by a constant factor, zero is its own. The
    size of such a state depends on the range and the error, not on the rows. Null, NaN and infinite values take no part.
    """
    x = F.col(value)
    if error is None:
        kept = rows.where(x.isNotNull()).select(*by, x.alias("value"))
    else:
        growth = _growth(error)
        number = x.cast("double")
        level = F.ceil(F.ln(F.abs(number)) / F.lit(math.log(growth)))
        # The point whose distance from both ends of (growth ** (level - 1), growth ** level] is the same share of them.
        point = F.pow(F.lit(growth), level) * F.lit(2 / (growth + 1))
        finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
        shown = F.when(number == 0, F.lit(0.0)).otherwise(F.signum(number) * point)
        kept = rows.where(finite).select(*by, shown.alias("value"))
    return kept.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))


def merge_values(state: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The state of coarser groups: ``by`` are columns of the state or expressions over them."""
    return state.groupBy(*by, "value").agg(F.sum("n").alias("n"))


def state_quantiles(state: DataFrame, by: Sequence[str], points: dict[str, float]) -> DataFrame:
    """Number of values and, named by the keys of ``points``, percentiles with linear interpolation per group.

    Of a state without error they equal ``percentile`` over the rows. With an error, each of the two neighbouring values that are
    interpolated is within that share of the true one, and so is the result wherever the two have one sign.
    """
    return state.groupBy(*by).agg(
        F.sum("n").alias("n"),
        *[F.percentile("value", F.lit(q), F.col("n")).alias(name) for name, q in points.items()],
    )
