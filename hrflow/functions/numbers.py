"""Ratios, rounding and banding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_away(x: Column, scale: int) -> Column:
    """Round a double half away from zero on its binary value.

    ``F.round`` goes through the decimal text of the double, which rounds 1.005 up although the
    stored value lies below it; analytical databases scale the binary value instead.
    """
    d = x.cast("double")
    factor = float(10**scale)
    return F.signum(d) * F.floor(F.abs(d) * factor + 0.5).cast("double") / factor


def safe_ratio(numerator: Column, denominator: Column, scale: int | None = None) -> Column:
    """``numerator / denominator`` as a double, null where the denominator is zero or null."""
    d = denominator.cast("double")
    ratio = numerator.cast("double") / F.nullif(d, F.lit(0.0))
    return ratio if scale is None else round_away(ratio, scale)


def band(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge that ``x`` lies below; the last label takes the rest (nulls included)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs one label more than edges")
    out = F.when(x < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(x < edge, label)
    return out.otherwise(labels[-1])


def rank_in(x: Column, values: Sequence[str]) -> Column:
    """1-based position of ``x`` in ``values``, null when absent. For sorting by a fixed order."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), x)
    return F.nullif(pos, F.lit(0))
