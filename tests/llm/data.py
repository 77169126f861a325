"""Small tables for the operator tests: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns that the operators use inside themselves.
CLASHING = ("k1", "k2", "name", "key", "pos", "h", "n", "count", "_id", "row_k1", "score", "length", "rank")


def docs(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """A table of documents with extra columns whose names clash with inner ones."""
    extra = ", ".join(f"{c} string" for c in CLASHING)
    data = [(i, t, "en", *("x",) * len(CLASHING)) for i, t in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, {extra}")


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 7))) for _ in range(n))


def odd_rows() -> list[tuple[int | None, str | None]]:
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "a"),
        (5, "A  a"),
        (6, words(1, 80)),
        (7, words(1, 80).replace(" ", "\n")),
        (8, words(2, 20_000)),
        (9, "é😀ß " * 50),
        (9, "é😀ß " * 50),
        (10, words(3, 40)),
        (10, words(4, 40)),
        (None, words(3, 40)),
        (None, words(5, 5)),
        (11, "x" * 1024),
        (12, "x" * 1025),
        (13, "x" * 3000),
        (14, "y" + "x" * 2999),
    ]
