"""Exact deduplication by deterministic block naming, in DataFrame functions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hrflow.llm.common import SPACES, Scratch, beside_row_key, fresh, with_row_key


def normalised(text: Column) -> Column:
    """The text without any white space of ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(text, SPACES, "")


def _named(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` with the integer ``name`` of their key: equal keys, and only those, have equal names.

    The distinct keys are sorted within hash partitions and numbered there. Rows meet the names in a join on a
    struct, which brings an exchange of its own on both sides: adaptive execution can then split a key that a
    third of all rows hold.
    """
    names = rows.select(*key).distinct().sortWithinPartitions(*key).withColumn("name", F.monotonically_increasing_id())
    names = names.select(F.struct(*key).alias("key"), "name")
    return rows.withColumn("key", F.struct(*key)).join(names, "key").drop("key", *key)


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = 1024, head: int = 64
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the row keys k1, k2.

    Method: a normalised text is cut into blocks of ``block`` characters. The distinct blocks are sorted into
    integer names, adjacent names are paired, the distinct pairs are named again, and so on until a text has one
    name. Together with its length that name is its identity: no hash decides which texts are equal. Texts
    whose length and first ``head`` characters occur once are settled by that class and take no further part;
    only open classes send their text through a shuffle of blocks.

    Of equal texts the one with the most code points stays, then the smallest id (null ids last); of rows
    that repeat both id and text one is ``kept``. Null texts count as empty, and empty texts are equal to each other.
    An empty table gives an empty result. Other input columns are not used.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = (
        with_row_key(docs, doc_id, text)
        .withColumns({"points": F.char_length("text"), "text": normalised(F.col("text"))})
        .withColumns({"n": F.char_length("text"), "head": F.substring("text", 1, head)})
    )
    narrow = scratch.save(
        rows.select("doc_id", "k1", "k2", "points", "n", "head", F.sha2("text", 256).alias("text_sha256")), "rows"
    )
    classes = narrow.groupBy("n", "head").count().filter("count > 1").select(F.struct("n", "head").alias("class"))
    opened = rows.withColumn("class", F.struct("n", "head")).join(classes, "class", "left_semi")
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    cut = opened.select("k1", "k2", "n", F.posexplode_outer(pieces).alias("pos", "block")).fillna({"pos": 0, "block": ""})
    level = scratch.save(_named(scratch.save(cut, "blocks"), "block"), "names-0")
    longest = level.agg(F.max("n")).first()[0] or 0
    done, reach = [level.filter(F.col("n") <= block)], block
    while reach < longest:
        side = F.col("pos") % 2
        pairs = (
            level.filter(F.col("n") > reach)
            .groupBy("k1", "k2", "n", F.expr("pos div 2").alias("pos"))
            .agg(
                F.max(F.when(side == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        level = scratch.save(_named(pairs, "left", "right"), f"names-{len(done)}")
        done.append(level.filter(F.col("n") <= 2 * reach))
        reach *= 2
    whole = reduce(DataFrame.union, [x.select("k1", "k2", "n", "name") for x in done]).distinct()
    return _kept(narrow.drop("head"), whole)


def _kept(narrow: DataFrame, whole: DataFrame) -> DataFrame:
    """Joins each row with the best row of its identity; rows without a name are alone in their class."""
    joined = narrow.join(whole.select("k1", "k2", "name"), ["k1", "k2"], "left")
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("gap"), "doc_id"))
    groups = (
        joined.filter("name is not null")
        .groupBy("n", "name")
        .agg(best.alias("best"), F.count("*").alias("group_size"))
        .select(F.struct("n", "name").alias("key"), "best", "group_size")
    )
    named = (
        joined.filter("name is not null")
        .withColumns(
            {"key": F.struct("n", "name"), "repeat": F.row_number().over(Window.partitionBy("k1", "k2").orderBy("points"))}
        )
        .join(groups, "key")
    )
    first = (
        (F.col("repeat") == 1)
        & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
        & (F.col("points") == -F.col("best.points"))
    )
    # Rows of one id may differ in white space only and have as many code points: the smaller key stays.
    twin = F.row_number().over(Window.partitionBy("doc_id", "n", "name").orderBy(F.col("points").desc(), "k2", "repeat"))
    named = named.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (first & (twin == 1)).alias("kept"),
        "text_sha256",
        "k1",
        "k2",
    )
    alone = joined.filter("name is null").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        "k1",
        "k2",
    )
    return named.union(alone)


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text one stays."""
    kept = exact_duplicates(docs, doc_id, text).filter("kept").select("k1", "k2").distinct()
    rows, kept, key = beside_row_key(docs, kept, doc_id, text)
    (number,) = fresh(rows, "number")
    repeat = F.row_number().over(Window.partitionBy(*key).orderBy(key[1]))
    return rows.join(kept, key, "left_semi").withColumn(number, repeat).filter(F.col(number) == 1).select(*docs.columns)
