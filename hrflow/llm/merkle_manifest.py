"""A Merkle manifest of a dataset by time-forward processing: digests go up, proofs come back down."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from hrflow.llm.common import Scratch

#: Levels of the tree that one task's block covers: 16 ** 3 nodes enter, one leaves.
LEVELS = 3


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 (hex) of the values: ``-`` for null, else length in UTF-8 bytes, colon, value as text."""
    texts = [c.cast("string") for c in columns]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof (array of left and right siblings, lowest level first) lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def depth(n: int, fanout: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


def sweep_up(nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    """Digests of all levels over ``nodes`` by time-forward processing.

    Nodes are visited by label (level, place). Each sends its digest to its parent as a message in a priority queue; when a
    label is due, its messages lie at the front of the queue in the order of the children.
    """
    queue = [((1, i // fanout), i, d) for i, d in enumerate(nodes)] if levels else []
    out = [nodes, *([] for _ in range(levels))]
    while queue:
        label, children = queue[0][0], []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        level, place = label
        out[level].append(digest_of(*children))
        if level < levels:
            heapq.heappush(queue, ((level + 1, place // fanout), place, out[level][-1]))
    return out


def sweep_down(tree: list[list[str]], above: list[tuple[str, str]], fanout: int) -> list[list[tuple[str, str]]]:
    """The proof of every node at the bottom: the sweep in reverse order hands each node's proof on to its children."""
    queue = [((1 - len(tree), 0), above)]
    out: list[list[tuple[str, str]]] = [[]] * len(tree[0])
    while queue:
        (level, place), proof = heapq.heappop(queue)
        if level == 0:
            out[place] = proof
            continue
        run = tree[-level - 1][place * fanout : (place + 1) * fanout]
        for i in range(len(run)):
            step = ("".join(run[:i]), "".join(run[i + 1 :]))
            heapq.heappush(queue, ((level + 1, place * fanout + i), [step, *proof]))
    return out


def _blocks(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[list[dict]]:
    """Runs of rows with equal ``key``; the input is sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[k] != held[0][k] for k in key):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _up(fanout: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, ("grp", "block")):
            top = sweep_up([r["node"] for r in rows], min(LEVELS, depth(rows[0]["n"], fanout)), fanout)[-1]
            yield pa.RecordBatch.from_pydict({"grp": [rows[0]["grp"]], "idx": [rows[0]["block"]], "n": [-(-rows[0]["n"] // fanout**LEVELS)], "node": top})

    return run


STEP = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _down(fanout: int, kept: pa.Schema) -> Callable:
    """The first row of a block brings the proof of the block's top node, the others are the block's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *rows in _blocks(batches, ("grp", "block")):
            tree = sweep_up([r["node"] for r in rows], min(LEVELS, depth(rows[0]["n"], fanout)), fanout)
            above = [(s["left"], s["right"]) for s in head["proof"]]
            proofs = sweep_down(tree, above, fanout)
            for at in range(0, len(rows), 256):  # proofs of a level are long, so a few rows at a time
                part = rows[at : at + 256]
                columns = {name: pa.array([r[name] for r in part], kept.field(name).type) for name in kept.names}
                columns["subroot"] = pa.array([head["subroot"]] * len(part), pa.string())
                columns["root"] = pa.array([head["root"]] * len(part), pa.string())
                columns["proof"] = pa.array([[{"left": a, "right": b} for a, b in p] for p in proofs[at : at + 256]], STEP)
                yield pa.RecordBatch.from_pydict(columns)

    return run


def numbered(df: DataFrame, scratch: Scratch, name: str, order: list[Column]) -> DataFrame:
    """``df`` (with a column grp) and ``idx``, the place in its group from 0, and ``n``, the group's size.

    Rows are sorted by ranges of (grp, order), so a group of any size is spread over many tasks; what is summed over tasks is one
    count for each task and group. Rows that agree in the order are told apart by their place in the stored input.
    """
    stored = scratch.save(df, f"{name}-rows").withColumn("_tie", F.monotonically_increasing_id())
    stored = stored.withColumn("_order", F.struct("grp", *order, "_tie"))
    ranged = stored.repartitionByRange("_order").sortWithinPartitions("_order").drop("_order", "_tie")
    placed = scratch.save(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), f"{name}-placed")
    parts = placed.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.struct("grp", "_part").alias("_k"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("n"),
    )
    return (
        placed.withColumn("_k", F.struct("grp", "_part"))
        .join(parts, "_k")
        .withColumn("idx", F.col("_at") + F.col("_shift"))
        .drop("_k", "_at", "_part", "_shift")
    )


def _rise(nodes: DataFrame, scratch: Scratch, name: str, fanout: int) -> list[DataFrame]:
    """Tables of nodes (grp, idx, n, node): the given one, then block tops, until each group has one node."""
    size = fanout**LEVELS
    tables = [nodes]
    while (tables[-1].agg(F.max("n")).first()[0] or 0) > 1:
        blocks = tables[-1].select("grp", "idx", "n", "node", F.floor(F.col("idx") / size).cast("long").alias("block"))
        dealt = blocks.repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")
        tables.append(scratch.save(dealt.mapInArrow(_up(fanout), "grp string, idx long, n long, node string"), f"{name}-{len(tables)}"))
    return tables


def _fall(tables: list[DataFrame], tops: DataFrame, scratch: Scratch, name: str, fanout: int) -> DataFrame:
    """Rows of the lowest table with subroot, root and proof; ``tops`` (grp, subroot, root, proof) has one row a group."""
    size = fanout**LEVELS
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for step in range(len(tables) - 2, -1, -1):
        nodes = tables[step].withColumn("block", F.floor(F.col("idx") / size).cast("long"))
        rows = nodes.unionByName(above.withColumn("idx", F.lit(-1).cast("long")), allowMissingColumns=True)
        dealt = rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")
        kept = tables[step]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
        out = dealt.mapInArrow(_down(fanout, to_arrow_schema(kept.schema)), f"{schema}, subroot string, root string, proof array<struct<left:string,right:string>>")
        if step == 0:
            return out
        above = scratch.save(out.select("grp", F.col("idx").alias("block"), "subroot", "root", "proof"), f"{name}-down-{step}")
    return tables[0].join(above.drop("block"), "grp")


def merkle_manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    order: str = "doc_id",
    carry: dict[str, Column] | None = None,
    fanout: int = 16,
) -> DataFrame:
    """``order``, leaf, subroot, root, proof and the columns of ``carry`` for every row: a hash tree of the table.

    A leaf is the digest of the row's ``columns`` (:func:`leaf_digest`). In each group leaves ascend by ``order``, nulls first; while
    several nodes remain, every ``fanout`` consecutive ones become the digest of their joint hex text. What remains is
    the group's subroot; subroots in the order of the group's UTF-8 bytes, null first, make the root in the same
    way. ``proof`` lists left and right siblings (joined texts, either may be empty) from the lowest level to the root,
    so :func:`folded` of leaf and proof is the root. ``carry`` names further values to compute from each row and keep beside it.

    Method: time-forward processing. Nodes are labelled by level and place and visited in that order; a priority queue ordered by
    label delivers child digests to parents (``sweep_up``), and a sweep in the reverse order delivers proofs to the leaves
    (``sweep_down``). The queue is external: inside a block of ``fanout`` ** 3 nodes it is a heap, and what leaves the block is a
    row that Spark's sorted exchange delivers to the parent's block. So a group of any size is many blocks, a task holds
    one block at a time, and rounds grow with the logarithm of the largest group. Every table between rounds is stored.

    Rows that agree in ``order`` are in the order of their leaves; equal rows are interchangeable. Null values are told apart from
    empty ones. An empty table gives an empty result. Columns that are not named are not read.
    """
    carry = carry or {}
    scratch = Scratch(docs.sparkSession, "merkle")
    prefixed = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # null first, then by bytes
    extra = [c.alias(f"carry_{i}") for i, c in enumerate(carry.values())]
    leaves = docs.select(prefixed.alias("grp"), F.col(order).alias("label"), leaf_digest(*(F.col(c) for c in columns)).alias("node"), *extra)
    placed = scratch.save(numbered(leaves, scratch, "leaves", [F.col("label"), F.col("node")]), "leaves")
    trees = _rise(placed, scratch, "groups", fanout)
    subroots = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("member"), "node")
    subroots = scratch.save(numbered(subroots, scratch, "subroots", [F.col("member")]), "subroots")
    crown = _rise(subroots, scratch, "crown", fanout)
    empty = F.array().cast("array<struct<left:string,right:string>>")
    top = crown[-1].select("grp", F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"), empty.alias("proof"))
    tops = _fall(crown, top, scratch, "crown", fanout).select(F.col("member").alias("grp"), F.col("node").alias("subroot"), "root", "proof")
    tops = scratch.save(tops, "tops")
    out = _fall(trees, tops, scratch, "groups", fanout)
    named = [F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)]
    return out.select(F.col("label").alias(order), F.col("node").alias("leaf"), "subroot", "root", "proof", *named)
