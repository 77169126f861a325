from __future__ import annotations

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from tests.llm.data import docs

from hrflow.llm.merkle_manifest import depth, folded, merkle_manifest, sweep_down, sweep_up
from hrflow.llm.queries import CHECKS, QUERIES


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def framed(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row) -> str:
    return h(*(framed(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def tree(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top and each node's siblings, by the definition."""
    proofs: list[list[tuple[str, str]]] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [list(range(a, min(a + fanout, len(nodes)))) for a in range(0, len(nodes), fanout)]
        for run in runs:
            for i in run:
                for x in under[i]:
                    proofs[x].append(("".join(nodes[j] for j in run if j < i), "".join(nodes[j] for j in run if j > i)))
        under = [[x for i in run for x in under[i]] for run in runs]
        nodes = [h(*(nodes[i] for i in run)) for run in runs]
    return nodes[0], proofs


def expected(rows: list[dict], fanout: int) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, out = [], []
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        tops.append(tree([x[2] for x in groups[g]], fanout))
    root, crown = tree([t for t, _ in tops], fanout)
    for g, (subroot, proofs), above in zip(order, tops, crown, strict=True):
        for (_, _, d, r), proof in zip(groups[g], proofs, strict=True):
            out.append((r["doc_id"], d, subroot, root, [*proof, *above]))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, grp string, idx string, node string")


def rows_of(sizes: dict, **more) -> list[dict]:
    out, i = [], 0
    for g, n in sizes.items():
        for _ in range(n):
            out.append({"doc_id": (i * 7919) % 10007, "source": g, "lang": None if i % 3 else "en", "n_chars": i, "text": f"É Text {i}", "grp": "x", "idx": "y", "node": "z"})
            i += 1
    return out


@pytest.mark.parametrize("fanout", [2, 16])
def test_trees_equal_the_definition(spark, fanout):
    rows = rows_of({"a": 1, None: 3, "": 17, "é": 16, "b": 33, "Z": 300, "10": 2, "hot": 700, **{f"s{i}": 1 for i in range(20)}})
    rows += [dict(rows[30])] * 2 + [{**rows[40], "doc_id": None}, {**rows[41], "doc_id": None, "text": None}, {**rows[41], "doc_id": None, "text": ""}]
    got = merkle_manifest(table(spark, rows), fanout=fanout).collect()
    assert sorted([(r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.proof]) for r in got], key=str) == expected(rows, fanout)


def test_sweeps():
    for n in (1, 2, 15, 16, 17, 256, 257, 1000):
        nodes = [h(str(i)) for i in range(n)]
        up = sweep_up(nodes, depth(n, 16), 16)
        top, proofs = tree(nodes, 16)
        assert up[-1] == [top]
        assert sweep_down(up, [("l", "r")], 16) == [[*p, ("l", "r")] for p in proofs]
    assert [depth(n, 16) for n in (1, 2, 16, 17, 256, 257)] == [0, 1, 1, 2, 2, 3]


def test_query(spark, tmp_path):
    rows = rows_of({"a": 40, None: 1, "b": 5})
    rows[3]["text"] = None
    rows[4]["text"] = "no capitals"
    rows[5]["doc_id"] = None
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()
    want = {str(x[0]): x for x in expected(rows, 16)}
    by_id = {str(r["doc_id"]): r for r in rows}
    assert len(got) == len(rows)
    for r in got:
        _, d, subroot, root, proof = want[str(r.doc_id)]
        row = dict(by_id[str(r.doc_id)])
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and row["text"]:
            row["text"] = "".join(c.lower() if c.isascii() else c for c in row["text"])
        node = leaf(row)
        for a, b in proof:
            node = h(a, node, b)
        assert (r.leaf, r.subroot, r.root, r.folded_root, r.verified) == (d, subroot, root, node, node == root)
        assert r.proof_sha256 == h(*(a + b for a, b in proof))
    assert {r.verified for r in got} == {True, False}
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(CHECKS["op11_merkle_manifest"]).fetchall()
    names = [c[0] for c in con.description]
    assert sorted(str([getattr(r, c) for c in names]) for r in got) == sorted(str(list(x)) for x in found)


def test_odd_tables(spark):
    named = ("doc_id", "lang", "text", "k1")
    assert merkle_manifest(docs(spark, []), columns=named, group="lang").count() == 0
    one = merkle_manifest(docs(spark, [(None, None)]), columns=named, group="lang", carry={"twice": F.lit(2)}).first()
    assert one.leaf == one.subroot == one.root and one.proof == [] and one.twice == 2
    same = merkle_manifest(docs(spark, [(1, "x")] * 20), columns=named, group="lang").withColumn("folded", folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(same) == 20 and all(r.folded == r.root for r in same)
