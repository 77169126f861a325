from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.data import docs, odd_rows, words

from hrflow.llm.common import Scratch
from hrflow.llm.simhash_dedup import _index_keys, _links, _spanning, drop_simhash_duplicates, fingerprint, linked, simhash_components, tallies


def slow_fingerprint(text: str) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    w = [x for x in lowered.split(" ") if x]
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64(s.encode(), seed=42).intdigest() >> bit & 1 for s in sh)
        out |= (2 * ones > len(sh)) << bit
    return out


def components(rows, prints, distance=3):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(doc, low.get(root(i), doc))
    return [low.get(root(i)) for i in range(len(rows))]


def edited(text: str, seed: int) -> str:
    w = text.split()
    w[seed % len(w)] = "zz"
    return " ".join(w)


def test_equals_brute_force(spark):
    rows = odd_rows() + [(50 + i, edited(words(9, 200), i * 7)) for i in range(25)] + [(90 + i, edited(words(8, 300), i)) for i in range(10)]
    prints = [slow_fingerprint(t or "") for _, t in rows]
    want = sorted(zip([i for i, _ in rows], [f"{p:016x}" for p in prints], components(rows, prints), strict=True), key=str)
    for block in (2, 1024):
        got = simhash_components(docs(spark, rows), block=block).collect()
        assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=str) == want


def test_fingerprint_in_pieces():
    text = words(3, 500).encode()
    assert fingerprint(text, piece=7) == fingerprint(text) == slow_fingerprint(text.decode())


def test_every_pair_within_distance_meets(spark):
    r = random.Random(5)
    a = [r.getrandbits(64) for _ in range(150)]
    b = [x ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 3))) for x in a]
    signed = np.array([a, b], np.uint64).view(np.int64).T.tolist()
    df = spark.createDataFrame([(i, side, fp) for i, pair in enumerate(signed) for side, fp in enumerate(pair)], "i int, side int, fp long")
    keys = df.select("i", "side", F.array(*_index_keys(3, 4)).alias("keys"))
    met = keys.filter("side = 0").alias("x").join(keys.filter("side = 1").alias("y"), "i")
    assert met.filter(F.arrays_overlap("x.keys", "y.keys")).count() == len(a)


def test_spanning_forest_connects_what_links_connect():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 6, np.uint64)
    fps = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(k)) for k in range(20)]))
    edges = _spanning(fps, 3)
    assert len(edges) < len(fps)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in edges:
        assert int(fps[i] ^ fps[j]).bit_count() <= 3
        parent[root(i)] = root(j)
    for i in range(len(fps)):
        for j in range(i):
            if int(fps[i] ^ fps[j]).bit_count() <= 3:
                assert root(i) == root(j)


def test_runs_go_on_across_batches():
    import pyarrow as pa

    fps = np.arange(1, 9, dtype=np.int64)
    table = pa.table({"key": [1] * 8, "low": [0] * 8, "high": [0] * 8, "fp": fps})
    out = pa.Table.from_batches(list(_links(3)(iter(table.to_batches(max_chunksize=3)))))
    assert out.num_rows == 7


def test_empty_table_and_nulls(spark):
    assert simhash_components(docs(spark, [])).count() == 0
    got = simhash_components(docs(spark, [(None, None), (None, "")])).collect()
    assert [(r.fingerprint, r.component_id) for r in got] == [("0" * 16, None)] * 2


def test_count_filter_drops_pairs_and_loses_none():
    r = np.random.default_rng(4)
    a = r.integers(0, 1 << 63, 4000, np.uint64)
    flips = [sum(1 << int(k) for k in r.choice(64, r.integers(0, 9), replace=False)) for _ in a]
    x = np.array(flips, np.uint64)
    bits = np.array([f.bit_count() for f in flips])
    assert (linked(x, 3) == (bits <= 3)).all()
    shared = np.array([sum((f >> 8 * p) & 255 == 0 for p in range(8)) for f in flips])
    assert (tallies(x) == shared).all()
    assert (shared[bits <= 3] >= 5).all() and (shared < 5).sum() > 100  # what the filter drops before any bit is counted


def test_one_row_of_each_component_stays(spark):
    rows = odd_rows() + [(50 + i, edited(words(9, 200), i * 7)) for i in range(25)] + [(None, words(9, 200))]
    table = docs(spark, rows)
    left = drop_simhash_duplicates(table)
    assert left.columns == table.columns
    prints = [slow_fingerprint(t or "") for _, t in rows]
    found = components([(i, "") for i in range(len(rows))], prints)
    want = {min((rows[j][0] is None, rows[j][0] or 0) for j in range(len(rows)) if found[j] == c) for c in set(found)}
    got = [(r.doc_id is None, r.doc_id or 0) for r in left.collect()]
    assert len(got) == len(set(found)) and set(got) == want
    assert drop_simhash_duplicates(docs(spark, [])).count() == 0


def test_rows_made_for_a_group_grow_in_proportion(spark):
    counts = []
    for n in (300, 600):
        base = words(31, 400)
        rows = [(i, edited(base, i)) for i in range(n)]
        fps = np.unique(np.array([fingerprint(t.encode()) for _, t in rows], np.uint64))
        counts.append((len(fps), len(_spanning(fps, 3))))
    assert all(edges < entries for entries, edges in counts)


@pytest.mark.parametrize("narrow", [simhash_components, drop_simhash_duplicates])
def test_index_keys_are_never_broadcast(spark, monkeypatch, narrow):
    plans, save = {}, Scratch.save

    def saved(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name)

    monkeypatch.setattr(Scratch, "save", saved)
    narrow(docs(spark, [(i, words(i, 30)) for i in range(5)]))
    assert "SortMergeJoin" in plans["edges-0"] and "Broadcast" not in plans["edges-0"]
