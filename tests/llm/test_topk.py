from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from hrflow.llm import topk_search
from hrflow.llm.topk_search import _statistics, top_k

SCHEMA = "vec_id long, embedding array<double>, label int, v string, block string, slot string, ids string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def slow(rows, queries, k):
    out = []
    for q, a in queries:
        found = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in rows if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_equals_brute_force_with_ties(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.integers(-3, 4, 17).astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]  # equal vectors
    df = table(spark, [(i, (np.array(v) / 256).tolist()) for i, v in rows])
    got = top_k(df, df.filter(F.col("vec_id") % 20 == 0), query_block=4, block=50)
    ints = [(i, [int(x) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == slow(ints, [x for x in ints if x[0] % 20 == 0], 5)


def test_floor_of_scaled_components(spark):
    rows = [(0, [0.5, -0.001]), (1, [0.999, 1.0]), (2, [-0.25, -1e-9])]
    got = top_k(table(spark, rows), table(spark, rows[:1]), k=5).collect()
    q, c = [[int(np.floor(256 * x)) for x in v] for _, v in rows[:1]][0], [[int(np.floor(256 * x)) for x in v] for _, v in rows]
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == sorted(
        [(i, sum(a * b for a, b in zip(q, c[i], strict=True))) for i in (1, 2)], key=lambda x: (-x[1], x[0])
    )


def test_odd_rows_take_no_part(spark):
    rows = [(1, [1.0, 1.0]), (2, None), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [float("inf"), 1.0]), (None, [9.0, 9.0])]
    rows += [(6, [2.0]), (7, []), (8, [3.0, 0.0]), (8, [3.0, 0.0]), (9, [1e9, 1e9])]
    got = top_k(table(spark, rows), table(spark, rows)).collect()
    assert {r.query_id for r in got} == {1, 6, 7, 8, 9} and {r.vec_id for r in got} == {1, 6, 7, 8, 9}
    assert all(r.query_id != r.vec_id for r in got if r.query_id != 8) and len(got) == 6 * 5


def test_rows_that_share_an_id_all_count(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [3.0, 0.0]), (2, [1.0, 1.0])]
    got = top_k(table(spark, rows), table(spark, rows[:1]), k=3, scale=1.0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 1, 3), (0, 2, 1, 2), (0, 3, 2, 1)]
    got = top_k(table(spark, rows), table(spark, rows[1:3]), k=1, scale=1.0).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == [(1, 1, 6), (1, 1, 6)]


def test_equal_rows_are_each_others_candidates(spark):
    rows = [(7, [2.0])] * 9 + [(7, [2.0, 0.0]), (8, [1.0])]
    got = top_k(table(spark, rows), table(spark, rows), k=4, scale=1.0, query_block=3, block=2).collect()
    assert len(got) == 11 * 4 and {(r.vec_id, r.score) for r in got if r.query_id == 7} == {(7, 4)}
    got = top_k(table(spark, rows[8:]), table(spark, rows[8:9]), k=4, scale=1.0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 7, 4), (2, 8, 2)]


def test_bounds_hold_at_every_resolution():
    r = np.random.default_rng(1)
    q, x = r.integers(-99, 99, (20, 24)), r.integers(-99, 99, (60, 24))
    exact, last = q @ x.T, None
    for segments in (1, 4, 16):
        bound = _statistics(q, segments) @ _statistics(x, segments).T
        assert (bound + 1e-6 >= exact).all()
        last = bound if last is None else last
    assert bound.sum() < last.sum()


def test_empty(spark):
    full, none = table(spark, [(1, [1.0]), (2, [2.0])]), table(spark, [])
    assert top_k(none, full).count() == top_k(full, none).count() == top_k(none, none).count() == 0


def test_copies_of_queries_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SLOT", 500)
    r = np.random.default_rng(5)
    rows = [(i, r.integers(-3, 4, 9).astype(float).tolist()) for i in range(200)]
    df = table(spark, rows)
    got = top_k(df, df.filter(F.col("vec_id") % 10 == 0), scale=1.0, query_block=3, block=4)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    ints = [(i, [int(x) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == slow(ints, [x for x in ints if x[0] % 10 == 0], 5)
