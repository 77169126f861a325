from __future__ import annotations

import re
from collections import defaultdict
from hashlib import sha256

import pytest
from tests.llm.data import docs, odd_rows, words

from hrflow.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[norm], key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((i, best[2], len(groups[norm]), sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [3, 64, 1024])
def test_groups_equal_brute_force(spark, block):
    rows = odd_rows() + [(100 + i, words(i % 4, 30)) for i in range(12)]
    got = exact_duplicates(docs(spark, rows), block=block, head=2).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == expected(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}  # ties, repeated rows and null ids leave one row of each group
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_stage_keeps_columns_and_one_row(spark):
    table = docs(spark, odd_rows())
    left = drop_exact_duplicates(table)
    assert left.columns == table.columns
    got = [(r.doc_id, re.sub(r"[\x20\x09-\x0D]", "", r.text or "")) for r in left.collect()]
    assert len({t for _, t in got}) == len(got) == len({re.sub(r"\s", "", t or "") for _, t in odd_rows()})


def test_empty_table(spark):
    assert exact_duplicates(docs(spark, [])).count() == 0
    assert drop_exact_duplicates(docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_duplicates(docs(spark, odd_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
