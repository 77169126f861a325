from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.data import docs, odd_rows, words

from hrflow.llm.repeats import Anchors, class_repeats, common_prefix, remove_repeats, without_repeats


def slow(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        runs = int(np.count_nonzero(np.diff(np.concatenate(([0], mask.astype(int)))) == 1))
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
        out.append((doc, len(t), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def material(length):
    r = random.Random(length)
    shared = [words(s, 40) for s in range(4)]
    rows = odd_rows()[:7] + odd_rows()[8:]
    for i in range(40):
        parts = [words(1000 + i, r.randint(0, 30))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, len(s) - 1)
            parts += [s[a : a + r.randint(1, 3 * length)], words(2000 + i, r.randint(0, 5))]
        rows.append((100 + i, " ".join(parts)))
    return rows


@pytest.mark.parametrize(("length", "gram", "large"), [(40, 16, 8192), (40, 16, 1), (30, 5, 4), (8, 64, 8192)])
def test_equals_brute_force(spark, length, gram, large):
    rows = material(length)
    got = remove_repeats(docs(spark, rows), length=length, gram=gram, large=large)
    found = got.collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == slow(rows, length)
    ascii_only = [r for r in found if r.kept_text.isascii()]
    assert len(ascii_only) > 40 and all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in ascii_only if r.n_bytes - r.n_removed == len(r.kept_text))


def test_periodic_and_long_texts(spark):
    rows = [(1, "ab" * 300), (2, "a" * 399), (3, "a" * 400), (4, "a" * 401), (5, words(5, 300_000)), (6, words(6, 200))]
    got = remove_repeats(docs(spark, rows))
    by = {r.doc_id: r for r in got.collect()}
    assert [by[i].n_removed for i in range(1, 7)] == [600, 0, 400, 401, 0, 0]


def test_anchors_depend_on_the_string_alone():
    anchors = Anchors(50, 10)
    data = np.frombuffer(words(1, 400).encode(), np.uint8)
    chosen = set(anchors.of(data)[0].tolist())
    for at in range(0, len(data) - 50, 7):
        (place,) = anchors.of(data[at : at + 50])[0].tolist()
        assert at + place in chosen


def test_tree_finds_partners_that_are_no_neighbours():
    # The best partner of the first right context by left context stands two places away.
    rights = [b"aaaa1", b"aaab2", b"aaac3"]
    lefts = [b"xyzw", b"qqqq", b"xyzv"]
    found = class_repeats(lefts, rights, 6)
    assert (0, 3, 3) in found and (2, 3, 3) in found and not any(i == 1 for i, _, _ in found)
    assert common_prefix(b"abc", b"abd") == 2


def test_stage_keeps_rows_and_columns(spark):
    rows = [(1, "ü" * 300 + "!"), (2, "é" + "ü" * 300), (3, None), (4, "x")]
    table = docs(spark, rows)
    left = without_repeats(table)
    assert left.columns == table.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: "!", 2: "é", 3: None, 4: "x"}
    assert without_repeats(table.filter(F.lit(False))).count() == remove_repeats(table.filter(F.lit(False))).count() == 0
