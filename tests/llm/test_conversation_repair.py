from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256
from itertools import product

import duckdb
import pytest

from hrflow.llm.conversation_repair import repair_conversations, repaired_turns
from hrflow.llm.queries import CHECKS, QUERIES

SPACES = " \t\n\x0b\x0c\r"
RIGHT = re.compile(r"(s?(ua)+)?")


def faults(rows: list[tuple[str, str]]) -> list[str]:
    out, seen = [], set()
    for role, text in rows:
        words = text.strip(SPACES)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str, str]:
    """All edits of a short conversation, up to three insertions at each place, by trying them."""
    best = None
    marks = faults(rows)
    paths = [(0, "", [])]
    for (role, text), fault in [*zip(rows, marks, strict=True), (("", ""), "end")]:
        grown = []
        for cost, audit, done in paths:
            for k in range(4):
                for roles in product(("user", "assistant"), repeat=k):
                    base = (cost + 3 * k, audit + "I" * k, [*done, *((r, "") for r in roles)])
                    if fault == "end":
                        grown.append(base)
                        continue
                    more = 3 * (fault == "truncated")
                    grown.append((base[0] + 4, base[1] + "D", base[2]))
                    if fault not in ("blank", "duplicate"):
                        grown.append((base[0] + more, base[1] + "K", [*base[2], (role, text)]))
                        grown += [(base[0] + 3 + more, base[1] + "R", [*base[2], (r, text)]) for r in ("user", "assistant")]
        # A start that no ending completes is left out.
        paths = [p for p in grown if re.fullmatch(r"s?(ua)*u?", "".join(r[:1] or "-" for r, _ in p[2])) and p[0] <= 4 * len(rows)]
    for cost, audit, done in paths:
        if RIGHT.fullmatch("".join(r[:1] for r, _ in done)) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in done))
    return best


def expected(turns: list[tuple], ids: set) -> list[tuple]:
    groups = defaultdict(list)
    for conv, turn, role, text in turns:
        groups[conv].append((turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " "))
    out = []
    for conv in ids:
        rows = sorted(groups[conv])
        plain = [r[2:] for r in rows]
        places = {t for known, t, _, _ in rows if known}
        found = faults(plain)
        cost, audit, body = cheapest(plain)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:], strict=False))
        gaps = max(places) - min(places) + 1 - len(places) if places else 0
        out.append((conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, conv string, again string, chunk string, gone boolean"


def table(spark, rows, gone=()):
    data = [(*r, "x", "y", "z", False) for r in rows] + [(*r, "x", "y", "z", True) for r in gone]
    return spark.createDataFrame(data, SCHEMA)


def some_turns(seed: int, convs: int, most: int) -> list[tuple]:
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "User", "", None, "ux", "tool"]
    texts = ["Hi.", "Yes!", "Well?", "cut", "cut \n", "", " \t", None, "a é.", "a é. ", "b?"]
    return [
        (c, None if r.random() < 0.1 else r.randint(0, 5), r.choice(roles if r.random() < 0.4 else roles[:2]), r.choice(texts if r.random() < 0.5 else texts[:3]))
        for c in [*range(convs), None]
        for _ in range(r.randint(1, most))
    ]


@pytest.mark.parametrize("spill", [1, 3, 65_536])
def test_reports_equal_exhaustive_search(spark, spill):
    turns = some_turns(spill, 120, 5)
    frame = table(spark, turns, gone=[(1000, 1, "user", "Hi."), (3, 9, "user", "Hi.")])
    report = repair_conversations(frame, absent="gone", spill=spill)
    got = sorted([tuple(r) for r in report.collect()], key=str)
    assert got == expected(turns, {t[0] for t in turns} | {1000})
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    done = defaultdict(list)
    for r in repaired_turns(frame, report, absent="gone").collect():
        done[r.conv_id].append((r.place, f"{r.role}:{r.text}", r.edit))
    for conv, *_, audit, digest in got:
        assert [p for p, _, _ in sorted(done[conv])] == list(range(len(done[conv])))
        assert sha256("\n".join(t for _, t, _ in sorted(done[conv])).encode()).hexdigest() == digest
        assert "".join(e for _, _, e in sorted(done[conv])) == audit.replace("D", "")


def test_giant_conversation_over_many_batches(spark):
    r = random.Random(3)
    turns = [(7, i, "user" if i % 2 == 0 else "assistant", f"{r.random()}{r.choice(['.', '.', '.', ''])}") for i in range(25_000) if i % 100]
    turns += [(8, 1, "user", "same.")] * 3000
    short = repair_conversations(table(spark, turns), spill=100).collect()
    whole = repair_conversations(table(spark, turns), spill=10**9).collect()
    assert sorted(short) == sorted(whole)
    by = {r.conv_id: r for r in short}
    assert by[7].gaps == 249 and len(by[7].audit.replace("I", "")) == 24_750
    assert by[8].duplicate == 2999 and by[8].cost == 3 + 4 * 2999 and by[8].audit == "KI" + "D" * 2999 or by[8].audit == "K" + "D" * 2999 + "I"


def test_empty_tables(spark):
    assert repair_conversations(table(spark, [])).count() == 0
    none = table(spark, [])
    assert repaired_turns(none, repair_conversations(none)).count() == 0


def test_query_equals_damage_and_search(spark, tmp_path):
    turns = some_turns(9, 150, 5)
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    damaged = []
    for conv, turn, role, text in turns:
        conv_, turn_, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    want = expected(damaged, {t[0] for t in turns})
    frame = QUERIES["op13_conversation_repair"](spark, str(tmp_path))
    assert sorted([tuple(r) for r in frame.collect()], key=str) == want
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(con.execute(CHECKS["op13_conversation_repair"]).fetchall(), key=str) == want
