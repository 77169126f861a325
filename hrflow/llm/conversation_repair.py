"""Repair of conversations: secondary-sorted streams, a dynamic programme whose state passes from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.llm.common import Scratch

#: White space, and what ends a sentence.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: Costs of edits; a truncated row that stays costs ``TRUNCATED`` more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NEVER = 1 << 60
#: States: nothing yet, after the system row, after a user row, after an assistant row.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row of each role; what the role structure does not allow is absent.
NEXT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
EDITS = "DKR"


def inserted(state: int) -> int:
    """The state after an inserted row: the only role that may follow, user before anything else."""
    return ASSISTANT if state == USER else USER


@cache
def moves(initial: str, must_go: bool, truncated: bool) -> list[list[tuple[int, str, int, int]]]:
    """For each new state: (old state, edits as text, cost, packed link) of all ways to deal with one row.

    One row may be inserted before it. Two never pay: they lead back to an equal or a worse state.
    """
    out: list[list[tuple[int, str, int, int]]] = [[] for _ in range(4)]
    for old in range(4):
        for k in range(2):
            state = inserted(old) if k else old
            extra = TRUNCATED if truncated else 0
            ways = [(state, "D", DELETE)]
            if not must_go:
                if (state, initial) in NEXT:
                    ways.append((NEXT[state, initial], "K", KEEP + extra))
                ways += [(NEXT[state, r], "R", REROLE + extra) for r in "ua" if (state, r) in NEXT]
            for new, edit, cost in ways:
                out[new].append((old, "I" * k + edit, cost + k * INSERT, old | k << 2 | EDITS.index(edit) << 3))
    return out


@cache
def advance(costs: tuple[int, ...], ranks: tuple[int, ...], initial: str, must_go: bool, truncated: bool) -> tuple:
    """One step of the programme: new costs (least 0), what was taken off them, ranks, links and (old state, edits) by state.

    ``ranks`` orders the edit texts that lead to the states. No such text begins another one, as each ends with the
    edit of the last row, and different states have different texts; so old rank, then new edits order the new texts.
    Costs less their least and ranks take few values, so the steps are remembered.
    """
    best = [
        min(((costs[old] + cost, ranks[old], edits, old, link) for old, edits, cost, link in ways if costs[old] < NEVER), default=None)
        for ways in moves(initial, must_go, truncated)
    ]
    order = sorted((b[1], b[2], s) for s, b in enumerate(best) if b)
    rank = {s: i for i, (_, _, s) in enumerate(order)}
    least = min(b[0] for b in best if b)
    return (
        tuple(b[0] - least if b else NEVER for b in best),
        least,
        tuple(rank.get(s, 9) for s in range(4)),
        bytes(b[4] if b else 255 for b in best),
        tuple((b[3], b[2]) if b else None for b in best),
    )


def walk_back(links: bytes, state: int) -> tuple[list[str], int]:
    """Edits of the rows behind ``links`` (four bytes a row) that lead to ``state``, last row first, and the state before."""
    out = []
    for at in range(len(links) - 4, -1, -4):
        link = links[at + state]
        state = link & 3
        out.append("I" * (link >> 2 & 1) + EDITS[link >> 3])
    return out, state


class Run:
    """The state of one conversation while its rows pass by: counts, costs, links and a running digest for each state."""

    def __init__(self, name: str | None):
        self.name, self.total, self.costs, self.ranks = name, 0, (0, NEVER, NEVER, NEVER), (0, 9, 9, 9)
        self.digests = [sha256(), None, None, None]
        self.links, self.chunk = bytearray(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, turn: str | None, role: str, text: str, again: bool) -> None:
        if turn is not None:
            place = int(turn)
            self.first = place if self.first is None else self.first
            self.turns += place != self.last
            self.last = place
        again = again or (self.before is not None and self.before == (turn, role, text))
        initial = role[:1]
        self.illegal += self.before is not None and self.before[1][:1] + initial not in ("su", "ua", "au")
        self.before = (turn, role, text)
        stripped = text.rstrip(BLANKS)
        blank = not stripped
        cut = not blank and not again and not stripped.endswith(ENDS)
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut
        self.costs, least, self.ranks, links, ways = advance(self.costs, self.ranks, initial, blank or again, cut)
        self.total += least
        self.links += links
        self.digests = [self._digest(way, role, text) if way else None for way in ways]

    def _digest(self, way: tuple[int, str], role: str, text: str):
        state, edits = way
        digest = self.digests[state]
        if edits == "D":
            return digest
        digest = digest.copy()
        if edits[0] == "I":
            digest.update(("\n" * (state != NONE) + ROLES[inserted(state)] + ":").encode())
            state = inserted(state)
        if edits[-1] != "D":
            shown = role if edits[-1] == "K" else ROLES[inserted(state)]
            digest.update(f"{chr(10) * (state != NONE)}{shown}:{text}".encode(errors="surrogatepass"))
        return digest

    def spill(self) -> dict:
        """The links of the rows so far, as a row of output."""
        row = {"conv": self.name, "chunk": self.chunk, "links": bytes(self.links)}
        self.links, self.chunk = bytearray(), self.chunk + 1
        return row

    def end(self) -> list[dict]:
        """The last rows of output: the report, with the audit if all links are at hand."""
        trailing = {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
        cost, _, state = min((self.costs[s] + INSERT * k, self.ranks[s], s) for s, k in trailing.items())
        digest, at = self.digests[state], state
        for _ in range(trailing[state]):
            digest = digest.copy()
            digest.update(("\n" + ROLES[inserted(at)] + ":").encode())
            at = inserted(at)
        report = {"conv": self.name, "state": state, "tail": "I" * trailing[state], "cost": self.total + cost, "sha": digest.hexdigest()}
        report["gaps"] = 0 if self.first is None else self.last - self.first + 1 - self.turns
        report |= {"blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}
        if self.chunk:
            return [self.spill(), report]
        edits, _ = walk_back(bytes(self.links), state)
        return [report | {"audit": "".join(reversed(edits)) + report["tail"]}]


FOUND = {
    "conv": "string", "chunk": "long", "links": "binary", "state": "int", "tail": "string", "cost": "long", "sha": "string", "gaps": "long",
    "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "audit": "string",
}


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=object) for c in FOUND})


def _stream(spill: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: Run | None = None
        for batch in batches:
            out = []
            for conv, turn, role, text, again, here in zip(*(batch[c].tolist() for c in ("conv", "turn", "role", "text", "again", "here")), strict=True):
                if now is None or now.name != conv:
                    out += now.end() if now else []
                    now = Run(conv)
                if here:
                    now.add(turn, role, text, bool(again))
                    if len(now.links) >= 4 * spill:
                        out.append(now.spill())
            if out:
                yield _frame(out)
        if now:
            yield _frame(now.end())

    return run


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audits of spilled conversations, chunk by chunk from the last; each is headed by its report."""
    state, tail = 0, ""
    for batch in batches:
        out = []
        for conv, chunk, links, last, ending in zip(*(batch[c].tolist() for c in ("conv", "chunk", "links", "state", "tail")), strict=True):
            if links is None:
                state, tail = int(last), ending
                continue
            edits, state = walk_back(links, state)
            out.append((conv, int(chunk), "".join(reversed(edits)) + tail))
            tail = ""
        yield pd.DataFrame(out, columns=["conv", "chunk", "piece"])


def _turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, absent: str | None) -> DataFrame:
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    here = ~F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(True)
    return turns.select(
        F.col(conv_id).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), shown(role).alias("role"), shown(text).alias("text"), here.alias("here")
    )


def repair_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None, spill: int = 65_536
) -> DataFrame:
    """One row for every conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are read by turn, nulls first, ties by role, then text. ``gaps`` counts missing turns between the first and the last. A row's
    first fault counts: blank (white space alone), duplicate (same role and text earlier in the conversation) or truncated (does not
    end with ``.``, ``!`` or ``?``). ``illegal`` counts neighbours whose role initials are none of su, ua, au. The
    repair makes the initials ``(s?(ua)+)?`` by Keep, Rerole, Delete and Insert at the least cost; blank and duplicate rows must
    go. ``audit`` has the initials of the edits in order, the ASCII-least among the cheapest, ``repaired_sha256`` the
    digest of the repaired ``role:text`` rows, joined by line feeds. :func:`repaired_turns` gives these rows.

    Method: rows are dealt by conversation and sorted by turn. A stream over the Arrow batches carries four states, each with its cost, the
    rank of its edits and a running digest, so a conversation of any length takes constant memory but for four bytes of links
    a row. After ``spill`` rows the links go out as a row of the stored table; a second, reversed stream reads them
    back. Repeated role and text are found by an aggregate beforehand, not by a set in the task.

    A null role or text counts as one space; a null conversation id is a conversation of its own. Rows with a true
    ``absent`` column keep their conversation in the result and count for nothing else; without other rows all counts are
    zero, the audit is empty and the digest is that of the empty text. An empty table gives an empty result.
    """
    scratch = Scratch(turns.sparkSession, "repair")
    rows = _turns(turns, conv_id, turn, role, text, absent)
    same = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = rows.withColumn("_same", F.struct("conv", same.alias("same")))
    # Among equal rows of one turn the stream tells the first; those of later turns are told here.
    repeated = rows.where("here").groupBy("_same").agg(F.min(F.struct("turn")).alias("_first"), F.count("*").alias("_rows")).where("_rows > 1")
    later = F.col("_first").isNotNull() & ~F.col("_first.turn").eqNullSafe(F.col("turn"))
    marked = rows.join(repeated.drop("_rows"), "_same", "left").withColumn("again", later).drop("_same", "_first")
    dealt = marked.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text", "here").withColumn("turn", F.col("turn").cast("string"))
    found = scratch.save(dealt.mapInPandas(_stream(spill), ", ".join(f"{c} {t}" for c, t in FOUND.items())), "found")
    spilled = found.where("cost is null").select("conv", "chunk", "links", "state", "tail")
    heads = found.where("cost is not null and audit is null").select("conv", "chunk", "links", "state", "tail")
    back = spilled.union(heads).repartition("conv").sortWithinPartitions("conv", F.col("chunk").desc_nulls_first())
    pieces = back.mapInPandas(_pieces, "conv string, chunk long, piece string")
    whole = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "piece"))).alias("parts"))
    whole = whole.select(F.struct("conv").alias("_k"), F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("_whole"))
    report = found.where("cost is not null").withColumn("_k", F.struct("conv")).join(whole, "_k", "left")
    return report.select(
        F.col("conv").cast(turns.schema[conv_id].dataType).alias(conv_id),
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        F.coalesce("audit", "_whole").alias("audit"),
        F.col("sha").alias("repaired_sha256"),
    )


def _apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired rows; each conversation begins with its audit in the column ``text``."""
    conv, audit, at, place, state = None, "", 0, 0, NONE
    out: list[tuple] = []

    def insert() -> None:
        nonlocal at, place, state
        while audit[at : at + 1] == "I":
            state = inserted(state)
            out.append((conv, place, None, ROLES[state], "", "I"))
            at, place = at + 1, place + 1

    for batch in batches:
        for name, head, turn, role, text in zip(*(batch[c].tolist() for c in ("conv", "head", "turn", "role", "text")), strict=True):
            if head:
                insert()
                conv, audit, at, place, state = name, text, 0, 0, NONE
                continue
            insert()
            edit, at = audit[at], at + 1
            if edit != "D":
                state = NEXT[state, role[0]] if edit == "K" else inserted(state)
                out.append((conv, place, turn, role if edit == "K" else ROLES[state], text, edit))
                place += 1
        yield pd.DataFrame(out, columns=["conv", "place", "turn", "role", "text", "edit"])
        out.clear()
    insert()
    yield pd.DataFrame(out, columns=["conv", "place", "turn", "role", "text", "edit"])


def repaired_turns(
    turns: DataFrame, report: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None
) -> DataFrame:
    """The rows that the audits of ``report`` leave and add: conv_id, place (from 0), turn, role, text and edit (K, R or I).

    Inserted rows have no turn and an empty text. Conversations of which nothing is left have no row.
    """
    rows = _turns(turns, conv_id, turn, role, text, absent).where("here").select("conv", F.lit(False).alias("head"), "turn", "role", "text")
    heads = report.select(F.col(conv_id).cast("string").alias("conv"), F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    dealt = rows.union(heads).repartition("conv").sortWithinPartitions("conv", F.col("head").desc(), "turn", "role", "text")
    out = dealt.withColumn("turn", F.col("turn").cast("string")).mapInPandas(_apply, "conv string, place long, turn string, role string, text string, edit string")
    return out.select(F.col("conv").cast(turns.schema[conv_id].dataType).alias(conv_id), "place", F.col("turn").cast("long").alias("turn"), "role", "text", "edit")
