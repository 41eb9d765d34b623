"""Conversation structure repair: cheapest edits by a cost DP, and of these the least audit by prefix-doubling ranks.

Edits of a conversation's rows: Keep (0), Rerole to user or assistant (2), Delete
(3; a blank or duplicate row must go), Insert an empty user or assistant row (2);
a truncated row that stays adds 1.  The roles that result must read
``(s?(ua)+)?`` by their initials.  A node is (rows read, state of that
pattern); a backward DP gives every node its cost to the end, and the arcs that
keep the sum are optimal.

Of all cheapest edits the least audit (their initials, D < I < K < R) is asked.
Nodes are ranked by the first 1, 2, 4, ... letters of the least audit that starts
there: the rank for twice the length is that of the pair (own rank, rank of the
node reached), and pointers double with it.  From one node each letter leads to
one node, so the node behind a least prefix is unique.  Each node then
chooses the arc with the least (letter, rank of its end), and the doubled pointers list
all nodes of the path in a logarithm of steps.  All conversations of a batch are ranked
together in numpy.

Steps on Spark: rows are shuffled twice by conv_id and sorted inside the
partition.  First without texts: a row is its role initial, its faults and a
128-bit digest of role and text, from which the audit is found.  Then the audits
and the texts meet, and a task applies the audit row by row as it reads them: it
holds one batch of texts and one audit, never a conversation's texts.

A conversation is a sequence: the audit of one and the hash of its repaired text
are made by one task each.  That task holds some 200 bytes a row of its conversation.

Defined results: a null role or text counts as one space; rows with equal turns
are ordered by role and the digest of role and text; a row with an empty role or an initial
other than s, u and a can't be kept; a null conv_id is a conversation of its own;
repeated rows are duplicates; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import in_batches, read_table, stored

QUERY_NAME = "op12_prefix_repair"

#: Costs of the edits, and what a truncated row that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of the pattern: nothing yet, after s, after u, after a; the pattern may end at nothing and after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (START, AFTER_A)
#: What an inserted or reroled row becomes, and so the state after it, by state.
NEXT_STATE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NEXT_ROLE = ("user", "user", "assistant", "user")
#: State after a kept row, by (state, initial).
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_A, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A}
LETTERS = "DIKR"
#: Pairs of initials that may stand side by side.
ADJACENT = {"su", "ua", "au"}
#: Rows whose conversations are ranked together.
RANK_ROWS = 1 << 14
NONE = " "


def damage(rows: DataFrame) -> DataFrame:
    """*rows* with a defined share of faults, by the CRC-32 of conv_id and turn modulo 20: dropped (the column `gone`), emptied, without [.!?], repeated, or role user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(text("role")).alias("role"), said.alias("text"), (kind == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    """Rows of a conversation together in one partition and in their order; both passes must use the same."""
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), "role", "mark")


def _marked(rows: DataFrame) -> DataFrame:
    """role and text without nulls, and the digest of both; `gone` rows count for the conversation's existence only."""
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in ("role", "text"))
    mark = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), gone.alias("gone"), mark.alias("mark"))


@dataclass
class _Conversation:
    """What is kept of a conversation: initials, which rows must go, which are truncated, and its counts."""

    key: object
    initials: list[str] = field(default_factory=list)
    must_go: list[bool] = field(default_factory=list)
    truncated: list[bool] = field(default_factory=list)
    marks: set[bytes] = field(default_factory=set)
    turns: list[int] = field(default_factory=lambda: [0, 0, 0])  # least, largest, different ones
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0))

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, mark: bytes) -> None:
        seen = mark in self.marks
        self.marks.add(mark)
        fault = "blank" if blank else "duplicate" if seen else "truncated" if cut else None
        if fault:
            self.counts[fault] += 1
        if self.initials and self.initials[-1] + initial not in ADJACENT:
            self.counts["illegal"] += 1
        self.initials.append(initial)
        self.must_go.append(blank or seen)
        self.truncated.append(fault == "truncated")
        if turn is not None:
            least, last, n = self.turns
            self.turns = [turn, turn, 1] if not n else [least, turn, n + (turn != last)]

    @property
    def gaps(self) -> int:
        least, last, n = self.turns
        return last - least + 1 - n if n else 0


def costs_to_end(c: _Conversation) -> list[tuple[int, int, int, int]]:
    """The least cost from (rows read, state) to an end, for each number of rows read."""

    def inserts(now: list[float]) -> tuple:
        """Also by inserted rows; no more than two in a row can pay."""
        u, a = min(now[AFTER_U], now[AFTER_A] + INSERT), min(now[AFTER_A], now[AFTER_U] + INSERT)
        return min(now[START], u + INSERT), min(now[AFTER_S], u + INSERT), u, a

    out = [inserts([0 if s in ENDS else np.inf for s in range(4)])]
    for k in range(len(c.initials) - 1, -1, -1):
        later, now = out[-1], []
        for s in range(4):
            best = later[s] + DELETE
            if not c.must_go[k]:
                best = min(best, later[NEXT_STATE[s]] + REROLE + TRUNCATED * c.truncated[k])
                if (kept := KEPT.get((s, c.initials[k]))) is not None:
                    best = min(best, later[kept] + KEEP + TRUNCATED * c.truncated[k])
            now.append(best)
        out.append(inserts(now))
    return out[::-1]


def _optimal_arcs(c: _Conversation, costs: list[tuple]) -> np.ndarray:
    """(nodes x letters) the node that an optimal arc leads to, else -1; node number = 4 * rows read + state."""
    n = len(c.initials)
    arcs = np.full((4 * (n + 1), len(LETTERS)), -1, np.int64)
    for k in range(n + 1):
        for s in range(4):
            cost, node = costs[k][s], 4 * k + s
            if costs[k][NEXT_STATE[s]] + INSERT == cost:
                arcs[node, 1] = 4 * k + NEXT_STATE[s]
            if k == n:
                continue
            extra = TRUNCATED * c.truncated[k]
            if costs[k + 1][s] + DELETE == cost:
                arcs[node, 0] = node + 4
            if not c.must_go[k]:
                kept = KEPT.get((s, c.initials[k]))
                if kept is not None and costs[k + 1][kept] + KEEP + extra == cost:
                    arcs[node, 2] = 4 * (k + 1) + kept
                if costs[k + 1][NEXT_STATE[s]] + REROLE + extra == cost:
                    arcs[node, 3] = 4 * (k + 1) + NEXT_STATE[s]
    return arcs


def least_arcs(arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter (from 1; 0 at an end) and next node of every node on its least path to a node without arcs, by ranks of doubled prefixes.

    arcs: (nodes x letters) -> node or -1, without cycles.
    """
    nodes = np.arange(len(arcs))
    open_ = (arcs >= 0).any(axis=1)
    letter = np.where(open_, np.argmax(arcs >= 0, axis=1) + 1, 0)  # the end comes before all letters
    jump = np.where(open_, arcs[nodes, letter - 1], nodes)
    rank = letter
    while (letter[jump] > 0).any():
        rank = np.unique(rank * (len(arcs) + 1) + rank[jump], return_inverse=True)[1]
        jump = jump[jump]
    # of each node the arc with the least letter and, behind it, the least rank
    size = int(rank.max(initial=0)) + 1
    key = np.where(arcs >= 0, np.arange(arcs.shape[1]) * size + rank[arcs], np.iinfo(np.int64).max)
    chosen = np.argmin(key, axis=1)
    return np.where(open_, chosen + 1, 0), np.where(open_, arcs[nodes, chosen], nodes)


def letters_from(starts: np.ndarray, letter: np.ndarray, jump: np.ndarray) -> list[np.ndarray]:
    """The letters of the path from each start to its end: the nodes listed so far and those the doubled pointers lead to from them."""
    paths = starts.reshape(-1, 1)
    while (letter[paths[:, -1]] > 0).any():
        paths = np.concatenate([paths, jump[paths]], axis=1)
        jump = jump[jump]
    return [row[row > 0] for row in letter[paths]]


def audits_of(found: list[_Conversation]) -> tuple[list[int], list[str]]:
    """Cost and least audit of each conversation."""
    if not found:
        return [], []
    costs = [costs_to_end(c) for c in found]
    arcs = [_optimal_arcs(c, x) for c, x in zip(found, costs)]
    first = np.cumsum([0, *map(len, arcs)])
    letter, jump = least_arcs(np.concatenate([np.where(a >= 0, a + f, -1) for a, f in zip(arcs, first)]))
    # paths are listed as wide as the longest of their group, so conversations of like length go together
    by_length = np.argsort([len(c.initials) for c in found], kind="stable")
    audits = [""] * len(found)
    for group in np.array_split(by_length, len(found) // 64 + 1):
        for k, path in zip(group, letters_from(first[:-1][group], letter, jump)):
            audits[k] = "".join(LETTERS[x - 1] for x in path)
    return [int(x[0][START]) for x in costs], audits


def audit(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation of *rows* (conv_id, turn, role, text; gone rows are known of only)."""
    text = F.col("text")
    narrow = _marked(rows).select(
        "conv_id", "turn", "role", "mark", "gone", F.substring("role", 1, 1).alias("initial"), (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut")
    )
    ordered = _ordered(narrow).drop("role")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[_Conversation] = []
        held = 0
        kind = None

        def result() -> pa.RecordBatch:
            totals, texts = audits_of(done)
            numbers = [[{**c.counts, "gaps": c.gaps, "cost": t}[n] for c, t in zip(done, totals)] for n in names]
            return pa.RecordBatch.from_arrays([pa.array([c.key for c in done], kind), *[pa.array(x, pa.int64()) for x in numbers], pa.array(texts, pa.string())], ["conv_id", *names, "audit"])

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "turn", "mark", "gone", "initial", "blank", "cut"))
            for key, turn, mark, gone, initial, blank, cut in zip(*columns):
                if not done or done[-1].key != key:
                    if held >= RANK_ROWS:
                        yield result()
                        done, held = [], 0
                    elif done:
                        done[-1].marks = set()
                    done.append(_Conversation(key))
                if not gone:
                    done[-1].add(turn, initial, blank, cut, mark)
                    held += 1
        if done:
            yield result()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return in_batches(ordered, find, f"conv_id {kind}, {', '.join(f'{n} long' for n in names)}, audit string")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, place, edit, role and text of each row of the repaired conversations, those of a conversation together and in order."""
    texts = _marked(rows).filter("NOT gone").select("conv_id", F.lit(1).alias("part"), "turn", "role", "mark", "text", F.lit(None).cast("string").alias("audit"))
    heads = audits.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("mark"), F.lit("").alias("text"), "audit")
    both = _ordered(heads.unionByName(texts), "part").select("conv_id", "part", "role", "text", "audit")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, at, state, place = None, "", 0, START, 0
        for batch in batches:
            out: list[tuple] = []

            def put(edit: str, role: str, text: str) -> None:
                nonlocal place
                out.append((key, place, edit, role, text))
                place += 1

            def insert() -> None:
                nonlocal at, state
                while audit[at : at + 1] == "I":
                    put("I", NEXT_ROLE[state], "")
                    state, at = NEXT_STATE[state], at + 1

            for row_key, part, role, text, row_audit in zip(*(c.to_pylist() for c in batch.columns)):
                if part == 0:
                    key, audit, at, state, place = row_key, row_audit, 0, START, 0
                else:
                    edit, at = audit[at], at + 1
                    if edit == "K":
                        put(edit, role, text)
                        state = KEPT[state, role[0]]
                    elif edit == "R":
                        put(edit, NEXT_ROLE[state], text)
                        state = NEXT_STATE[state]
                insert()
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()))], ["conv_id", "place", "edit", "role", "text"])

    kind = rows.schema["conv_id"].dataType.simpleString()
    return in_batches(both, apply, f"conv_id {kind}, place long, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of ``role:text`` lines; *turns* as `repaired` gives them, in its partitions and order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kind, state = None, None, None
        for batch in batches:
            kind, out = batch.schema.field("conv_id").type, []
            for row_key, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = row_key, hashlib.sha256()
                state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], kind), pa.array([x for _, x in out], pa.string())], ["conv_id", "repaired_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([state.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return in_batches(turns.select("conv_id", "place", "role", "text"), digest, f"conv_id {kind}, repaired_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damage(read_table(spark, sf_dir, "conversations"))
    audits = stored(audit(rows), "audits")
    hashes = digests(repaired(rows, audits)).withColumnRenamed("conv_id", "_conv")
    empty = hashlib.sha256(b"").hexdigest()
    joined = audits.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty)))
