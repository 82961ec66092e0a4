"""Conversation structure repair by generalised LR parsing.

The roles of a conversation must spell a sentence of a small grammar.  Rows
that do not fit are mended by weighted edits: a row may be kept, given another
role or deleted, and empty rows may be inserted.  The parser keeps a
graph-structured stack: every way of reading the rows so far is a stack of LR
states, and of the ways with equal stack tops only the one of least
(cost, audit) goes on.  The audit is the string of edit initials, ties going to
the least in ASCII.  Stack tops of this grammar leave the same rests open
whatever lies below them, so no cheaper repair is lost.

Rows are hashed by conversation once, sorted within their partitions and read
as a stream.  Of a conversation the stream holds four bytes a row (where each
stack top came from); texts pass through running digests.  A digest of joined
texts is sequential, so one conversation is one task's stream, however long.

Defined results: nulls read as one space, so a null text is blank and a null
role fits nowhere; null conversation ids are one conversation and null turns
come first; rows of equal turn are ordered by role and text; repeated rows are
duplicates; a conversation without rows after damage has zeros, an empty audit
and the digest of nothing; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES

#: The role grammar over role initials: ``(s?(ua)+)?``.
GRAMMAR = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "P"), ("T", "TP"), ("P", "ua"))
ROLES = {"u": "user", "a": "assistant"}
COST = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED = 1
FOLLOWS = ("su", "ua", "au")

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


class Automaton:
    """LR(0) states of a grammar: ``goto``, the rule a state reduces by, and
    the states that end a sentence."""

    def __init__(self, rules: tuple[tuple[str, str], ...] = GRAMMAR):
        self.rules, heads = rules, {a for a, _ in rules}

        def closed(items: frozenset) -> frozenset:
            todo, out = list(items), set(items)
            while todo:
                r, dot = todo.pop()
                for k, (a, _) in enumerate(rules):
                    if rules[r][1][dot:dot + 1] == a and (k, 0) not in out:
                        out.add((k, 0))
                        todo.append((k, 0))
            return frozenset(out)

        start = rules[0][0]
        states = [closed(frozenset((k, 0) for k, (a, _) in enumerate(rules) if a == start))]
        self.goto: dict[tuple[int, str], int] = {}
        for n, items in enumerate(states):
            for x in sorted({rules[r][1][dot] for r, dot in items if dot < len(rules[r][1])}):
                to = closed(frozenset((r, dot + 1) for r, dot in items if rules[r][1][dot:dot + 1] == x))
                if to not in states:
                    states.append(to)
                self.goto[n, x] = states.index(to)
        done = [[r for r, dot in items if dot == len(rules[r][1])] for items in states]
        self.accept = {n for n, rs in enumerate(done) if any(rules[r][0] == start for r in rs)}
        self.reduce = {n: rs[0] for n, rs in enumerate(done) if rs and rules[rs[0]][0] != start}
        assert all(len(states[n]) == 1 for n in self.reduce) and not heads & {"s", "u", "a"}

    def shift(self, stack: tuple[int, ...], x: str) -> tuple[int, ...] | None:
        """The stack after terminal ``x`` and all reductions; None if it
        does not fit."""
        to = self.goto.get((stack[-1], x))
        if to is None:
            return None
        stack += (to,)
        while (r := self.reduce.get(stack[-1])) is not None:
            head, body = self.rules[r]
            stack = stack[:len(stack) - len(body)]
            stack += (self.goto[stack[-1], head],)
        return stack

    def table(self) -> tuple[list[dict[str, int]], list[bool]]:
        """Moves and ends of the stacks that remain after reductions, numbered
        by their tops; stacks of equal tops have equal moves."""
        stacks, moves = [(0,)], []
        for stack in stacks:
            row = {}
            for x in "sua":
                if (to := self.shift(stack, x)) is not None:
                    if to[-1] not in [s[-1] for s in stacks]:
                        stacks.append(to)
                    row[x] = [s[-1] for s in stacks].index(to[-1])
            moves.append(row)
        return moves, [s[-1] in self.accept for s in stacks]


MOVES, ENDS = Automaton().table()
WIDTH = len(MOVES)
assert WIDTH <= 8


class Parse:
    """The stack tops of one conversation, read row by row.

    A top is ``(cost, rank, tail, from, digest)``: ``rank`` orders the audits
    up to the last row among the tops, ``tail`` are the letters since.  Audits
    that have read equally many rows and end with a row's letter are never the
    beginning of one another, so (rank, tail) orders them as their strings.
    """

    def __init__(self) -> None:
        self.tops = {0: (0, 0, "", 0, hashlib.sha256())}
        self.back = bytearray()
        self.tails: list[str] = []
        self._insert()

    def _line(self, top: int, digest, role: str, text: str):
        digest = digest.copy()
        digest.update((f"{role}:{text}" if top == 0 else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
        return digest

    def _insert(self) -> None:
        """All ways on by inserted rows."""
        todo = sorted(self.tops)
        while todo:
            top = todo.pop()
            cost, rank, tail, origin, digest = self.tops[top]
            for x, role in ROLES.items():
                to = MOVES[top].get(x)
                if to is not None:
                    new = (cost + COST["I"], rank, tail + "I")
                    if to not in self.tops or new < self.tops[to][:3]:
                        self.tops[to] = (*new, origin, self._line(top, digest, role, ""))
                        todo.append(to)

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        best: dict[int, tuple] = {}

        def offer(to: int | None, cost: int, letter: str, top: int, line: str | None) -> None:
            old = self.tops[top]
            new = (old[0] + cost, old[1], old[2] + letter)
            if to is not None and (to not in best or new < best[to][:3]):
                best[to] = (*new, top, line)

        for top in self.tops:
            offer(top, COST["D"], "D", top, None)
            if not must_go:
                offer(MOVES[top].get(role[:1]), COST["K"] + TRUNCATED * truncated, "K", top, role)
                for x, other in ROLES.items():
                    offer(MOVES[top].get(x), COST["R"] + TRUNCATED * truncated, "R", top, other)
        rank = {x: i for i, x in enumerate(sorted((v[1], v[2]) for v in best.values()))}
        step, tops = bytearray(WIDTH), {}
        for to, (cost, r, tail, top, line) in best.items():
            old = self.tops[top]
            step[to] = (old[3] << 5) | ((len(tail) - 1) << 2) | "DKR".index(tail[-1])
            digest = old[4] if line is None else self._line(top, old[4], line, text)
            tops[to] = (cost, rank[r, tail], "", to, digest)
        self.back += step
        self.tops = tops
        self._insert()

    def end(self) -> tuple[int, str, str]:
        """``(cost, audit, digest)`` of the cheapest repair."""
        cost, _, tail, at, digest = min((v for k, v in self.tops.items() if ENDS[k]), key=lambda v: v[:3])
        out = bytearray(tail[::-1].encode())
        for i in range(len(self.back) - WIDTH, -1, -WIDTH):
            step = self.back[i + at]
            out += b"DKR"[step & 3:(step & 3) + 1] + b"I" * ((step >> 2) & 7)
            at = step >> 5
        return cost, out[::-1].decode(), digest.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row
    (kept here as ``gone``), 1 empties the text, 2 takes its sentence ends,
    3 repeats it, 4 makes it the user's."""
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("body", "[.!?]", ""))
            .otherwise(F.col("body")))
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 read("role").alias("who"), read("text").alias("body"), kind.alias("kind"))
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("who")).alias("role"),
                    text.alias("text"), (F.col("kind") == 0).alias("gone"),
                    F.explode(F.sequence(F.lit(0), (F.col("kind") == 3).cast("int"))).alias("copy")))


def undamaged(conversations: DataFrame) -> DataFrame:
    """Rows as they are, in the shape of ``damage``."""
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), read("role").alias("role"),
        read("text").alias("text"), F.lit(False).alias("gone"), F.lit(0).alias("copy"))


def _order(*first: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (*first, "turn", "role", "text", "copy")]


def faults(rows: DataFrame) -> DataFrame:
    """Each row with its first fault (``blank``, ``duplicate``, ``truncated``
    or null).  Rows move once, by conversation."""
    left = F.rtrim(F.col("text"), F.lit(SPACES))
    again = F.row_number().over(W.partitionBy("conv_id", "gone", "role", "text").orderBy(*_order()))
    return (rows.repartition("conv_id").withColumn("again", again)
            .select("conv_id", "turn", "role", "text", "gone", "copy",
                    F.when(left == "", "blank").when(F.col("again") > 1, "duplicate")
                    .when(~F.substring(left, -1, 1).isin(".", "!", "?"), "truncated").alias("fault")))


def parse(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (from ``faults``): its faults, the
    cheapest repair's cost and audit, and the digest of the repaired rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        conv, state, out = None, None, []

        def closed() -> tuple:
            cost, audit, digest = state["parse"].end()
            gaps = 0 if state["low"] is None else state["turn"] - state["low"] + 1 - state["turns"]
            return conv, gaps, state["blank"], state["duplicate"], state["truncated"], state["illegal"], cost, audit, digest

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for b in batches:
            for c, turn, role, text, gone, fault in zip(*[x.to_pylist() for x in b.columns]):
                if state is None or c != conv:
                    if state is not None:
                        out.append(closed())
                    conv, state = c, {"parse": Parse(), "low": None, "turn": None, "turns": 0, "blank": 0, "duplicate": 0,
                                      "truncated": 0, "illegal": 0, "role": None}
                if gone:
                    continue
                if turn is not None and turn != state["turn"]:
                    state["low"] = turn if state["low"] is None else state["low"]
                    state["turn"], state["turns"] = turn, state["turns"] + 1
                if fault:
                    state[fault] += 1
                if state["role"] is not None and state["role"] + role[:1] not in FOLLOWS:
                    state["illegal"] += 1
                state["role"] = role[:1]
                state["parse"].row(role, text, fault in ("blank", "duplicate"), fault == "truncated")
            if len(out) >= 500:
                yield batch()
                out.clear()
        if state is not None:
            out.append(closed())
        if out:
            yield batch()

    return (rows.sortWithinPartitions(*_order("conv_id"))
            .select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(run, RESULT))


def repair(rows: DataFrame) -> DataFrame:
    """Conversations of ``rows`` (from ``damage`` or ``undamaged``) summed up:
    faults, cost, audit and digest."""
    return parse(faults(rows))


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired rows themselves: ``conv_id, seq, edit, role, text``."""
    known = faults(rows)
    place = F.row_number().over(W.partitionBy("conv_id").orderBy(*_order()))
    taken = known.where("not gone").withColumn("place", place).select(
        F.col("conv_id").alias("c"), "place", F.col("role").alias("old"), "text")
    edits = (parse(known).select("conv_id", F.posexplode(F.split("audit", "")).alias("seq", "edit")).where("edit <> ''"))
    edits = edits.withColumn("place", F.sum(F.when(F.col("edit") == "I", 0).otherwise(1)).over(
        W.partitionBy("conv_id").orderBy("seq")))
    at = F.when(F.col("edit") != "I", F.col("edits.place"))
    both = (edits.alias("edits").withColumn("at", at)
            .join(taken.alias("t"), F.expr("conv_id <=> c and at = t.place"), "left")
            .where("edit <> 'D'"))
    system = (F.col("edit") == "K") & F.col("old").startswith("s")
    nth = F.sum(F.when(system, 0).otherwise(1)).over(W.partitionBy("conv_id").orderBy("seq"))
    return (both.withColumn("nth", nth)
            .select("conv_id", "seq", "edit",
                    F.when(F.col("edit") == "K", F.col("old")).when(F.col("nth") % 2 == 1, ROLES["u"])
                    .otherwise(ROLES["a"]).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text")))
