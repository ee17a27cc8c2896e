"""Conversation structure repair by the auction shortest-path algorithm.

The repairs of a conversation are the paths through a lattice: a node is a number of rows done and a state of
the wanted role order ``(s?(ua)+)?``, an arc is an edit with its cost. A path is extended from the origin to the
best next node or contracted from its end, whose price then rises to its best arc; prices never exceed
the cost that is left and differ along the path by just the arcs' costs. When the path arrives, all cheapest
repairs run on tight arcs, those whose cost is the difference of the prices. The audit follows them from the origin,
the ASCII-least letter first, over nodes from which tight arcs lead to the end. In any state a letter leads to
one state only, so the audit determines the repair.

A long run of rows is cut into segments of ``SEGMENT`` rows. The auction gives each segment's costs from every
state to every state; sums of minima over the segments give the prices at their ends, and each segment is
then traced by itself.

Conversations of up to ``LONG`` rows and ``LONG_CHARS`` characters are solved where a shuffle by ``conv_id`` brings
their rows together. Longer ones are sorted by range over many tasks and cut into chunks there; rows seen in earlier chunks are told
by digests, chunks get their costs in parallel, and only the chunks' cost tables come together. The split changes
the path of the rows, not the result. Equal rows travel as one row with a count.

Nulls in ``role``, ``text``, ``conv_id`` or ``turn`` are one space in the damage and its key; a null ``conv_id`` is one
conversation, null turns come first and count for no gap. Rows of one turn are ordered by role and text. A role without
characters has no initial and is never kept. Very long texts are read once; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import discard, staged

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ENDS = (0, None, None, 0)  # what the end costs in each state; None where the order may not end
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = (USER, USER, ASSISTANT, USER)  # the state that an inserted or reroled row leads to
ROLE = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SEGMENT = 16
LONG = 2_000
LONG_CHARS = 4_000_000
CHUNK = 4_000
CHUNK_CHARS = 4_000_000


class Step(NamedTuple):
    """What the auction needs of a row: its role's initial, whether it must go, whether it is truncated."""

    initial: str
    must_go: bool
    truncated: bool


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after damage, equal ones as one."""
    words = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(words["conv_id"], F.lit(":"), words["turn"])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(words["text"], "[.!?]", "")).otherwise(words["text"])
    after = rows.where(kind != 0).select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(words["role"]).alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
    return after.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def arcs(steps: list[Step], goal: tuple, at: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows done, state) of each edit, by letter; the end is the node behind the last row."""
    found = []
    if at < len(steps):
        step = steps[at]
        found.append(("D", DELETE, at + 1, state))
    found.append(("I", INSERT, at, WANTED[state]))
    if at == len(steps):
        return found + ([("", goal[state], at + 1, START)] if goal[state] is not None else [])
    if not step.must_go:
        cost = TRUNCATED if step.truncated else 0
        if (state, step.initial) in FOLLOWS:
            found.append(("K", cost, at + 1, FOLLOWS[state, step.initial]))
        found.append(("R", REROLE + cost, at + 1, WANTED[state]))
    return found


class Auction:
    """Prices of the lattice of some rows for one goal. Runs from several origins share the prices."""

    def __init__(self, steps: list[Step], goal: tuple) -> None:
        self.steps, self.goal = steps, goal
        self.cache: dict = {}
        # Costs that no repair avoids are prices that every arc allows.
        left, self.price = 0, {(len(steps) + 1, START): 0}
        for at in range(len(steps), -1, -1):
            if at < len(steps):
                left += DELETE if steps[at].must_go else min(DELETE, TRUNCATED * steps[at].truncated)
            self.price |= {(at, state): left for state in STATES}
        # No path costs more than to delete all rows and to insert up to the last state.
        self.bound = (DELETE + TRUNCATED) * len(steps) + 3 * INSERT + max(x for x in (*goal, 0) if x is not None)

    def arcs(self, node: tuple[int, int]) -> list:
        if node not in self.cache:
            self.cache[node] = arcs(self.steps, self.goal, *node)
        return self.cache[node]

    def cost(self, state: int) -> int | None:
        """The least cost from a state before the first row to the goal, by path extension and contraction."""
        price, origin, end = self.price, (0, state), (len(self.steps) + 1, START)
        path = [origin]
        while path[-1] != end:
            node = path[-1]
            best, after = None, None
            for _, cost, at, to in self.arcs(node):
                value = cost + price[at, to]
                if best is None or value < best:
                    best, after = value, (at, to)
            if price[node] < best:
                price[node] = best
                if best > self.bound:
                    return None
                if node != origin:
                    path.pop()
            else:
                path.append(after)
        return price[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """The ASCII-least cheapest edits from a state, and the state before the end. ``cost`` comes first."""
        end = (len(self.steps) + 1, START)
        leads: dict[tuple[int, int], bool] = {end: True}

        def tight(node: tuple[int, int]) -> list:
            return [(x, at, to) for x, cost, at, to in self.arcs(node) if self.price[node] == cost + self.price[at, to]]

        for at in range(len(self.steps), -1, -1):
            open_nodes = [(at, s) for s in STATES]
            for _ in STATES:  # insertions lead to nodes of the same row
                for node in open_nodes:
                    if not leads.get(node):
                        leads[node] = any(leads.get((i, to)) for _, i, to in tight(node))
        node, letters = (0, state), []
        while node[0] <= len(self.steps):
            letter, at, to = min(x for x in tight(node) if leads.get((x[1], x[2])))
            letters.append(letter)
            node, last = (at, to), node[1]
        return "".join(letters), last


def plus(a: int | None, b: int | None) -> int | None:
    return None if a is None or b is None else a + b


def least(values) -> int | None:
    return min((x for x in values if x is not None), default=None)


def leads(steps: list[Step], a: int, b: int) -> bool:
    """Whether some edits of the rows lead from a state to another: the two first states are left for good."""
    if (a, b) == (START, SYSTEM):
        return any(step.initial == "s" and not step.must_go for step in steps)
    return a == b or b >= USER


def costs(steps: list[Step]) -> list[list]:
    """Least costs from each state before the rows to each state behind them; None where there is no way."""
    table: list[list] = [[0 if a == b else None for b in STATES] for a in STATES]
    for at in range(0, len(steps), SEGMENT):
        part = steps[at : at + SEGMENT]
        runs = [Auction(part, tuple(0 if s == b else None for s in STATES)) for b in STATES]
        own = [[runs[b].cost(a) if leads(part, a, b) else None for b in STATES] for a in STATES]
        table = [[least(plus(table[a][k], own[k][b]) for k in STATES) for b in STATES] for a in STATES]
    return table


def prices_before(table: list[list], goal: tuple) -> tuple:
    return tuple(least(plus(table[a][b], goal[b]) for b in STATES) for a in STATES)


def repair(steps: list[Step], state: int, goal: tuple) -> tuple[str, int, int]:
    """(edits, state behind them, cost) of the cheapest repair from a state; ``goal`` prices the states behind."""
    parts = [steps[at : at + SEGMENT] for at in range(0, len(steps), SEGMENT)] or [[]]
    goals = [goal]
    for part in parts[:0:-1]:
        goals.append(prices_before(costs(part), goals[-1]))
    letters, total = [], None
    for part, own in zip(parts, reversed(goals), strict=True):
        auction = Auction(part, own)
        cost = auction.cost(state)
        total = cost if total is None else total
        edits, state = auction.trace(state)
        letters.append(edits)
    return "".join(letters), state, total


def result_lines(edits: str, rows: list[tuple[str, str]], state: int) -> Iterator[str]:
    """The repaired conversation, ``role:text`` each."""
    at = 0
    for edit in edits:
        if edit == "I":
            state = WANTED[state]
            yield f"{ROLE[state]}:"
            continue
        role, text = rows[at]
        at += 1
        if edit == "K":
            state = FOLLOWS[state, role[:1]]
            yield f"{role}:{text}"
        elif edit == "R":
            state = WANTED[state]
            yield f"{ROLE[state]}:{text}"


def content_digest(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


BLANKS = " \t\n\v\f\r"


class Chunk:
    """Rows (role, text, copies) in order, and what they tell apart from their neighbours."""

    def __init__(self, rows: list[tuple[str, str, int]], seen: set[bytes]) -> None:
        self.rows: list[tuple[str, str]] = []
        self.steps: list[Step] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        for role, text, copies in rows:
            body = text.rstrip(BLANKS)
            key = content_digest(role, text)
            for _ in range(copies):
                must_go = not body or key in seen
                cut = not must_go and body[-1] not in ".!?"
                self.blank += not body
                self.duplicate += bool(body) and key in seen
                self.truncated += cut
                seen.add(key)
                self.rows.append((role, text))
                self.steps.append(Step(role[:1], must_go, cut))
        initials = [step.initial for step in self.steps]
        self.illegal = sum(illegal_pair(a, b) for a, b in zip(initials, initials[1:], strict=False))


def illegal_pair(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, Iterator]]:
    """Runs of rows with equal keys over the batches of a sorted partition, one after another."""
    from itertools import groupby

    def flat() -> Iterator:
        for batch in batches:
            known = batch.astype(object).where(batch.notna(), None)
            yield from known.itertuples(index=False)

    yield from groupby(flat(), key=lambda row: tuple(getattr(row, k) for k in keys))


COLUMNS = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def short_repairs(rows: DataFrame) -> DataFrame:
    """Repairs of conversations whose rows one task may hold, one at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for (conv,), group in _groups(batches, ["conv"]):
            chunk = Chunk([(row.role, row.text, row.copies) for row in group], set())
            edits, _, cost = repair(chunk.steps, START, ENDS)
            text = "\n".join(result_lines(edits, chunk.rows, START))
            digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((conv, chunk.blank, chunk.duplicate, chunk.truncated, chunk.illegal, cost, edits, digest))
            if len(out) >= 5_000:
                yield pd.DataFrame(out, columns=COLUMNS)
                out = []
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.select(F.col("conv_id").cast("string").alias("conv"), "role", "text", "copies").mapInPandas(run, SCHEMA)


def chunks_of(rows: DataFrame) -> DataFrame:
    """(conv, part, seq, rows): long conversations in order, cut where a task or a chunk is full; a written table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq = TaskContext.get().partitionId(), 0

        def frame(conv: str, held: list) -> pd.DataFrame:
            return pd.DataFrame([(conv, part, seq, held)], columns=["conv", "part", "seq", "rows"])

        for (conv,), group in _groups(batches, ["conv"]):
            held, chars, n = [], 0, 0
            for row in group:
                left = row.copies
                while left:  # a row of many copies may fill several chunks
                    take = min(left, CHUNK - n)
                    held.append({"role": row.role, "text": row.text, "copies": take})
                    left, n, chars = left - take, n + take, chars + len(row.text)
                    if n >= CHUNK or chars >= CHUNK_CHARS:
                        yield frame(conv, held)
                        held, chars, n, seq = [], 0, 0, seq + 1
            if held:
                yield frame(conv, held)
                seq += 1

    # Equal first characters stay in one task; the sort there decides by the whole text.
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role")]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    dealt = dealt.select(F.col("conv_id").cast("string").alias("conv"), "role", "text", "copies")
    return staged(
        dealt.mapInPandas(run, "conv string, part int, seq int, rows array<struct<role:string,text:string,copies:long>>"),
        "dialogue-chunks",
    )


def _rows_of(rows) -> list[tuple[str, str, int]]:
    return [(row["role"], row["text"], row["copies"]) for row in rows]


def long_repairs(rows: DataFrame) -> DataFrame:
    """Repairs of conversations of any length; no task holds more than a chunk of rows or a conversation's cost tables."""
    chunks = chunks_of(rows)
    key = ["conv", "part", "seq"]

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                own = sorted({content_digest(r["role"], r["text"]) for r in row.rows})
                yield pd.DataFrame({"conv": row.conv, "part": row.part, "seq": row.seq, "digest": own})

    seen = chunks.mapInPandas(digests, "conv string, part int, seq int, digest binary")
    first = seen.groupBy("conv", "digest").agg(F.min(F.struct("part", "seq")).alias("first"))
    later = first.withColumnsRenamed({"conv": "_conv", "digest": "_digest"})
    again = seen.join(later, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")))
    again = again.where(F.struct("part", "seq") > F.col("first"))
    known = again.groupBy(*key).agg(F.collect_list("digest").alias("known"))  # as many as a chunk has rows, at most
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}")) for k in key]
    joined = chunks.alias("c").join(known.alias("o"), same[0] & same[1] & same[2], "left")
    flagged = staged(joined.select("c.*", F.coalesce("o.known", F.array().cast("array<binary>")).alias("known")), "dialogue-flagged")
    discard(chunks)

    def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                chunk = Chunk(_rows_of(row.rows), set(row.known))
                flat = [-1 if x is None else x for line in costs(chunk.steps) for x in line]
                ends = chunk.steps[0].initial, chunk.steps[-1].initial
                counts = (chunk.blank, chunk.duplicate, chunk.truncated, chunk.illegal)
                yield pd.DataFrame([(row.conv, row.part, row.seq, *counts, *ends, flat)], columns=names)

    names = [*key, "blank", "duplicate", "truncated", "illegal", "initial", "final", "costs"]
    summary = flagged.mapInPandas(
        summaries,
        "conv string, part int, seq int, blank long, duplicate long, truncated long, illegal long, initial string, final string, costs array<long>",
    )

    def priced(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "seq"]).reset_index(drop=True)
        tables = [np.asarray(flat).reshape(4, 4).tolist() for flat in group["costs"]]
        tables = [[[None if x < 0 else x for x in line] for line in table] for table in tables]
        goals = [ENDS]
        for table in tables[::-1]:
            goals.append(prices_before(table, goals[-1]))
        met = sum(illegal_pair(a, b) for a, b in zip(group["final"], group["initial"][1:], strict=False))
        group["illegal_all"] = group["illegal"].sum() + met
        group["cost"] = goals[-1][START]
        for name in ("blank", "duplicate", "truncated"):
            group[name] = group[name].sum()
        group["goal"] = [[-1 if x is None else x for x in goal] for goal in goals[-2::-1]]
        return group[["conv", "part", "seq", "blank", "duplicate", "truncated", "illegal_all", "cost", "goal"]]

    prices = summary.groupBy("conv").applyInPandas(
        priced,
        "conv string, part int, seq int, blank long, duplicate long, truncated long, illegal_all long, cost long, goal array<long>",
    )
    prices = staged(prices.withColumnRenamed("illegal_all", "illegal"), "dialogue-prices")
    with_goals = flagged.alias("c").join(prices.alias("o"), same[0] & same[1] & same[2])
    with_goals = with_goals.select("c.*", "o.goal", "o.blank", "o.duplicate", "o.truncated", "o.illegal", "o.cost")

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Edits from each state that the chunk before may end in."""
        for batch in batches:
            for row in batch.itertuples(index=False):
                chunk = Chunk(_rows_of(row.rows), set(row.known))
                goal = tuple(None if x < 0 else int(x) for x in row.goal)
                before = prices_before(costs(chunk.steps), goal)
                found = [repair(chunk.steps, s, goal) if before[s] is not None else ("", 0, 0) for s in STATES]
                lines = ["\n".join(result_lines(x[0], chunk.rows, s)).encode("utf-8", "surrogatepass") for s, x in zip(STATES, found, strict=True)]
                some = [any(e != "D" for e in x[0]) for x in found]
                yield pd.DataFrame(
                    [(row.conv, row.part, row.seq, [x[0] for x in found], [x[1] for x in found], lines, some,
                      row.blank, row.duplicate, row.truncated, row.illegal, row.cost)],
                    columns=[*key, "edits", "state", "lines", "some", *COLUMNS[1:6]],
                )

    pieces = staged(
        with_goals.mapInPandas(
            traced,
            "conv string, part int, seq int, edits array<string>, state array<int>, lines array<binary>, some array<boolean>, "
            "blank long, duplicate long, truncated long, illegal long, cost long",
        ),
        "dialogue-pieces",
    )
    discard(flagged, prices)

    def joined_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (conv,), group in _groups(batches, ["conv"]):
            state, audit, digest, begun = START, [], hashlib.sha256(), False
            for row in group:
                audit.append(row.edits[state])
                if row.some[state]:
                    if begun:
                        digest.update(b"\n")
                    digest.update(row.lines[state])
                    begun = True
                state = int(row.state[state])
            counts = (row.blank, row.duplicate, row.truncated, row.illegal, row.cost)
            yield pd.DataFrame([(conv, *counts, "".join(audit), digest.hexdigest())], columns=COLUMNS)

    return pieces.repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInPandas(joined_up, SCHEMA)


def report(rows: DataFrame, long_rows: int = LONG) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    after = staged(damaged(rows.select("conv_id", "turn", "role", "text")), "damaged")
    kept = after.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("gaps"),
        ((F.sum("copies") > long_rows) | (F.sum(F.length("text")) > LONG_CHARS)).alias("long"),
    )
    every = rows.select("conv_id").distinct().withColumnRenamed("conv_id", "_id")
    about = staged(every.join(kept, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id"), "dialogues")
    longer = about.where("long").select("_id")
    is_long = F.col("conv_id").eqNullSafe(F.col("_id"))
    done = short_repairs(after.join(longer, is_long, "left_anti"))
    if not longer.isEmpty():
        done = done.unionByName(long_repairs(after.join(longer, is_long, "left_semi")))
    kind = rows.schema["conv_id"].dataType
    found = about.join(done, F.col("_id").cast("string").eqNullSafe(F.col("conv")), "left")
    zero = F.lit(0).cast("long")
    return found.select(
        F.col("_id").cast(kind).alias("conv_id"),
        *[F.coalesce(name, zero).alias(name) for name in ("gaps", *COLUMNS[1:6])],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
