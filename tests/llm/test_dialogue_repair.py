"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from echolot.llm import dialogue_repair
from echolot.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def after_damage(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        own = found[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for own in found.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return found


def cheapest(rows, faults):
    """(cost, audit, lines) by search over all edits, with at most three insertions in a row."""
    order = re.compile("(s?(ua)+)?")

    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    memo = {}

    def search(at, kept, inserted):
        key = at, kept, inserted
        if key in memo:
            return memo[key]
        options = []
        if at == len(rows) and kept in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            new = "assistant" if kept == "u" else "user"
            found = search(at, new[0], inserted + 1)
            if found:
                options.append((2 + found[0], "I" + found[1], (f"{new}:",) + found[2]))
        if at < len(rows):
            _, role, text = rows[at]
            steps = [("D", 3, kept, ())]
            if faults[at] != 1:
                extra = int(faults[at] == 2)
                if role[:1] and role[:1] in after[kept]:
                    steps.append(("K", extra, role[:1], (f"{role}:{text}",)))
                new = "assistant" if kept == "u" else "user"
                steps.append(("R", 2 + extra, new[0], (f"{new}:{text}",)))
            for letter, cost, to, line in steps:
                found = search(at + 1, to, 0)
                if found:
                    options.append((cost + found[0], letter + found[1], line + found[2]))
        memo[key] = min(options, key=lambda x: x[:2]) if options else None
        return memo[key]

    for at in range(len(rows), -1, -1):  # from the end, so that the recursion stays flat
        for kept in ("", "s", "u", "a"):
            for inserted in (3, 2, 1, 0):
                search(at, kept, inserted)
    best = search(0, "", 0)
    assert order.fullmatch("".join(line[0] for line in best[2]))
    return best


def brute(rows):
    damaged = after_damage(rows)
    out = []
    for conv in {r[0] for r in rows}:
        own = damaged.get(conv, [])
        turns = {r[0] for r in own if r[0] is not None}
        seen, faults, counts = set(), [], [0, 0, 0, 0]
        for _, role, text in own:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not marks else 1 if (role, text) in seen else 2 if marks[-1] not in ".!?" else 3
            counts[fault] += 1
            faults.append(1 if fault < 2 else 2 if fault == 2 else 0)
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, lines = cheapest(own, faults)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts[:3], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def result(df, **options):
    return sorted((tuple(r) for r in dialogue_repair.report(df, **options).collect()), key=repr)


def test_query_equals_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_dialogue_repair"](spark, SF)
    assert got.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


@pytest.fixture(scope="module")
def untidy(spark):
    """Nulls, empty texts and roles, other roles, equal rows, ties in a turn, one hot conversation."""
    draw = random.Random(3)
    rows = []
    for conv in [*range(40), None]:
        for i in range(draw.choice([1, 3, 8, 30]) if conv else 150):
            turn = draw.choice([i, i, i, draw.randrange(10), None, i + 50])
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = draw.choice(["Hi.", "Ok", "  ", "", "a b!", "x?  ", "end\v\f", None, f"text {i}.", f"t {i}"])
            rows.append((conv, turn, role, text))
    return rows + [(99, 5, "user", "The same."), (99, 5, "user", "The same.")] * 20 + [(7, 10**12, "user", "y" * 300_000)]


def test_untidy_rows(spark, untidy):
    extra = "cost int, audit string, copies int"
    df = spark.createDataFrame([(*r, 1, "a", 2) for r in untidy], f"{SCHEMA}, {extra}")
    assert result(df) == brute(untidy)
    assert result(df.limit(0)) == []


def test_long_conversations_are_split_without_a_trace(spark, untidy, monkeypatch):
    monkeypatch.setattr(dialogue_repair, "CHUNK", 5)
    monkeypatch.setattr(dialogue_repair, "SEGMENT", 3)
    df = spark.createDataFrame(untidy, SCHEMA).repartition(7)
    assert result(df, long_rows=4) == brute(untidy)


def test_prices_are_dual_feasible_and_tight_on_the_path():
    draw = random.Random(5)
    for _ in range(200):
        steps = [
            dialogue_repair.Step(draw.choice("suax"), draw.random() < 0.2, draw.random() < 0.3)
            for _ in range(draw.randrange(12))
        ]
        auction = dialogue_repair.Auction(steps, dialogue_repair.ENDS)
        cost = auction.cost(dialogue_repair.START)
        for node in [(at, s) for at in range(len(steps) + 1) for s in dialogue_repair.STATES]:
            assert all(auction.price[node] <= c + auction.price[at, to] for _, c, at, to in auction.arcs(node))
        edits, last = auction.trace(dialogue_repair.START)
        paid = {"D": 3, "I": 2, "K": 0, "R": 2}
        kept = [steps[i] for i, e in enumerate(e for e in edits if e != "I") if e in "KR"]
        assert cost == sum(paid[e] for e in edits) + sum(step.truncated for step in kept)
        assert dialogue_repair.ENDS[last] == 0
