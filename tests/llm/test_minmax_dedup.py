"""Min-max near-duplicate classes against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from echolot.llm import common, minmax_dedup, ngram_join
from echolot.llm.ngram_join import Shingler
from echolot.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\v\f\r"


def shingle_set(text, width):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in BLANK:
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width=2, percent=80):
    sets = [shingle_set(text, width) for _, text in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (low.get(root(i)), doc) if x is not None]
        low[root(i)] = min(known, default=None)
    out = []
    for i, (doc, _) in enumerate(rows):
        component = low[root(i)] if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op12_minmax_dedup"](spark, SF).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_edges(spark):
    """Nulls, empty and very long texts, repeated rows, clashing names, an empty table."""
    long_text = " ".join(f"w{i}" for i in range(40_000))
    rows = [
        (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "A  b\tC"), (None, "a b c"), (None, "lonely words here"),
        (5, "one"), (6, "One"), (7, " \n"), (8, long_text), (9, long_text + " end"),
    ]
    df = spark.createDataFrame([(*r, 1, True, 5) for r in rows], "doc_id long, text string, n int, kept boolean, tokens int")
    got = [tuple(r) for r in minmax_dedup.dedupe(df).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert minmax_dedup.dedupe(df.limit(0)).count() == 0


@pytest.mark.parametrize("edits", [6, 14, 26])
def test_a_group_of_near_copies_around_the_limit(spark, edits):
    """Copies of one text of which many are just not similar enough to each other."""
    draw = random.Random(edits)
    base = [f"w{draw.randrange(10_000)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        words = list(base)
        for _ in range(draw.randrange(edits)):
            words[draw.randrange(len(words))] = draw.choice(["x", "y", "z"]) + str(draw.randrange(5))
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in minmax_dedup.dedupe(df).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_likeness_is_unbiased_and_varies_like_as_many_minima():
    minmax, shingles = minmax_dedup.MinMax(), Shingler(2)
    draw = random.Random(1)
    errors = []
    for _ in range(200):
        words = [f"w{draw.randrange(10**6)}" for _ in range(300)]
        other = words[:240] + [f"v{draw.randrange(10**6)}" for _ in range(60)]
        a, b = shingles(" ".join(words)), shingles(" ".join(other))
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(minmax_dedup.likeness(minmax.signature(a), minmax.signature(b)) - truth)
    independent = (truth * (1 - truth) / (2 * minmax_dedup.BANDS * minmax_dedup.ROWS)) ** 0.5
    assert abs(np.mean(errors)) < 4 * independent / len(errors) ** 0.5
    assert np.std(errors) < 1.2 * independent


def test_written_stages_go_when_they_were_read(spark, tmp_path, monkeypatch):
    made = []

    def path(spark, name):
        made.append(name)
        return f"{tmp_path}/{name}-{len(made)}"

    monkeypatch.setattr(common, "scratch_path", path)
    rows = [(i, f"same words in {i % 7} groups of rows here") for i in range(50)]
    assert minmax_dedup.dedupe(spark.createDataFrame(rows, "doc_id long, text string")).count() == 50
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert {"bands", "postings", "texts"} <= set(made)
    assert not left & {"bands", "banded-nodes", "postings", "labelled", "open-postings", "wanted", "texts", "pairs"}


def test_near_copies_that_are_not_similar_make_few_pairs(spark, monkeypatch):
    """Copies that lack many of the same shingles meet by the rare ones that they have of their own."""
    met = {}
    plain = ngram_join.staged

    def counted(df, name):
        table = plain(df, name)
        met.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(ngram_join, "staged", counted)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 200):
        words = list(base)
        for k in [*range(4, 16, 4), *draw.sample(range(20, 120), draw.randrange(4, 9))]:
            words[k] = f"x{draw.randrange(4)}" if k % 3 else f"{i}y{k}"
        rows.append((i, " ".join(words)))
    got = [tuple(r) for r in minmax_dedup.dedupe(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert met["differences"][0] > 100 and sum(met["anchored-pairs"]) < 50
