"""License scans: template-markup matching.

A template is wording with two kinds of markup: ``[[...]]`` is optional, ``<<n>>`` stands for up to n words
of any wording. Each template compiles into a nondeterministic automaton over words. A text place is
accepted where the mandatory wording follows exactly; optional regions may be absent, replaceable
ones may hold anything up to their bound. All templates share one table of first words, so a
text without such a word costs only the split into words.

Words are runs of ASCII digits, letters (A-Z in lower case) and characters beyond ASCII. Null counts as
empty. Every row of the input gives one row; matches overlap freely and every place counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import text_or_empty


class Template(NamedTuple):
    label: str
    markup: str
    base: bool = False


#: Phrases without markup whose places are counted.
BASE = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

#: Wording of public licenses and of the notices that point to them.
TEMPLATES = (
    *BASE,
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<6>> software and associated documentation files the software to deal in the software without restriction"),
    Template("mit", "spdx license identifier mit"),
    Template("apache-2", "licensed under the apache license [[version]] 2 [[0]] [[the license]]"),
    Template("apache-2", "spdx license identifier apache 2 0"),
    Template("cc-by-nc", "creative commons attribution non commercial [[share alike]] [[<<2>> international]] license"),
    Template("cc-by-nc", "creative commons attribution noncommercial [[sharealike]] [[<<2>> international]] license"),
    Template("gpl-3", "gnu general public license [[as published by the free software foundation]] [[either]] version 3"),
    Template("gpl-3", "spdx license identifier gpl 3 0 [[or later]] [[only]]"),
    Template("gpl-2", "gnu general public license [[as published by the free software foundation]] [[either]] version 2"),
    Template("lgpl", "gnu lesser general public license [[as published by the free software foundation]] [[either]] version <<1>>"),
    Template("agpl-3", "gnu affero general public license [[as published by the free software foundation]] [[either]] version 3"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2", "mozilla public license [[<<1>> version]] 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)

_PLAIN = bytes(
    x if x > 127 or chr(x).isalnum() and not chr(x).isupper() else ord(chr(x).lower()) if chr(x).isalpha() else 32
    for x in range(256)
)
_PART = re.compile(r"\[\[|\]\]|<<(\d+)>>|([^\s\[\]<>]+)")


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


class Automaton:
    """States of all templates. ``edges[s]`` maps a word to the next state, ``jumps[s]`` lists states
    reached without a word, ``any[s]`` the state after a word of any kind (or -1). ``labels`` marks
    final states, ``done[s]`` is the share of mandatory words before a state."""

    def __init__(self, templates: tuple[Template, ...]) -> None:
        self.edges: list[dict[bytes, int]] = []
        self.jumps: list[list[int]] = []
        self.any: list[int] = []
        self.done: list[float] = []
        self.final: dict[int, Template] = {}
        self.first: dict[bytes, list[int]] = {}
        for template in templates:
            self._compile(template)

    def _state(self, done: float) -> int:
        self.edges.append({})
        self.jumps.append([])
        self.any.append(-1)
        self.done.append(done)
        return len(self.edges) - 1

    def _compile(self, template: Template) -> None:
        parts = list(_PART.finditer(template.markup))
        deep, needed = 0, 0
        for part in parts:
            deep += (part[0] == "[[") - (part[0] == "]]")
            needed += bool(part[2]) and not deep
        start = at = self._state(0.0)
        opened: list[int] = []
        seen = 0
        for part in parts:
            if part[0] == "[[":
                opened.append(at)
            elif part[0] == "]]":
                end = self._state(seen / needed)
                self.jumps[at].append(end)
                self.jumps[opened.pop()].append(end)
                at = end
            elif part[1]:
                end = self._state(seen / needed)
                for _ in range(int(part[1])):
                    self.jumps[at].append(end)
                    self.any[at] = self._state(seen / needed)
                    at = self.any[at]
                self.jumps[at].append(end)
                at = end
            else:
                seen += not opened
                after = self._state(seen / needed)
                self.edges[at][part[2].encode()] = after
                at = after
        self.final[at] = template
        for state in self._closed({start}):
            for word in self.edges[state]:
                self.first.setdefault(word, []).append(start)

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for state in self.jumps[todo.pop()]:
                if state not in states:
                    states.add(state)
                    todo.append(state)
        return states

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, Template]], float]:
        """Accepted (start, template) and the largest share of mandatory words met in order."""
        found, best = [], 0.0
        if self.first.keys().isdisjoint(words):
            return found, best
        for i, word in enumerate(words):
            for start in self.first.get(word, ()):
                states, accepted = self._closed({start}), set()
                for k in range(i, len(words)):
                    step = {self.edges[s][words[k]] for s in states if words[k] in self.edges[s]}
                    step |= {self.any[s] for s in states if self.any[s] >= 0}
                    states = self._closed(step)
                    if not states:
                        break
                    accepted |= states & self.final.keys()
                    best = max(best, *(self.done[s] for s in states))
                found += [(i, self.final[s]) for s in sorted(accepted)]
        return found, best


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, matches, score); matches are (label, base, start) by start, label.

    ``score`` is 1 where a template is accepted, else the largest share of a template's mandatory
    words that the text meets in order.
    """

    @F.pandas_udf("n_words long, matches array<struct<label:string,base:boolean,start:long>>, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(templates)
        for batch in batches:
            out = []
            for text in batch:
                words = split_words(text)
                found, best = automaton.matches(words)
                spans = sorted((i, t.label, t.base) for i, t in found)
                out.append((len(words), [(label, base, i) for i, label, base in spans], best))
            yield pd.DataFrame(out, columns=["n_words", "matches", "score"])

    rows = docs.select("doc_id", run(text_or_empty()).alias("_m"))
    return rows.select("doc_id", "_m.*")


def report(docs: DataFrame) -> DataFrame:
    """Counts and places of the base phrases, and the labels of all templates."""
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    labels = lambda m: F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))), ",")
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        "score",
    )
