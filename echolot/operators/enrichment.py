"""Enrichment by rules: sentiment, topic labels and organisation of an issue.

Each enricher reads one row and adds one column, so as a rule none of them shuffles.
Only term tables too long for a lookup in the row go through a join on tokens; that form
reads its input twice, so give it a stage table.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Hashable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolot.config import UNCLEAR, IngestConfig
from echolot.functions.terms import INLINE_TERM_LIMIT, check_terms, checked_term, inline_hits, tokens
from echolot.functions.text import strip

_HITS = "_term_hits"
_TEXT_KEY = "_text_key"

# Term tables up to this size are sent to every executor.
BROADCAST_TERM_ROWS = 2_000_000
BROADCAST_TERM_BYTES = 64 * 1024 * 1024

# One to six capitalised words, or a lower-case one after an article or preposition, followed
# by a legal form that ends there.
LEGAL_FORMS = ("GmbH", "AG", "SE", "e.V.")
ARTICLES = "[Dd]er|[Dd]ie|[Dd]as|[Dd]em|[Dd]en|[Dd]es|[Vv]on|[Ff]ür|[Bb]ei"
CAPITALISED = r"[\p{Lu}\p{N}][\p{L}\p{N}&-]*"
ORGANISATION_PATTERN = (
    rf"(?:^|[^\p{{L}}\p{{N}}])(?:(?:{ARTICLES}) )?"
    rf"((?:{CAPITALISED}(?: (?:& )?{CAPITALISED}){{0,5}}?"
    rf"|(?<=(?:{ARTICLES}) )\p{{Ll}}[\p{{L}}\p{{N}}&-]*)"
    " (?:" + "|".join(map(re.escape, LEGAL_FORMS)) + r"))(?![\p{L}\p{N}])"
)

# The layout of the two prompts, after the instruction.
LABEL_PROMPT_HEAD = "\n\n\nLabels:\n{labels}\n\nIssue:\n"
ORG_PROMPT_TITLE = "\n\n\nTitel:\n"
ORG_PROMPT_TEXT = "\n\nInhalt:\n"

LABEL_INSTRUCTION = (
    "Ordne dem Beitrag die passenden Themen aus der Liste zu, höchstens fünf, durch Komma "
    "getrennt. Passt keines, antworte Unklar."
)
ORG_INSTRUCTION = (
    "Nenne die eine Organisation, für die der Beitrag spricht. Ist keine erkennbar, "
    "antworte Unklar."
)


def _clip(score: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))


def _lookup(hit: Column, groups: Mapping[Hashable, Sequence[str]], literal: Callable) -> Column:
    """The value whose words include the hit, else null.

    Catalyst looks a word up in a hash set per value, so this grows with the number of
    different values and not with the number of words.
    """
    chain = F
    for value, words in groups.items():
        chain = chain.when(hit.isin(list(words)), literal(value))
    return chain


# Both readings of the hits mention them once. Catalyst may copy an expression into a
# filter below, and every mention would search the text again there.


def _sentiment_of(text: Column, hits: Column, lexicon: Mapping[str, int]) -> Column:
    if not lexicon:
        return F.when(text.isNotNull(), F.lit(0.0))
    words_of = defaultdict(list)
    for word, weight in lexicon.items():
        words_of[weight].append(word)
    weights = F.array_compact(F.transform(hits, lambda hit: _lookup(hit, words_of, F.lit)))
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("n"))
    return F.aggregate(
        weights,
        zero,
        lambda sums, weight: F.struct(
            (sums["total"] + weight).alias("total"), (sums["n"] + 1).alias("n")
        ),
        lambda sums: F.when(sums["n"] == 0, F.lit(0.0)).otherwise(
            _clip(sums["total"] / sums["n"])
        ),
    )


def _labels_of(hits: Column, rules: Sequence[tuple[str, str]]) -> Column:
    none = F.array().cast("array<string>")
    if not rules:
        return none
    labels_of, words_of = defaultdict(set), defaultdict(list)
    for label, word in rules:
        labels_of[word].add(label)
    for word, labels in labels_of.items():
        words_of[tuple(sorted(labels))].append(word)

    def literal(labels: tuple[str, ...]) -> Column:
        return F.array(*map(F.lit, labels))

    found = F.transform(F.array_distinct(hits), lambda hit: _lookup(hit, words_of, literal))
    labels = F.array_sort(F.array_distinct(F.flatten(F.array_compact(found))))
    return F.coalesce(labels, none)


def _with_text_key(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn(_TEXT_KEY, F.sha2(F.col(text), 256))


def broadcast_if_small(
    terms: DataFrame,
    max_rows: int = BROADCAST_TERM_ROWS,
    max_bytes: int = BROADCAST_TERM_BYTES,
) -> DataFrame:
    """Mark a term table for broadcast after measuring all its rows and columns; a larger one stays as it is."""
    width = sum(
        (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(8) for name, kind in terms.dtypes),
        F.lit(0),
    )
    size = terms.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    small = size.rows <= max_rows and size.bytes <= max_bytes
    return F.broadcast(terms) if small else terms


def _series(text: Column, sizes: Sequence[int], distinct: bool) -> Column:
    """All series of so many consecutive tokens, as texts with one space between; the text is split once."""

    def of_size(words: Column, size: int) -> Column:
        if size == 1:
            return words
        if size == 2:  # no list for each place
            ahead = F.slice(words, F.lit(2), F.size(words))
            return F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), ahead, lambda a, b: F.concat(a, F.lit(" "), b))
        places = F.sequence(F.lit(1), F.size(words) - (size - 1))
        series = F.transform(places, lambda at: F.array_join(F.slice(words, at, size), " "))
        return F.when(F.size(words) >= size, series).otherwise(F.array().cast("array<string>"))

    def found(words: Column) -> Column:
        series = F.concat(*(of_size(words, size) for size in sizes))
        return F.array_distinct(series) if distinct else series

    return F.element_at(F.transform(F.array(tokens(text)), found), 1)


def _matched_terms(df: DataFrame, terms: DataFrame, text: str, key: str, distinct: bool = False) -> DataFrame:
    """One row per occurrence of a term, or per text and term: row key, text key and the term's columns.

    A term table of a checked size is broadcast, so the exploded tokens never move. A
    larger one is joined by shuffle, and AQE splits the frequent words. Phrases meet the text as a whole: it
    gives its series of tokens of each length that a term has, so no series meets terms that only begin alike.
    """
    terms = terms.withColumn("tok", checked_term(F.col("tok")))
    blanks = F.length("tok") - F.length(F.replace("tok", F.lit(" "), F.lit("")))
    sizes = sorted(row.size for row in terms.select((blanks + 1).alias("size")).distinct().collect() if row.size)
    keyed = _with_text_key(df.select(key, text), text)
    terms = broadcast_if_small(terms)
    series = keyed.where(F.col(text).isNotNull()).select(
        key, _TEXT_KEY, F.explode(_series(F.col(text), sizes or [1], distinct)).alias("tok")
    )
    return series.join(terms, "tok")


def _join_back(df: DataFrame, values: DataFrame, text: str, key: str) -> DataFrame:
    values = values.withColumnsRenamed({key: "_value_key", _TEXT_KEY: "_value_text"})
    same = F.col(key).eqNullSafe(F.col("_value_key")) & (F.col(_TEXT_KEY) == F.col("_value_text"))
    joined = _with_text_key(df, text).join(values, same, "left")
    return joined.drop(_TEXT_KEY, "_value_key", "_value_text")


def add_sentiment_scores(
    df: DataFrame,
    lexicon: Mapping[str, int] | DataFrame,
    text: str = "desc_clean",
    key: str = "iid",
) -> DataFrame:
    """Mean weight of the lexicon words in the text, within [-1, 1].

    Text without such words scores 0.0 and missing text null. A lexicon given as a
    DataFrame ``(tok, w)`` may have any size.
    """
    if not isinstance(lexicon, DataFrame):
        check_terms(lexicon)
        if len(lexicon) <= INLINE_TERM_LIMIT:
            scored = df.withColumn(_HITS, inline_hits(F.col(text), lexicon))
            score = _sentiment_of(F.col(text), F.col(_HITS), lexicon)
            return scored.withColumn("sentiment", score).drop(_HITS)
        lexicon = df.sparkSession.createDataFrame(list(lexicon.items()), "tok string, w int")
    matched = _matched_terms(df, lexicon, text, key)
    values = matched.groupBy(key, _TEXT_KEY).agg(
        _clip(F.sum("w") / F.count("w")).alias("sentiment")
    )
    score = F.when(F.col(text).isNotNull(), F.coalesce("sentiment", F.lit(0.0)))
    return _join_back(df, values, text, key).withColumn("sentiment", score)


def add_labels(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] | DataFrame,
    label_version: int = 1,
    text: str = "desc_clean",
    key: str = "iid",
) -> DataFrame:
    """Labels one of whose words occurs in the text, sorted and each once.

    Rules are pairs of label and word; a DataFrame ``(label, tok)`` may have any size.
    """
    name = f"labels_v{label_version}"
    if not isinstance(rules, DataFrame):
        words = check_terms(word for _, word in rules)
        if len(words) <= INLINE_TERM_LIMIT:
            found = df.withColumn(_HITS, inline_hits(F.col(text), words))
            return found.withColumn(name, _labels_of(F.col(_HITS), rules)).drop(_HITS)
        rules = df.sparkSession.createDataFrame(list(rules), "label string, tok string")
    matched = _matched_terms(df, rules, text, key, distinct=True)
    # A hash set of rows first: lists of more than a few texts at once would be made by sorting all matches.
    matched = matched.select(key, _TEXT_KEY, "label").distinct()
    values = matched.groupBy(key, _TEXT_KEY).agg(F.array_sort(F.collect_set("label")).alias(name))
    labels = F.coalesce(name, F.array().cast("array<string>"))
    return _join_back(df, values, text, key).withColumn(name, labels)


def organisation(title: Column, text: Column, unclear: str = UNCLEAR) -> Column:
    """First name with a legal form in title or text.

    Most texts hold no legal form, and a plain search tells so at half the cost of the
    expression.
    """
    whole = F.concat_ws("\n", title, text)
    mentioned = reduce(or_, (whole.contains(f" {form}") for form in LEGAL_FORMS))
    name = F.when(mentioned, F.regexp_extract(whole, ORGANISATION_PATTERN, 1))
    return F.coalesce(F.nullif(strip(name), F.lit("")), F.lit(unclear))


def add_organization_attribution(df: DataFrame, unclear: str = UNCLEAR) -> DataFrame:
    return df.withColumn("org", organisation(F.col("title"), F.col("desc_clean"), unclear))


def enrich(df: DataFrame, cfg: IngestConfig) -> DataFrame:
    """All three enrichers. Lexicon and label words share one pass over the text."""
    text = F.col("desc_clean")
    words = check_terms([*cfg.lexicon, *(word for _, word in cfg.label_rules)])
    if len(words) <= INLINE_TERM_LIMIT:
        hits = F.col(_HITS)
        df = (
            df.withColumn(_HITS, inline_hits(text, words))
            .withColumn("sentiment", _sentiment_of(text, hits, cfg.lexicon))
            .withColumn(cfg.label_column, _labels_of(hits, cfg.label_rules))
            .drop(_HITS)
        )
    else:
        df = add_sentiment_scores(df, cfg.lexicon)
        df = add_labels(df, cfg.label_rules, cfg.label_version)
    return add_organization_attribution(df, cfg.unclear)


def label_prompt(
    text: Column, labels: Sequence[str], instruction: str = LABEL_INSTRUCTION
) -> Column:
    """Prompt that asks a text model for the labels of an issue."""
    head = instruction + LABEL_PROMPT_HEAD.format(labels=", ".join(labels))
    return F.concat(F.lit(head), F.coalesce(text, F.lit("None")), F.lit("\n"))


def org_prompt(title: Column, text: Column, instruction: str = ORG_INSTRUCTION) -> Column:
    """Prompt that asks a text model for the organisation behind an issue."""
    return F.concat(
        F.lit(instruction + ORG_PROMPT_TITLE),
        F.coalesce(title, F.lit("None")),
        F.lit(ORG_PROMPT_TEXT),
        F.coalesce(text, F.lit("None")),
        F.lit("\n"),
    )


def build_prompts(
    df: DataFrame,
    labels: Sequence[str],
    label_instruction: str = LABEL_INSTRUCTION,
    org_instruction: str = ORG_INSTRUCTION,
) -> DataFrame:
    """Prompt columns for an offline inference job."""
    title, text = F.col("title"), F.col("desc_clean")
    return df.withColumns(
        {
            "label_prompt": label_prompt(text, labels, label_instruction),
            "org_prompt": org_prompt(title, text, org_instruction),
        }
    )


def pending(df: DataFrame, done: DataFrame, key: str = "iid") -> DataFrame:
    """Rows without an entry in the side table yet."""
    return df.join(done.select(key), key, "left_anti")


def assemble(df: DataFrame, *side_tables: DataFrame, key: str = "iid") -> DataFrame:
    """Join side tables ``(key, value)`` to the issues; missing values are null.

    A left join keeps the partitioning of its left side, and all joins use the same key,
    so the wide issues are shuffled once however many side tables follow.
    """
    return reduce(lambda left, right: left.join(right, key, "left"), side_tables, df)
