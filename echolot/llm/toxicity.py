"""Toxicity: weak supervision.

Voters are words of a small lexicon, patterns of writing, and words or word beginnings that occur mainly
in toxic training rows. A generative label model takes an unseen label behind the votes: each voter
fires with one rate for either label, rates come from expectation-maximisation that starts at the known
labels, which are themselves a voter of limited trust. Correlated voters (a word and its beginning)
share their weight: a voter counts ``1 / (1 + sum of its correlations given the label)``. A logistic
classifier on the occurrence of terms and patterns is trained on the posterior labels and scores all texts.

Term counts cover all training rows of a sample of at most ``MAX_ROWS`` labelled rows, chosen by
a hash of the id; the model has at most ``MAX_VOTERS`` voters and ``MAX_TERMS`` features. Everything
else, the scores included, covers all rows. Null and empty texts score as texts without any feature. If the
training rows lack one of the two labels, the lexicon and the patterns alone vote.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 40_000
MAX_VOTERS = 300
MAX_TERMS = 2_000
MIN_SUPPORT = 3
PREFIXES = (4, 5)
TRUST = 0.97
ROUNDS = 30
RIDGE = 1e-3
WORD = re.compile(r"[^\W\d_]+")

#: English insults that vote without any training.
LEXICON = (
    "asshole bastard bitch clown coward cretin crap damn disgusting dumb filth freak garbage hate "
    "idiot idiotic imbecile jerk kill liar loser moron pathetic pig rubbish scum shit slut stupid "
    "trash ugly useless vermin whore worthless"
).split()

#: Patterns that vote: name and expression.
PATTERNS = (
    ("!you", re.compile(r"\b(?:you|your|you're) (?:are |is )?(?:an? )?(?:" + "|".join(LEXICON) + r")s?\b", re.I)),
    ("!shout", re.compile(r"(?:\b[A-Z]{3,}\b[^\w\n]*){4,}|!{3,}")),
    ("!masked", re.compile(r"\b[A-Za-z]+[*@#$]{2,}[A-Za-z]+\b")),
)


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float
    voters: list[str]


def features(text: str | None) -> set[str]:
    """Terms of a text: words, word beginnings (marked ``~``) and patterns (marked ``!``)."""
    if not text:
        return set()
    words = set(WORD.findall(text.lower()))
    out = {f"{w[:n]}~" for n in PREFIXES for w in words if len(w) >= n}
    out |= words
    out.update(name for name, pattern in PATTERNS if pattern.search(text))
    return out


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of about ``MAX_ROWS`` labelled documents at most, chosen by a hash of the id.

    So many ids and labels are under 1 MB, a bound under which they may be broadcast to the texts.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)").distinct()
    total = known.count()
    if total > MAX_ROWS:
        kept = MAX_ROWS * 1_000_000 // total
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < kept)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): rows of the sample with a term, for terms of ``MIN_SUPPORT`` toxic rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                held[label].update(features(text))
            if len(held[0]) + len(held[1]) > 100_000:
                yield flush(held)
                held = (Counter(), Counter())
        yield flush(held)

    def flush(held: tuple[Counter, Counter]) -> pd.DataFrame:
        terms = list(held[0].keys() | held[1].keys())
        # Plain objects: a long column of pandas' own strings may reach Arrow in several chunks.
        return pd.DataFrame({"term": pd.Series(terms, dtype=object), "toxic": [held[1][t] for t in terms], "clean": [held[0][t] for t in terms]})

    parts = sample.mapInPandas(count, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_terms(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """The ``MAX_TERMS`` terms whose rates differ most, by a signed log-likelihood ratio."""
    if not toxic or not clean:
        return []
    rate_t, rate_c = (F.col("toxic") + 0.5) / (toxic + 1), (F.col("clean") + 0.5) / (clean + 1)
    gain = F.col("toxic") * F.log(rate_t / rate_c) - (F.col("toxic") * 0.1)
    strong = term_counts(sample).where(F.col("toxic") >= MIN_SUPPORT).withColumn("gain", gain)
    best = strong.where("gain > 0").orderBy(F.desc("gain"), "term").limit(MAX_TERMS)
    return [row["term"] for row in best.collect()]


def label_model(votes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Posterior of label 1 per row, from a rows x voters matrix of 0/1 votes and known labels.

    EM of a two-class latent model. Correlation of two voters is measured within the label that the
    posteriors give and lowers the weight of both.
    """
    if not len(votes):
        return np.empty(0)
    votes = votes.astype(np.float32)
    post = np.where(known == 1, TRUST, 1 - TRUST).astype(np.float64)
    weight = np.ones(votes.shape[1])
    for turn in range(ROUNDS):
        prior = np.clip(post.mean(), 1e-4, 1 - 1e-4)
        fire = (post @ votes + 0.1) / (post.sum() + 0.2), ((1 - post) @ votes + 0.1) / ((1 - post).sum() + 0.2)
        agree = np.clip([(post * (known == 1)).sum() / max(post.sum(), 1e-9),
                         ((1 - post) * (known == 1)).sum() / max((1 - post).sum(), 1e-9)],
                        1 - TRUST, TRUST)
        if turn % 10 == 0 and votes.shape[1]:
            centred = votes - np.outer(post, fire[0]) - np.outer(1 - post, fire[1])
            cover = centred.T @ centred
            spread = np.sqrt(np.maximum(np.diag(cover), 1e-9))
            related = np.maximum(0, cover / np.outer(spread, spread))
            weight = 1 / related.sum(axis=1)
        on = np.log(fire[0] / fire[1]) * weight
        off = np.log((1 - fire[0]) / (1 - fire[1])) * weight
        odds = np.log(prior / (1 - prior)) + votes @ (on - off) + off.sum()
        odds += np.where(known == 1, np.log(agree[0] / agree[1]), np.log((1 - agree[0]) / (1 - agree[1])))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post


def fit_linear(rows: list[np.ndarray], terms: int, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 features by Newton-scaled gradient steps (full batch)."""
    if not rows:
        return np.zeros(terms), 0.0
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.empty(0, np.int64)
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    weights, bias = np.zeros(terms), float(np.log(share / (1 - share)))
    seen = np.bincount(column, minlength=terms) + 1.0
    sums_g, bias_g = np.zeros(terms), 0.0
    for _ in range(300):
        odds = bias + np.bincount(owner, weights[column], len(target))
        error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
        slope = np.bincount(column, error[owner], terms) / seen + RIDGE * weights
        sums_g += slope**2
        bias_g += error.mean() ** 2
        weights -= 0.5 * slope / np.sqrt(sums_g + 1e-8)
        bias -= 0.1 * error.mean() / np.sqrt(bias_g + 1e-8)
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from the texts of ``docs`` and (doc_id, toxic) of ``labels``; nothing else is read."""
    sample = training_sample(docs, labels)
    counts = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    terms = choose_terms(sample, counts.get(1, 0), counts.get(0, 0))
    voters = list(dict.fromkeys([*LEXICON, *(name for name, _ in PATTERNS), *terms[:MAX_VOTERS]]))
    names = list(dict.fromkeys([*voters, *terms]))
    place = {name: i for i, name in enumerate(names)}

    def occur(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(place[t] for t in features(text) if t in place) for text in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "found": found})

    met = sample.mapInPandas(occur, "toxic int, found array<int>")
    met = met.groupBy("toxic", "found").count().orderBy("toxic", "found").collect()  # of the sample
    found = [np.asarray(row["found"], np.int64) for row in met for _ in range(row["count"])]
    known = np.repeat([row["toxic"] for row in met], [row["count"] for row in met]).astype(int)
    votes = np.zeros((len(found), len(voters)), np.float32)
    for i, at in enumerate(found):
        votes[i, at[at < len(voters)]] = 1
    weights, bias = fit_linear(found, len(names), label_model(votes, known))
    if not counts.get(1) or not counts.get(0):
        weights, bias = np.where(np.arange(len(names)) < len(LEXICON), 4.0, 0.5), -3.0
    used = {name: float(w) for name, w in zip(names, weights, strict=True) if w}
    return Model(used, float(bias), voters)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1; a column ``score`` of ``docs`` gives way to it."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias, _ = shared.value
        for batch in batches:
            odds = [bias + sum(sorted(weights[t] for t in features(v) if t in weights)) for v in batch]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.asarray(odds, float), -30, 30))))

    return docs.withColumn("score", run(text))
