"""Language ID: multilingual mixture inference.

Per language, the training texts give smoothed probabilities of letter n-grams (byte trigrams in
``2 ** BITS`` hash slots, with everything but letters as a space). A document is a mixture of
these languages and of a background in which all slots are equally likely; expectation-maximisation
estimates its proportions. The language set is the one with the best penalised likelihood among the
sets of the m most likely components: ``log L - PENALTY * m * log n``.

The model has ``2 ** BITS`` counts per language, whatever the input, and is counted over all
training rows in one pass. Texts that are null or have no letter are ``und`` with score 0; so is
everything if no language was learned. Repeated rows get equal answers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import BATCH_CONF
from echolot.session import settings

BITS = 16
SMOOTH = 0.5
ROUNDS = 12
PENALTY = 3.0
CHUNK_BYTES = 400_000
BLOCK = 4096
LETTER = re.compile(r"[^\W\d_]")
#: Everything of ASCII but letters becomes a space, letters lower case.
PLAIN = bytes(
    x if x > 127 else ord(chr(x).lower()) if chr(x).isalpha() else 32 for x in range(256)
)

MIXTURE = "_mixture"  # the results while they are one column


class Model(NamedTuple):
    languages: list[str]
    logs: np.ndarray  # slots x (languages + background), float32 probabilities


def slots(text: str) -> np.ndarray:
    """Hash slots of the n-grams of a text; runs of spaces count as one."""
    b = np.frombuffer(b" " + text.encode("utf-8", "surrogatepass").translate(PLAIN) + b" ", np.uint8)
    b = b[(b != 32) | np.append(True, b[:-1] != 32)]
    x = b.astype(np.uint32)
    h = x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)
    return (h * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def fit(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows with a text and a language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"], strict=True):
                if name not in total:
                    total[name] = np.zeros(2**BITS, np.int64)
                h = slots(value)
                if len(h) < 2000:
                    np.add.at(total[name], h, 1)
                else:
                    total[name] += np.bincount(h, minlength=2**BITS)
        for name, counts in total.items():
            for i, block in enumerate(counts.reshape(-1, BLOCK)):
                yield pd.DataFrame({"lang": [name], "block": [i], "counts": [block.tobytes()]})

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BLOCK, np.int64)
        for part in parts:
            for counts in part["counts"]:
                total += np.frombuffer(counts, np.int64)
        yield pd.DataFrame({"lang": [key[0]], "block": [key[1]], "counts": [total.tobytes()]})

    schema = "lang string, block int, counts binary"
    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    with settings(rows.sparkSession, BATCH_CONF):
        counted = known.mapInPandas(count, schema).groupBy("lang", "block").applyInPandas(add, schema).collect()
    languages = sorted({row["lang"] for row in counted})
    table = np.zeros((2**BITS, len(languages) + 1))
    for row in counted:
        at = row["block"] * BLOCK
        table[at : at + BLOCK, languages.index(row["lang"])] = np.frombuffer(row["counts"], np.int64)
    table += SMOOTH
    return Model(languages, (table / table.sum(axis=0)).astype(np.float32))


def _mixtures(p: np.ndarray, counts: np.ndarray, starts: np.ndarray, doc: np.ndarray, allowed: np.ndarray):
    """EM for several documents at once: proportions and log-likelihoods.

    ``p`` has the probabilities of each (document, slot) row, ``counts`` how often it occurs, ``starts``
    where a document's rows begin; ``allowed`` tells which components a document may use.
    """
    sizes = np.add.reduceat(counts, starts)[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = p * share[doc]
        part *= (counts / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, starts, axis=0) / sizes
    likely = np.log(np.einsum("ij,ij->i", p, share[doc])) * counts
    return share, np.add.reduceat(likely, starts)


def infer(texts: list[str], model: Model) -> tuple[np.ndarray, list[np.ndarray]]:
    """Proportions (documents x components) of the chosen language sets, and the sets."""
    kinds = len(model.languages) + 1
    keys = [np.unique(slots(t), return_counts=True) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(k) for k, _ in keys])
    starts = np.concatenate([[0], np.cumsum([len(k) for k, _ in keys])[:-1]])
    p = model.logs[np.concatenate([k for k, _ in keys])]
    counts = np.concatenate([c for _, c in keys]).astype(np.float32)
    share, best = _mixtures(p, counts, starts, doc, np.ones((len(texts), kinds), np.float32))
    order = np.argsort(-share, axis=1, kind="stable")
    cost = PENALTY * np.log(np.maximum(2, np.add.reduceat(counts, starts)))
    single = np.add.reduceat(np.log(p[np.arange(len(p)), order[doc, 0]]) * counts, starts)
    # No set beats the full one's likelihood, so where even that can't pay for a second
    # component, the best single component is the answer.
    chosen, value, size = np.zeros_like(share), single - cost, np.ones(len(texts), int)
    chosen[np.arange(len(texts)), order[:, 0]] = 1.0
    undecided = best - 2 * cost > value
    for m in range(2, kinds + 1):
        if not undecided.any():
            break
        docs = np.flatnonzero(undecided)
        rows = undecided[doc]
        own = np.searchsorted(docs, doc[rows])
        allowed = np.zeros((len(docs), kinds), np.float32)
        np.put_along_axis(allowed, order[docs, :m], 1.0, axis=1)
        begin = np.searchsorted(own, np.arange(len(docs)))
        mixed, likely = _mixtures(p[rows], counts[rows], begin, own, allowed)
        better = likely - m * cost[docs] > value[docs]
        value[docs[better]] = (likely - m * cost[docs])[better]
        chosen[docs[better]] = mixed[better]
        size[docs[better]] = m
        undecided[docs] = best[docs] - (m + 1) * cost[docs] > value[docs]
    return chosen, [order[i, : size[i]] for i in range(len(texts))]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its proportion), ``languages`` (the chosen set with its
    proportions) and ``background`` (the share that fits no language).

    Columns of ``docs`` with one of these names, in any case, give way to the results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("lang_pred string, score double, languages string, background double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        languages = model.languages
        for batch in batches:
            out: list[tuple] = [("und", 0.0, "", 0.0)] * len(batch)
            wanted = [i for i, t in enumerate(batch) if languages and t is not None and LETTER.search(t)]
            at = 0
            while at < len(wanted):
                end, held = at, 0
                while end < len(wanted) and (end == at or held + len(batch.iloc[wanted[end]]) <= CHUNK_BYTES):
                    held += len(batch.iloc[wanted[end]])
                    end += 1
                part = wanted[at:end]
                shares, sets = infer([batch.iloc[i] for i in part], model)
                for i, share, chosen in zip(part, shares, sets, strict=True):
                    top = int(np.argmax(share[:-1]))
                    names = ",".join(
                        f"{languages[k]}:{share[k]:.3f}" for k in chosen if k < len(languages)
                    )
                    score = min(1.0, max(0.0, float(share[top])))
                    out[i] = (languages[top], score, names, float(share[-1]))
                at = end
            yield pd.DataFrame(out, columns=["lang_pred", "score", "languages", "background"])

    results = {"lang_pred", "score", "languages", "background", MIXTURE}
    kept = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in results]
    # Else Spark moves a filter on the results below and calls the function once more for it: all texts
    # twice, and a task takes two Python workers, which executors keep for the stages that follow.
    once = run.asNondeterministic()
    return docs.select(*kept, once(text).alias(MIXTURE)).select(*kept, f"{MIXTURE}.*")
