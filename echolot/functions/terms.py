"""Matching of terms in text: single words, and phrases of several words.

Text is read as a series of tokens: lower-cased runs of letters. A phrase is found where
its words are consecutive tokens, whatever stands between them in the text, line breaks too.
Up to ``INLINE_TERM_LIMIT`` terms are looked up within the row, so no shuffle is needed. More
terms are matched by a join on the exploded tokens.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Measured: the lookup costs the same from 11 to about 1,000 terms, little more than
# splitting the text. With many thousands the literals make the plan itself slow.
INLINE_TERM_LIMIT = 1000

TOKEN_SEPARATOR = r"[^\p{L}]+"


def check_terms(terms: Iterable[str]) -> list[str]:
    """Sorted distinct terms; refuses terms that can never equal a series of tokens."""
    distinct = sorted(set(terms))
    bad = [t for t in distinct if t != t.lower() or not all(word.isalpha() for word in t.split(" "))]
    if bad:
        raise ValueError(f"terms must be lower-case words with one space between them: {bad[:5]}")
    return distinct


def checked_term(term: Column) -> Column:
    """The term of a table row; fails the job on one that can never equal a series of tokens (an
    empty token can occur)."""
    good = term.isNull() | ((term == F.lower(term)) & term.rlike(r"^(\p{L}+( \p{L}+)*)?$"))
    message = F.concat(F.lit("terms must be lower-case words with one space between them: "), term)
    return F.when(good, term).otherwise(F.raise_error(message))


def tokens(text: Column) -> Column:
    return F.split(F.lower(text), TOKEN_SEPARATOR)


def inline_hits(text: Column, terms: Iterable[str]) -> Column:
    """Every occurrence of one of the terms in the text, as an array. Occurrences may overlap."""
    terms = check_terms(terms)
    if any(" " in term for term in terms):
        return _phrase_hits(text, terms)
    # Catalyst makes a hash set of more than ten literals. Digits are never tokens, so they
    # can fill up a short list.
    words = _hash_set(terms)
    return F.filter(tokens(text), lambda token: token.isin(words))


def _hash_set(terms: list[str]) -> list[str]:
    return terms + [str(digit) for digit in range(11 - len(terms))]


def _phrase_hits(text: Column, terms: list[str]) -> Column:
    """All terms at once: where a token begins some term, the series of tokens that are as long as the
    terms that begin with it are looked up. Work grows with the text, not with the number of terms.

    The tokens are bound as the element of an array, so the text is split once.
    """
    begins: dict[int, set[str]] = {}
    for term in terms:
        begins.setdefault(term.count(" ") + 1, set()).add(term.split(" ")[0])
    known = _hash_set(terms)

    def found(words: Column) -> Column:
        def of_length(size: int) -> Column:
            first = _hash_set(sorted(begins[size]))
            places = F.sequence(F.lit(1), F.size(words))
            starts = F.filter(
                places,
                lambda at: F.element_at(words, at).isin(first) & (at + size - 1 <= F.size(words)),
            )
            series = F.transform(starts, lambda at: F.array_join(F.slice(words, at, size), " "))
            return F.filter(series, lambda s: s.isin(known))

        def single() -> Column:
            alone = _hash_set(sorted(begins[1]))
            return F.filter(words, lambda word: word.isin(alone))

        return F.concat(*[single() if size == 1 else of_length(size) for size in sorted(begins)])

    bound = F.element_at(F.transform(F.array(tokens(text)), found), 1)
    return F.when(text.isNotNull(), bound)
