"""From raw documents to token digests: five stages, each over all that its predecessor kept.

Null and empty texts, and texts without letters, leave in the first stage, since no language can be
told. All stages but the last return the columns of ``documents``; extra columns pass through
unread, inside one struct while a stage runs, so they can have any names. Repeated rows: the second stage keeps one document of each near-duplicate group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolot.llm import bpe_stream, credentials, language_mixture, mixing, ngram_join
from echolot.llm.common import staged, table
from echolot.llm.queries import tokenizer_path

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
REDACTED = "[secret]"


def columns_of(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, some of them new."""
    return [new.get(name, F.col("row")[name]).alias(name) for name in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; ``lang`` becomes the language found.

    Rejected are documents without letters and those that fit the background better than all languages.
    """
    model = language_mixture.fit(docs.select("text", "lang"))
    found = language_mixture.identify(docs.select(F.struct("*").alias("row")), model, "row.text")
    kept = found.where((F.col("lang_pred") != "und") & (F.col("background") <= 0.5))
    return kept.select(*columns_of(docs, lang=F.col("lang_pred")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar texts, the one with the smallest id."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    return ngram_join.keep_first(rows, SHINGLE_WORDS, SIMILAR_PERCENT).select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark."""
    others = docs.select("doc_id", "text", F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias("row"))
    clean = credentials.redact(others, REDACTED)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.select(*columns_of(docs, text=F.col("text"), n_chars=n_chars))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of documents, so that each source has about the words of its target."""
    return mixing.whole_copies(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoding of each document."""
    return bpe_stream.report(docs, tokenizer_path())


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
    ("BPE encoding and decoding", encode),
]

# Language proportions, the similarity join's hashes and the encoding are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
