"""Queries of the operators, one each, over their whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolot.llm import (
    bitsliced,
    bpe_stream,
    credentials,
    dialogue_repair,
    language_mixture,
    license_templates,
    minmax_dedup,
    mixing,
    ngram_join,
    suffix_dedup,
    toxicity,
    whitening,
    winnowing,
)
from echolot.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(_remainder(3) == 1, F.lit(False))
    )
    model = language_mixture.fit(docs.where("not held_out").select("text", "lang"))
    return language_mixture.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.report(table(spark, sf_dir, "documents"))


def op4_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.report(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.report(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op8_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bitsliced.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    best = bitsliced.top_k(rows, rows.where("id % 50 = 0"), 5)
    return best.withColumnRenamed("id", "vec_id")


def op9_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out")
    )
    labels = table(spark, sf_dir, "labels").where(_remainder(5) != 0)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op12_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.dedupe(table(spark, sf_dir, "documents"))


def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_language_mixture,
        op2_mix_sources,
        op3_license_templates,
        op4_bpe_stream,
        op5_winnowing,
        op6_ngram_join,
        op7_suffix_dedup,
        op8_bitsliced_topk,
        op9_credentials,
        op10_toxicity,
        op11_jacobi_davidson,
        op12_minmax_dedup,
        op13_dialogue_repair,
    )
}
