"""Registered queries: each operator over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slyglot.session import ship_package

from . import (
    byte_bpe,
    cell_codes,
    decontaminate,
    html_wrapper,
    hyper_lang,
    kmeans_tree,
    pii_crf,
    piece_bpe,
    quality_gam,
    secret_forest,
    simhash_cover,
    turn_repair,
    url_markov,
)
from .shared import table


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.detect(table(spark, sf_dir, "documents"), pii_crf.learn(pii_crf.labelled_table(spark)))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.scan(table(spark, sf_dir, "documents"), *secret_forest.learn(secret_forest.labelled_table(spark)))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_gam.scores(docs, quality_gam.learn(docs, table(spark, sf_dir, "labels")))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_cover.near_duplicates(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file(), digest_only=True)


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_markov.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_text(table(spark, sf_dir, "pages"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return hyper_lang.identify(docs, *hyper_lang.prototypes(docs))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_codes.encode(table(spark, sf_dir, "embeddings")).drop("label")


def byte_ranks() -> tuple[str, str]:
    """Rank file and word pattern of the byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"), *byte_ranks(), digest_only=True)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    query.__name__: _shipped(query)
    for query in (
        op1_pii,
        op2_secret_scan,
        op3_quality_classifier,
        op4_simhash_near_dedup,
        op5_benchmark_decontamination,
        op6_sentencepiece,
        op7_url_filter,
        op8_html_extraction,
        op9_nearest_neighbours,
        op10_language_id,
        op11_conversation_repair,
        op12_vector_codes,
        op13_byte_bpe,
    )
}
