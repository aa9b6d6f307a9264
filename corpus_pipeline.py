"""The corpus pipeline: filter, deduplicate, decontaminate, mask and encode documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slyglot.llm import decontaminate, pii_crf, piece_bpe, quality_gam, simhash_cover
from slyglot.llm.queries import tokenizer_file
from slyglot.llm.shared import table
from slyglot.session import scratch_path, ship_package

#: DuckDB cannot express the classifier, the field and the encoder; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship_package(spark)
    return quality_gam.accepted(docs, quality_gam.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of smallest id."""
    ship_package(spark)
    return simhash_cover.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind."""
    ship_package(spark)
    return pii_crf.masked(docs, pii_crf.learn(pii_crf.labelled_table(spark)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left."""
    ship_package(spark)
    return piece_bpe.encode(docs, tokenizer_file())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
