"""The three end-to-end jobs: score a labeler on a labelled CSV, twice, and collect one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slyglot.lexicons import Lexicons
from slyglot.operators import collect, evaluate, hashmatch
from slyglot.operators import labelers as L
from slyglot.operators.events import post_events, write_events
from slyglot.operators.lexicon_join import settled
from slyglot.plans.corpus import post_images
from slyglot.sources.posts import lookup_posts, read_labeled_posts, write_labeled_posts

Labeler = Callable[[DataFrame], DataFrame]


def scored_examples(examples: DataFrame, posts: DataFrame, labeler: Labeler) -> DataFrame:
    """Label the posts behind ``(URL, labels)`` examples.

    Adds ``predicted`` next to ``expected``; a post that is not found gets no labels
    and its ``error`` is set (D19).
    """
    wanted = examples.select(F.col("URL").alias("url"), F.col("labels").alias("expected"))
    found = lookup_posts(wanted, posts.drop("expected"))
    labeled = found.transform(labeler)
    return labeled.select(
        "url", "uri", "cid", "expected",
        L.safe_labels(F.col("labels")).alias("predicted"),
        F.col("uri").isNull().alias("error"),
    )


def basic_labeler(images: DataFrame, references: DataFrame, lex: Lexicons) -> Labeler:
    """T&S, citation and image labels, given image hashes and reference hashes."""
    matches = hashmatch.image_matches(images, references)

    def labeler(posts: DataFrame) -> DataFrame:
        matched = hashmatch.posts_with_match(post_images(posts), matches)
        # texts are labelled in the scan; only ids and short lists meet the image flags
        texts = L.with_text_labels(posts, lex).drop("text", "embed")
        flagged = texts.join(matched.withColumn("_image", F.lit(True)), "post_id", "left")
        labels = L.with_image_label(F.col("text_labels"), F.col("_image"))
        return flagged.withColumn("labels", labels).drop("_image", "text_labels")

    return labeler


def evaluate_basic(
    examples: DataFrame, posts: DataFrame, labeler: Labeler, created_by: str = "", emit_to: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Exact-match summary and mismatches; label events are appended when asked for.

    Posts are labelled once: all results read one written table.
    """
    rows = settled(scored_examples(examples, posts, labeler), "scored")
    if emit_to:
        write_events(post_events(rows.withColumn("labels", F.col("predicted")), created_by), emit_to)
    return evaluate.exact_match(rows), evaluate.mismatches(rows)


def evaluate_evasion(
    examples: DataFrame, posts: DataFrame, lex: Lexicons | None = None, times: DataFrame | None = None
) -> DataFrame:
    """The combined report of the evasion labeler on labelled examples."""
    rows = scored_examples(examples, posts, lambda p: L.label_evasion(p, lex))
    return evaluate.report(rows, times)


def collect_examples(spark: SparkSession, posts: DataFrame, path: str, seed: str = "0") -> None:
    """Append newly found positive and neutral examples to the CSV folder ``path``."""
    try:
        existing = read_labeled_posts(spark, path).select(F.col("URL").alias("url"))
    except AnalysisException:
        existing = spark.createDataFrame([], "url string")
    fresh = collect.collect_corpus(posts, collect.neutral_queries(seed), existing)
    write_labeled_posts(fresh, path)
