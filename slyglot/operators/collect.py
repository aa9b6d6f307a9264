"""Corpus collection: keyword search and weakly labelled examples."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slyglot.lexicons import (
    GENERAL_LABEL,
    NEUTRAL_TERMS,
    NEUTRAL_TOPICS,
    POSITIVE_TERMS,
    SEARCH_LIMIT,
)
from slyglot.operators.lexicon_join import build_side, is_small, substring_hits
from slyglot.operators.topk import first_per_key, top_k_per_key
from slyglot.operators.trigram_index import TrigramIndex

NO_LABELS = "array<string>"
BASE_SAMPLE = 5
TOPIC_SAMPLE = 3


def positive_queries() -> list[tuple[int, str, str]]:
    """``(pos, term, label)`` in listed order."""
    listed = [(t, label) for label, terms in POSITIVE_TERMS.items() for t in terms]
    return [(i, t, label) for i, (t, label) in enumerate(listed)]


def term_hits(posts: DataFrame, terms: list[tuple[int, str]] | DataFrame, id_column: str = "post_id") -> DataFrame:
    """``(pos, term, post)`` for every term a lower-cased post text contains.

    A list is inlined, so a post meets all terms in its own scan task. A DataFrame
    ``(pos, term)`` of any size is joined and gives the same rows.
    """
    if isinstance(terms, DataFrame):
        listed = terms.select("pos", "term", F.lower("term").alias("pattern"))
        hits = substring_hits(posts, listed, [id_column, "url"])
        return hits.join(build_side(listed, is_small(listed)), "pattern").select("pos", "term", id_column, "url")
    lowered = F.col("_lowered")
    found = [
        F.when(F.contains(lowered, F.lit(t.lower())), F.struct(F.lit(i).alias("pos"), F.lit(t).alias("term")))
        for i, t in terms
    ]
    return (
        posts.withColumn("_lowered", F.lower("text"))
        .select(id_column, "url", F.explode(F.array_compact(F.array(*found))).alias("hit"))
        .select(F.col("hit.pos").alias("pos"), F.col("hit.term").alias("term"), id_column, "url")
    )


def search_posts(posts: DataFrame, terms, limit: int = SEARCH_LIMIT, id_column: str = "post_id") -> DataFrame:
    """The first ``limit`` posts (by id) of every term, listed or in a DataFrame."""
    return top_k_per_key(term_hits(posts, terms, id_column), "pos", [F.col(id_column)], limit)


def weak_labels(hits: DataFrame, labels: dict[int, str] | DataFrame) -> DataFrame:
    """each hit takes the general label and its term's label, from ``(pos, label)``."""
    if isinstance(labels, DataFrame):
        own = labels.select("pos", F.col("label").alias("_label"))
        found = hits.join(build_side(own, is_small(own)), "pos", "left")
        return found.withColumn("labels", F.array(F.lit(GENERAL_LABEL), F.col("_label"))).drop("_label")
    own = F.create_map(*(F.lit(x) for item in labels.items() for x in item))
    return hits.withColumn("labels", F.array(F.lit(GENERAL_LABEL), own[F.col("pos")]))


def first_wins(hits: DataFrame) -> DataFrame:
    """one row per URL, from the earliest term (then post id)."""
    return first_per_key(hits, "url", F.struct("pos", "post_id"))


def collect_positive(posts: DataFrame, limit: int = SEARCH_LIMIT, queries: DataFrame | None = None) -> DataFrame:
    """all labelled hits, before deduplication.

    ``queries`` is ``(pos, term, label)`` of any size; by default the fixed list.
    """
    if queries is not None:
        return weak_labels(search_posts(posts, queries.select("pos", "term"), limit), queries)
    queries = positive_queries()
    hits = search_posts(posts, [(i, t) for i, t, _ in queries], limit)
    return weak_labels(hits, {i: label for i, _, label in queries})


def collect_indexed(index: TrigramIndex, queries: DataFrame, limit: int = SEARCH_LIMIT) -> DataFrame:
    """F1 from a stored index, for ``(pos, term, label)`` rows of any number."""
    return weak_labels(index.search(queries.select("pos", "term"), limit), queries)


def expand_queries(terms: DataFrame, topics: DataFrame, seed: str = "0") -> DataFrame:
    """every base term, then sampled terms each with sampled topics.

    ``terms`` is ``(pos, term)`` and ``topics`` is ``(topic)``, each of any size. Only the
    few sampled terms meet all topics; of these every task keeps the first few for each
    term before the shuffle. Sampling orders by a seeded hash, so reruns agree.
    """
    by_hash = lambda *parts: F.md5(F.concat_ws("|", F.lit(seed), *parts))
    sampled = (
        terms.withColumn("h", by_hash("term")).orderBy("h", "term").limit(BASE_SAMPLE)
    )
    # one array of at most BASE_SAMPLE terms, found once, that topics stream past
    few = sampled.agg(F.collect_list(F.struct("pos", "term"))).scalar()
    options = (
        topics.select("topic").distinct().select("topic", F.explode(few).alias("t"))
        .select("t.pos", "t.term", "topic").withColumn("h", by_hash("term", "topic"))
    )
    ranks = Window.partitionBy("pos", "term").orderBy("h", "topic")
    expanded = options.withColumn("rank", F.row_number().over(ranks) - 1).filter(F.col("rank") < TOPIC_SAMPLE)
    base = terms.select(
        F.lit(0).alias("round"), "pos", F.lit(0).alias("rank"), F.col("term").alias("query")
    )
    return base.union(
        expanded.select(
            F.lit(1), "pos", "rank", F.concat_ws(" ", "term", "topic")
        )
    )


def neutral_queries(seed: str = "0") -> list[tuple[int, str]]:
    """The same expansion of the fixed neutral lists, for inlining."""

    def sample(values, count: int, *prefix: str) -> list[str]:
        digest = lambda v: hashlib.md5("|".join((seed, *prefix, v)).encode()).hexdigest()
        return sorted(values, key=lambda v: (digest(v), v))[:count]

    sampled = set(sample(NEUTRAL_TERMS, BASE_SAMPLE))
    queries = list(NEUTRAL_TERMS)
    for term in NEUTRAL_TERMS:
        if term in sampled:
            queries += [f"{term} {t}" for t in sample(NEUTRAL_TOPICS, TOPIC_SAMPLE, term)]
    return list(enumerate(queries))


def collect_negative(
    posts: DataFrame, queries: list[tuple[int, str]], limit: int = SEARCH_LIMIT
) -> DataFrame:
    """first-wins hits of neutral queries, with no labels."""
    hits = first_wins(search_posts(posts, queries, limit))
    return hits.withColumn("labels", F.array().cast(NO_LABELS))


def new_rows(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """A10: rows whose URL is not stored yet."""
    return rows.join(existing.select("url").distinct(), "url", "left_anti")


def collect_corpus(
    posts: DataFrame,
    queries: list[tuple[int, str]],
    existing: DataFrame,
    limit: int = SEARCH_LIMIT,
) -> DataFrame:
    """positive examples, then negative ones, each URL once and none twice stored.

    All terms are searched in one pass over the posts. Neutral queries rank after the
    positive ones, so first-wins keeps a post found by both as positive.
    """
    positive = positive_queries()
    terms = [(i, t) for i, t, _ in positive]
    terms += [(len(positive) + i, t) for i, t in queries]
    hits = first_wins(search_posts(posts, terms, limit))
    labelled = weak_labels(hits, {i: label for i, _, label in positive})
    no_labels = F.array().cast(NO_LABELS)
    labels = F.when(F.col("pos") < len(positive), F.col("labels")).otherwise(no_labels)
    return new_rows(labelled.select("url", labels.alias("labels")), existing)
