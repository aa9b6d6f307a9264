"""Post, account and label tables as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slyglot.functions import text as T
from slyglot.operators.topk import any_per_key

# Column names of the labelled files, and suffixes of image files.
LABELED_SCHEMA = "URL string, Labels string"
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png")


def read_labeled_posts(spark: SparkSession, path: str) -> DataFrame:
    """A1: ``URL, Labels`` CSV with the JSON label list parsed into an array."""
    rows = (
        spark.read.schema(LABELED_SCHEMA)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return rows.select("URL", T.labels_from_json(F.col("Labels")).alias("labels"))


def write_labeled_posts(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write ``(url, labels)`` in the form :func:`read_labeled_posts` reads."""
    rows.select(
        F.col("url").alias("URL"), T.labels_to_json(F.col("labels")).alias("Labels")
    ).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def lookup_posts(urls: DataFrame, posts: DataFrame) -> DataFrame:
    """A5: the post behind each URL; NULL columns where there is none.

    ``posts`` holds one row per (author_handle, rkey). It is cut to the wanted posts
    first, so a short URL list never shuffles the post table; a long one uses the same
    partitioning for both joins. A URL asked for very often skews only the left side,
    which adaptive execution splits.
    """
    keys = ["author_handle", "rkey"]
    wanted = urls.withColumns(
        {"author_handle": T.post_handle(F.col("url")), "rkey": T.post_rkey(F.col("url"))}
    )
    found = posts.drop("url").join(wanted.select(keys).distinct(), keys, "left_semi")
    return wanted.join(found, keys, "left")


def resolve_handles(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add the account identifier of each handle; NULL if unknown."""
    one_per_handle = any_per_key(accounts.select("handle", "did"), "handle")
    return requests.join(one_per_handle, "handle", "left")


def query_labels(labels: DataFrame, uri_patterns: list[str], sources: list[str] | None = None) -> DataFrame:
    """Labels on URIs matching any pattern (``*`` = any text), from given sources or from all."""

    def like(pattern: str):
        escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        return F.col("uri").like(escaped.replace("*", "%"))

    matching = labels.filter(T.any_of(map(like, uri_patterns)))
    return matching.filter(F.col("src").isin(sources)) if sources else matching


def reference_hashes(images: DataFrame) -> DataFrame:
    """Distinct hashes of the image files (by extension) in ``(path, hash)`` rows."""
    is_image = T.any_of(F.endswith("path", F.lit(s)) for s in IMAGE_SUFFIXES)
    return images.filter(is_image & F.col("hash").isNotNull()).select("hash").distinct()
