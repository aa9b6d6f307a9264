"""Dogpiles (X2): many posts by many authors on one target in a short time.

Posts are first counted by tumbling panes as long as the slide, with a distinct-count
sketch of their authors; sliding windows are then sums of panes. Each post is kept in one
pane's state instead of in every window over it, and both steps combine before they
shuffle, so a target with a third of all posts sends one row per task and pane.

The same functions serve tables and streams. On a stream the caller's watermark closes
panes and windows, and posts later than that are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SIZE, SLIDE = "1 hour", "10 minutes"
#: Registers of a sketch as a power of two; counts are within some 2 %.
LG_REGISTERS = 12


def _posts(activity: DataFrame) -> DataFrame:
    """Rows that can be counted: with a time and a target."""
    return activity.filter("ts IS NOT NULL AND target IS NOT NULL")


def panes(activity: DataFrame, slide: str = SLIDE) -> DataFrame:
    """``(target, pane, n_posts, authors)`` from ``(ts, target, author)`` rows; authors as a sketch."""
    return _posts(activity).groupBy("target", F.window("ts", slide).alias("pane")).agg(
        F.count("*").alias("n_posts"), F.hll_sketch_agg("author", F.lit(LG_REGISTERS)).alias("authors")
    )


def sketched_windows(activity: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """``(target, window, n_posts, approx_authors)`` of every sliding window with a post."""
    return panes(activity, slide).groupBy("target", F.window("pane", size, slide).alias("window")).agg(
        F.sum("n_posts").alias("n_posts"), F.hll_sketch_estimate(F.hll_union_agg("authors")).alias("approx_authors")
    )


def exact_windows(activity: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """``(target, window, n_posts, n_authors)`` with exact counts, for tables.

    Posts of an author in a pane are one row before windows multiply them. NULL authors
    count as posts, not as authors.
    """
    by_author = _posts(activity).groupBy("target", "author", F.window("ts", slide).alias("pane")).agg(F.count("*").alias("n"))
    return (
        by_author.groupBy("target", "author", F.window("pane", size, slide).alias("window")).agg(F.sum("n").alias("n"))
        .groupBy("target", "window").agg(F.sum("n").alias("n_posts"), F.count("author").alias("n_authors"))
    )


def dogpiles(windows: DataFrame, min_posts: int, min_authors: int, authors: str = "n_authors") -> DataFrame:
    """Windows with at least so many posts and authors."""
    return windows.filter((F.col("n_posts") >= min_posts) & (F.col(authors) >= min_authors))


def episodes(flagged: DataFrame, authors: str = "n_authors") -> DataFrame:
    """``(target, begin, end, n_windows, peak_posts, peak_authors)``: touching windows as one.

    A target has as many rows as windows of time, however many posts it has.
    """
    order = Window.partitionBy("target").orderBy("window.start")
    apart = F.lag("window.end").over(order) < F.col("window.start")
    runs = flagged.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
    runs = runs.withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy("target", "_run").agg(
        F.min("window.start").alias("begin"), F.max("window.end").alias("end"), F.count("*").alias("n_windows"),
        F.max("n_posts").alias("peak_posts"), F.max(authors).alias("peak_authors"),
    ).drop("_run")


def start_dogpiles(
    activity: DataFrame, out: str, checkpoint: str, min_posts: int, min_authors: int,
    size: str = SIZE, slide: str = SLIDE, delay: str = "10 minutes", **trigger,
) -> StreamingQuery:
    """Append each dogpile window to ``out`` once posts up to ``delay`` late have been counted."""
    found = dogpiles(sketched_windows(activity.withWatermark("ts", delay), size, slide), min_posts, min_authors, "approx_authors")
    writer = (
        found.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
