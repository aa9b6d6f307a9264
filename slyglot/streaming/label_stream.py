"""The labelers on a stream of posts.

They are stateless, so the batch ``transform`` is used unchanged. Only the
skip-known-posts step keeps state, bounded by the watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from slyglot.operators.events import post_events

Labeler = Callable[[DataFrame], DataFrame]


def unseen_posts(posts: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """A10 on a stream: one row per URL among posts at most ``delay`` apart."""
    return posts.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["url"])


def start_label_events(
    posts: DataFrame, labeler: Labeler, created_by: str, out: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Label a stream and append one event per labelled post to ``out``.

    ``out`` is a streaming file sink: its log makes a replayed batch write once.
    """
    events = post_events(posts.transform(labeler), created_by)
    writer = (
        events.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_label_batches(
    posts: DataFrame, labeler: Labeler, created_by: str, out: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """The same through ``foreachBatch``, for sinks without a streaming writer.

    Each micro-batch overwrites its own folder, so a replay leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        events = post_events(batch.transform(labeler), created_by)
        events.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = posts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
