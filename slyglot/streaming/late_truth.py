"""Evaluation while the truth is still coming in (E1-E11 on streams).

Predictions wait for their truth in an outer join of two streams. A prediction whose truth
does not come in time leaves with none, and counts as an error as it does in a report.
Each micro-batch of decided rows becomes one row of counts. Counts add up, so a report is
made from them and nothing that was counted is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slyglot.operators import evaluate

WAIT = "3 hours"


def with_truth(predictions: DataFrame, truth: DataFrame, wait: str = WAIT) -> DataFrame:
    """``(post_id, expected, predicted, error)``: every prediction with its truth, if that came in time.

    ``predictions`` is ``(post_id, predicted, error, predicted_at)`` and ``truth`` is
    ``(post_id, expected, known_at)`` with one row for each post, where ``known_at`` may be
    up to ``wait`` after ``predicted_at``. For streams both need a watermark on their time.
    """
    known = truth.select(F.col("post_id").alias("_post"), "expected", "known_at")
    in_time = F.expr(f"known_at >= predicted_at AND known_at <= predicted_at + INTERVAL {wait}")
    found = predictions.join(known, (F.col("post_id") == F.col("_post")) & in_time, "left_outer")
    return found.select("post_id", "expected", "predicted", "error")


def start_evaluation(
    predictions: DataFrame, truth: DataFrame, out: str, checkpoint: str, wait: str = WAIT, delay: str = "10 minutes", **trigger
) -> StreamingQuery:
    """Write one summary row for each micro-batch to ``out``.

    A batch writes its own folder again when it is replayed, so it is counted once.
    """
    rows = with_truth(predictions.withWatermark("predicted_at", delay), truth.withWatermark("known_at", delay), wait)

    def count(batch: DataFrame, batch_id: int) -> None:
        evaluate.summary(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()


def report_so_far(spark: SparkSession, out: str) -> DataFrame:
    """The report over all batches counted so far."""
    return evaluate.figures(evaluate.merged(spark.read.parquet(out).drop("batch")))
