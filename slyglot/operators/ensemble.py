"""Weighted detectors with a confidence threshold.

Each signal has a whole-number weight: given, or learned as a thousandfold log-likelihood
ratio from counts over labelled rows. A post's score is the sum of the weights of its
signals. One aggregate over score bins gives, cumulated from the top, precision and recall
at every threshold, and the least threshold that reaches a wanted precision is chosen:
the one that labels most posts. Rows never leave their task but as counts by bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGETS = (0.80, 0.85, 0.90, 0.95)
#: Score bins at most.
BINS = 10_000


def learned_weights(rows: DataFrame, signals: Sequence[str], truth: str = "truth") -> dict[str, int]:
    """Weights of boolean columns: ``round(1000 ln P(signal | true) / P(signal | false))``.

    Chances are smoothed by one row of either kind, so a signal that is never or always
    seen has a finite weight. One aggregate; one row of counts comes to the driver. Rows
    with a NULL truth are left out and a NULL signal is False.
    """
    known = rows.filter(F.col(truth).isNotNull())
    counts = [F.count_if(F.col(truth)).alias("yes"), F.count_if(~F.col(truth)).alias("no")]
    for i, s in enumerate(signals):
        counts += [F.count_if(F.col(s) & F.col(truth)).alias(f"y{i}"), F.count_if(F.col(s) & ~F.col(truth)).alias(f"n{i}")]
    ratio = [
        F.round(1000 * F.log(((F.col(f"y{i}") + 1) / (F.col("yes") + 2)) / ((F.col(f"n{i}") + 1) / (F.col("no") + 2)))).cast("int").alias(f"w{i}")
        for i in range(len(signals))
    ]
    found = known.agg(*counts).select(*ratio).first()
    return {s: found[f"w{i}"] for i, s in enumerate(signals)}


def score(weights: dict[str, int]) -> Column:
    """The summed weights of the signals that hold."""
    return sum((F.when(F.col(s), F.lit(w)).otherwise(F.lit(0)) for s, w in weights.items()), F.lit(0))


def with_score(rows: DataFrame, weights: dict[str, int]) -> DataFrame:
    return rows.withColumn("score", score(weights))


def precision_recall(rows: DataFrame, weights: dict[str, int], truth: str = "truth") -> DataFrame:
    """``(threshold, tp, fp, fn, precision, recall)`` at each score bin that has rows.

    A bin is one score, or an even range of scores where there are more than ``BINS``.
    """
    low, high = sum(min(w, 0) for w in weights.values()), sum(max(w, 0) for w in weights.values())
    width = max(1, -(-(high - low + 1) // BINS))
    threshold = low + F.floor((F.col("score") - low) / width) * width
    known = with_score(rows, weights).filter(F.col(truth).isNotNull())
    bins = known.groupBy(threshold.cast("long").alias("threshold")).agg(
        F.count_if(F.col(truth)).alias("yes"), F.count_if(~F.col(truth)).alias("no")
    )
    # a bounded number of bins is all that the unpartitioned windows see
    above = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = bins.select(
        "threshold", F.sum("yes").over(above).alias("tp"), F.sum("no").over(above).alias("fp"),
        (F.sum("yes").over(every) - F.sum("yes").over(above)).alias("fn"),
    )
    return summed.withColumns({
        "precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "recall": F.try_divide("tp", F.col("tp") + F.col("fn")),
    })


def chosen_thresholds(curve: DataFrame, targets: Sequence[float] = TARGETS) -> DataFrame:
    """``(target, threshold, precision, recall)``: the least threshold that reaches each precision.

    NULL where none does. Lower thresholds may dip below the target in between.
    """
    wanted = F.array(*(F.lit(float(t)) for t in targets))
    tried = curve.select(F.explode(wanted).alias("target"), "threshold", "precision", "recall")
    best = F.min(F.when(F.col("precision") >= F.col("target"), F.struct("threshold", "precision", "recall"))).alias("b")
    return tried.groupBy("target").agg(best).select("target", "b.threshold", "b.precision", "b.recall")


def confident(rows: DataFrame, weights: dict[str, int], threshold: int) -> DataFrame:
    """Rows with ``confident``: the score reaches the threshold."""
    return with_score(rows, weights).withColumn("confident", F.col("score") >= threshold)
