"""Per-key selection that holds up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 256


def top_k_per_key(rows: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of each key in ``order`` (a total order).

    Two rounds: within (key, slice of map tasks), then within key. The rank filter
    also limits each map task to ``k`` rows per key before it shuffles, so no task
    ever holds a whole hot key.
    """
    sliced = rows.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    part = Window.partitionBy(key, "_slice").orderBy(*order)
    whole = Window.partitionBy(key).orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(part))
        .filter(F.col("_rank") <= k)
        .withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= k)
        .drop("_slice", "_rank")
    )


def first_per_key(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """The row of each key that is first in ``order``; combines before the shuffle."""
    others = [c for c in rows.columns if c != key]
    best = F.min_by(F.struct(*others), order).alias("_best")
    return rows.groupBy(key).agg(best).select(key, "_best.*")


def any_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, chosen by value so that reruns agree."""
    others = [c for c in rows.columns if c != key]
    return first_per_key(rows, key, F.struct(*others))
