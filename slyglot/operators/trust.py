"""Trust of an author from label history (X3), decaying with time and forgotten after a pause.

A post adds its severity to the author's harm and one to the author's exposure, and both
halve every ``HALF_LIFE`` seconds. Trust is ``(1 + exposure - harm) / (2 + exposure)`` at the
author's last post. After a pause longer than ``PAUSE`` an author starts anew.

Posts of an author are first added up by slots of time, at the slot's end. So an author
with a third of all posts is one row for each slot, both here and in the stream's state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HALF_LIFE = 86_400.0
PAUSE = 36 * 3_600.0
#: Seconds of a slot; shorter than a pause, so no pause lies within one.
SLOT = 3_600


def seconds(ts: str | Column) -> Column:
    """Seconds since 1970, with fractions."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")) / 1e6


def decay(age: Column, half_life: float) -> Column:
    return F.pow(F.lit(0.5), age / half_life)


def slot_sums(end: Column, half_life: float) -> list[Column]:
    """Sums over the posts ``(at, severity)`` of a slot as they stand at its end."""
    left = decay(end - F.col("at"), half_life)
    return [
        F.count("*").alias("n"), F.sum(F.col("severity") * left).alias("harm"), F.sum(left).alias("exposure"),
        F.min("at").alias("first"), F.max("at").alias("last"),
    ]


def trust(harm: Column, exposure: Column) -> Column:
    return (1 + exposure - harm) / (2 + exposure)


def history(posts: DataFrame) -> DataFrame:
    """``(author, at, severity)``: rows without author or time go, a NULL severity is 0."""
    known = posts.filter("author IS NOT NULL AND ts IS NOT NULL")
    return known.select("author", seconds("ts").alias("at"), F.coalesce(F.col("severity").cast("double"), F.lit(0.0)).alias("severity"))


def trust_scores(posts: DataFrame, half_life: float = HALF_LIFE, pause: float = PAUSE) -> DataFrame:
    """``(author, n_posts, last, trust, expired)`` from ``(author, ts, severity)`` rows.

    Counts are those since the last pause. ``expired`` tells that the author has paused
    again by the time of the last post of all. No posts give no rows.
    """
    if pause < SLOT:
        raise ValueError(f"a pause must be at least a slot of {SLOT} seconds")
    rows = history(posts)
    dealt = rows.withColumn("slot", F.floor(F.col("at") / SLOT))
    slots = dealt.groupBy("author", "slot").agg(*slot_sums((F.col("slot") + 1) * SLOT, half_life))
    order = Window.partitionBy("author").orderBy("slot")
    rested = F.col("first") - F.lag("last").over(order) > pause
    lives = slots.withColumn("life", F.sum(F.coalesce(rested, F.lit(False)).cast("int")).over(order))
    author = Window.partitionBy("author")
    now = lives.withColumns({"_life": F.max("life").over(author), "_last": F.max("last").over(author)}).filter("life = _life")
    left = decay(F.col("_last") - (F.col("slot") + 1) * SLOT, half_life)
    scores = now.groupBy("author").agg(
        F.sum("n").alias("n_posts"), F.max("last").alias("last"),
        F.sum(F.col("harm") * left).alias("harm"), F.sum(F.col("exposure") * left).alias("exposure"),
    )
    latest = rows.agg(F.max("at")).scalar()
    return scores.select(
        "author", "n_posts", "last", trust(F.col("harm"), F.col("exposure")).alias("trust"),
        (latest - F.col("last") > pause).alias("expired"),
    )
