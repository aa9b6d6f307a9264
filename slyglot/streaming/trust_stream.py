"""Trust of authors on a stream: state for each author, with a timer that forgets.

Two stateful steps. A windowed aggregate adds up each author's posts by slot and hands a
slot on when the watermark has closed it, so slots come whole and late posts within the
watermark are in their place. Then one small state for each author takes the slots in
order; an event-time timer clears it when the author has paused for too long.

The state needs the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from slyglot.operators import trust as T

SCORE = "author string, n_posts long, last double, trust double, expired boolean"
STATE = "n long, harm double, exposure double, last double"


class TrustState(StatefulProcessor):
    """Adds slots to an author's decayed sums; forgets an author after a pause."""

    def __init__(self, half_life: float, pause: float):
        self.half_life, self.pause = half_life, pause

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", STATE)

    def _faded(self, amount: float, age: float) -> float:
        return amount * 0.5 ** (age / self.half_life)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values("end")
        n, harm, exposure, last = self.sums.get() if self.sums.exists() else (0, 0.0, 0.0, None)
        for slot in found.itertuples(index=False):
            if last is not None and slot.first - last > self.pause:
                n, harm, exposure = 0, 0.0, 0.0
            age = slot.last - (slot.last if last is None else last)
            n += int(slot.n)
            harm = self._faded(harm, age) + self._faded(slot.harm, slot.last - slot.end)
            exposure = self._faded(exposure, age) + self._faded(slot.exposure, slot.last - slot.end)
            last = slot.last
        self.sums.update((n, harm, exposure, float(last)))
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        # a slot that begins within the pause may still be open when the pause ends
        self.handle.registerTimer(int((last + self.pause + T.SLOT) * 1000) + 1)
        yield self._score(key, n, harm, exposure, last, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists():
            yield self._score(key, *self.sums.get(), True)
            self.sums.clear()

    def _score(self, key, n: int, harm: float, exposure: float, last: float, gone: bool) -> pd.DataFrame:
        value = (1 + exposure - harm) / (2 + exposure)
        return pd.DataFrame({"author": [str(key[0])], "n_posts": [n], "last": [last], "trust": [value], "expired": [gone]})

    def close(self) -> None:
        pass


def trust_updates(posts: DataFrame, delay: str = "1 hour", half_life: float = T.HALF_LIFE, pause: float = T.PAUSE) -> DataFrame:
    """A row for each change of an author's score, from a stream of ``(author, ts, severity)``.

    The last row of an author is the score; ``expired`` marks that the author was forgotten.
    """
    if pause < T.SLOT:
        raise ValueError(f"a pause must be at least a slot of {T.SLOT} seconds")
    known = posts.withWatermark("ts", delay).filter("author IS NOT NULL AND ts IS NOT NULL").select(
        F.col("author").cast("string").alias("author"), "ts", T.seconds("ts").alias("at"),
        F.coalesce(F.col("severity").cast("double"), F.lit(0.0)).alias("severity"),
    )
    slot = F.window("ts", f"{T.SLOT} seconds")
    end = (F.floor(F.col("at") / T.SLOT) + 1) * T.SLOT
    slots = known.groupBy("author", slot.alias("slot")).agg(*T.slot_sums(end, half_life))
    closed = slots.select("author", "n", "harm", "exposure", "first", "last", T.seconds("slot.end").alias("end"))
    return closed.groupBy("author").transformWithStateInPandas(
        TrustState(half_life, pause), outputStructType=SCORE, outputMode="append", timeMode="eventTime"
    )


def latest_scores(updates: DataFrame) -> DataFrame:
    """The last row of each author, from the appended updates."""
    best = F.max_by(F.struct("n_posts", "last", "trust", "expired"), F.struct("last", "expired")).alias("s")
    return updates.groupBy("author").agg(best).select("author", "s.*")
