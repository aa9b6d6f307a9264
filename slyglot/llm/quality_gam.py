"""Document quality by a generalised additive model with pairwise interactions.

Features of a text are cut into quantile bins. Boosting goes round the features in turn:
each step fits a shallow tree (up to `LEAVES` leaves over the bins of one feature) to the
gradient of the log-loss and adds it, shrunk, to the feature's lookup table. Then the
pairs that explain most of what is left get two-dimensional tables, in the same way, with
trees that cut both features once. A text's score is the logistic of the sum of its table
entries, added up for a whole batch at once.

The model is fitted on the driver on about `SAMPLE` labelled rows at most, which bounds
what is collected; every text is scored, in one narrow pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fold, hashed_share, whole_text

FOLDS = 5
THRESHOLD = 0.3
#: About how many labelled rows the model is fitted on at most.
SAMPLE = 20_000
BINS = 48
LEAVES = 3
ROUNDS = 120
RATE = 0.15
PAIRS = 8
PAIR_BINS = 12
PAIR_ROUNDS = 40
#: Weight that pulls leaf values towards zero.
RIDGE = 2.0

FEATURES = (
    "log_bytes", "log_words", "word_length", "distinct_words", "top_word", "repeats", "distinct_lines",
    "line_words", "upper", "digits", "marks", "exclaims", "bars", "symbols", "non_ascii", "sentence_ends",
)


def features(text: str) -> list[float]:
    """The features of one text; all zero for the empty one."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [math.log1p(len(raw)), *[0.0] * (len(FEATURES) - 1)]
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    blank = int(counts[9:14].sum() + counts[32])
    inked = max(1, len(raw) - blank)
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    n, lines = len(words), raw.split(b"\n")
    symbols = int(counts[[35, 36, 37, 38, 42, 64, 94, 95, 96, 126, 60, 62, 92, 123, 125]].sum())
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    return [
        math.log1p(len(raw)), math.log1p(n), inked / n, len(seen) / n, max(seen.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n, len(set(lines)) / len(lines), math.log1p(n / len(lines)),
        upper / max(1, upper + lower), counts[48:58].sum() / inked, marks / inked, counts[33] / n, counts[124] / n,
        symbols / n, counts[128:].sum() / inked, counts[46] / n,
    ]


def _matrix(texts: Iterable[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def _cut_gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value per bin of the best tree of up to `LEAVES` leaves over ordered bins."""
    edges = [0, len(g)]
    cg, ch = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]
    while len(edges) <= LEAVES:
        best = (1e-9, None)
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                at = np.arange(a + 1, b)
                gain = _cut_gain(cg[at] - cg[a], ch[at] - ch[a]) + _cut_gain(cg[b] - cg[at], ch[b] - ch[at]) - _cut_gain(cg[b] - cg[a], ch[b] - ch[a])
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), int(at[k]))
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    leaves = np.array([(cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE) for a, b in zip(edges, edges[1:])])
    return np.repeat(leaves, np.diff(edges))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the tree that cuts both axes once."""
    def corners(m: np.ndarray) -> list[np.ndarray]:
        c = m.cumsum(0).cumsum(1)
        low, row, col = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return [low, row - low, col - low, c[-1, -1] - row - col + low]

    gs, hs = corners(g), corners(h)
    gain = sum(_cut_gain(a, b) for a, b in zip(gs, hs))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    a, b, c, d = (x[i, j] / (y[i, j] + RIDGE) for x, y in zip(gs, hs))
    value = np.empty_like(g)
    value[: i + 1, : j + 1], value[: i + 1, j + 1:], value[i + 1:, : j + 1], value[i + 1:, j + 1:] = a, b, c, d
    return float(gain[i, j]), value


@dataclass
class AdditiveModel:
    """Lookup tables of single features and of pairs."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """The model of rows `x` with labels 0 or 1; the prior alone for one class or none."""
        model = AdditiveModel(base=math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        if not 0 < y.sum() < len(y):
            return model
        cuts = lambda column, bins: np.unique(np.quantile(column, np.arange(1, bins) / bins))
        model.edges = [cuts(c, BINS) for c in x.T]
        model.pair_edges = [cuts(c, PAIR_BINS) for c in x.T]
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        bins = model._bins(x, model.edges)
        margin = np.full(len(y), model.base)
        for _ in range(ROUNDS):
            for f, table in enumerate(model.tables):
                p = 1 / (1 + np.exp(-margin))
                size = len(table)
                step = RATE * _shallow_tree(np.bincount(bins[f], y - p, size), np.bincount(bins[f], p * (1 - p), size))
                table += step
                margin += step[bins[f]]
        model._fit_pairs(model._bins(x, model.pair_edges), y, margin)
        return model

    def _fit_pairs(self, bins: list[np.ndarray], y: np.ndarray, margin: np.ndarray) -> None:
        sizes = [len(e) + 1 for e in self.pair_edges]

        def tree(i: int, j: int) -> tuple[float, np.ndarray]:
            p = 1 / (1 + np.exp(-margin))
            at, shape = bins[i] * sizes[j] + bins[j], (sizes[i], sizes[j])
            cells = [np.bincount(at, w, sizes[i] * sizes[j]).reshape(shape) for w in (y - p, p * (1 - p))]
            return _quadrants(*cells)

        able = [f for f, size in enumerate(sizes) if size > 1]
        ranked = sorted(combinations(able, 2), key=lambda ij: -tree(*ij)[0])[:PAIRS]
        self.pairs = {ij: np.zeros((sizes[ij[0]], sizes[ij[1]])) for ij in ranked}
        for _ in range(PAIR_ROUNDS):
            for (i, j), table in self.pairs.items():
                step = RATE * tree(i, j)[1]
                table += step
                margin += step[bins[i], bins[j]]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row."""
        margin = np.full(len(x), self.base)
        for table, at in zip(self.tables, self._bins(x, self.edges)):
            margin += table[at]
        if self.pairs:
            bins = self._bins(x, self.pair_edges)
            for (i, j), table in self.pairs.items():
                margin += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-margin))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; false for a NULL id."""
    return F.coalesce(fold(doc_id, FOLDS) == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Fit on about `sample` labelled rows at most, none of them held out.

    NULL ids and labels are left out. Ids with several labels count each of them.
    """
    usable = labels.select(F.col("doc_id").alias("labelled_id"), F.col("quality").cast("double").alias("y")).where(
        "labelled_id IS NOT NULL AND y IN (0, 1)").where(~held_out(F.col("labelled_id")))
    share = min(1.0, sample / max(1, usable.count()))
    chosen = usable.where(hashed_share(F.col("labelled_id"), share)) if share < 1 else usable
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(t.as_py() for t in batch.column(2))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "y": batch.column(1), "x": pa.array(list(x), pa.list_(pa.float64()))})

    found = rows.select("doc_id", "y", "text").mapInArrow(measured, "doc_id long, y double, x array<double>").toPandas()
    found = found.sort_values(["doc_id", "y"], kind="stable")
    x = np.array(found["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return AdditiveModel.fit(x, found["y"].to_numpy(np.float64))


def scores(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, whatever its text.

    A NULL text counts as empty and is scored too; repeated rows get equal scores; other
    columns are not carried; an empty table gives an empty result.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(t.as_py() for t in batch.column(2)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "held_out": batch.column(1), "score": score,
                "predicted": pa.array((score >= threshold).astype(np.int32)),
            })

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), whole_text().alias("text"))
    return picked.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that score `threshold` or more."""
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(t.as_py() or "" for t in batch.column(at)))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(kept, docs.schema)
