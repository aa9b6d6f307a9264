"""Label evaluation E1-E11. Each is one aggregate over (expected, predicted) rows.

A row whose expected or predicted labels are NULL is an error. It is never correct, is
listed as a mismatch, and is in no class and no confusion cell; ``errors`` counts it, so
that positives, negatives and errors of the labels, and likewise the four cells and
errors, add up to all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.lexicons import GENERAL_LABEL, SPECIFIC_LABELS

METRICS = ("accuracy", "precision", "recall", "f1")
CELLS = ("tp", "fp", "tn", "fn")


def same_labels(expected: str = "expected", predicted: str = "predicted") -> Column:
    """Equal as sorted lists (repeats count); False where either is NULL."""
    return F.coalesce(F.array_sort(expected) == F.array_sort(predicted), F.lit(False))


def is_unlabelled() -> Column:
    """A row that cannot be scored: one of its label lists is NULL."""
    return F.col("expected").isNull() | F.col("predicted").isNull()


def exact_match(rows: DataFrame) -> DataFrame:
    """Correct assignments, total and ratio."""
    correct = F.count_if(same_labels())
    return rows.agg(
        correct.alias("num_correct"),
        F.count("*").alias("total"),
        F.try_divide(correct, F.count("*")).alias("ratio"),
    )


def mismatches(rows: DataFrame) -> DataFrame:
    """Rows whose label lists differ or are missing."""
    return rows.filter(~same_labels())


def class_balance(rows: DataFrame) -> DataFrame:
    """Total, positive (any expected label) and negative rows, and rows without labels."""
    return rows.agg(*(c.alias(name) for name, c in _balance().items()))


def _balance() -> dict[str, Column]:
    scored = ~is_unlabelled()
    return {
        "total": F.count("*"),
        "positives": F.count_if(scored & (F.size("expected") > 0)),
        "negatives": F.count_if(scored & (F.size("expected") == 0)),
        "unlabelled": F.count_if(is_unlabelled()),
    }


def general_truth(expected: Column) -> Column:
    """The general label is listed, or any specific one implies it."""
    names = [GENERAL_LABEL, *SPECIFIC_LABELS]
    return F.arrays_overlap(expected, F.array(*map(F.lit, names)))


def confusion_cells(truth: Column, predicted: Column) -> dict[str, Column]:
    """E5: the four counts as aggregates; all zero over no rows. NULL is in no cell."""
    known = truth.isNotNull() & predicted.isNotNull()
    truth, predicted = truth & known, predicted & known
    return {
        "tp": F.count_if(truth & predicted),
        "fp": F.count_if(known & ~truth & predicted),
        "tn": F.count_if(known & ~truth & ~predicted),
        "fn": F.count_if(known & truth & ~predicted),
    }


def confusion(rows: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """E5: one row with tp, fp, tn and fn."""
    return rows.agg(*(c.alias(name) for name, c in confusion_cells(truth, predicted).items()))


def ratio_metrics(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """The four ratios; NULL unless there are true and predicted positives."""
    defined = (tp + fn > 0) & (tp + fp > 0)
    values = {
        "accuracy": (tp + tn) / (tp + fp + tn + fn),
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(tp * 2, tp * 2 + fp + fn),
    }
    return {name: F.when(defined, value) for name, value in values.items()}


def _prediction_pairs() -> dict[str, tuple[Column, Column]]:
    """Truth and prediction of every label; the general truth is implied."""
    expected, predicted = F.col("expected"), F.col("predicted")
    pairs = {
        GENERAL_LABEL: (general_truth(expected), F.array_contains(predicted, GENERAL_LABEL))
    }
    for label in SPECIFIC_LABELS:
        pairs[label] = F.array_contains(expected, label), F.array_contains(predicted, label)
    return pairs


def _cell_aggregates(labels) -> list[Column]:
    """The cells of every label as one struct each, named ``l0``, ``l1``, ..."""
    pairs = _prediction_pairs()
    return [
        F.struct(*(c.alias(n) for n, c in confusion_cells(*pairs[label]).items())).alias(f"l{i}")
        for i, label in enumerate(labels)
    ]


def _cell_array(labels) -> Column:
    """The structs of ``_cell_aggregates`` as an array of (label, cells)."""
    return F.array(*(
        F.struct(F.lit(label).alias("label"), *(F.col(f"l{i}.{n}").alias(n) for n in CELLS))
        for i, label in enumerate(labels)
    ))


def _label_rows(rows: DataFrame, labels) -> DataFrame:
    """One row per label with its cells, from a single pass over the rows."""
    return rows.agg(*_cell_aggregates(labels)).select(F.inline(_cell_array(labels)))


def _with_metrics(cells: DataFrame) -> DataFrame:
    values = ratio_metrics(*(F.col(n) for n in CELLS))
    return cells.select("*", *(v.alias(n) for n, v in values.items()))


def evaluate_general(rows: DataFrame) -> DataFrame:
    """Cells and metrics of the general label."""
    return _with_metrics(_label_rows(rows, [GENERAL_LABEL]))


def evaluate_per_label(rows: DataFrame) -> DataFrame:
    """Cells and metrics of every specific label, one against the rest."""
    return _with_metrics(_label_rows(rows, SPECIFIC_LABELS))


def latency_summary(rows: DataFrame, seconds: str) -> DataFrame:
    """Mean, longest and shortest time."""
    return rows.agg(
        F.avg(seconds).alias("avg_time"),
        F.max(seconds).alias("max_time"),
        F.min(seconds).alias("min_time"),
    )


def error_rate(rows: DataFrame, error: str = "error") -> DataFrame:
    """Failed rows, all rows and their ratio."""
    return rows.agg(
        F.count_if(error).alias("errors"),
        F.count("*").alias("total"),
        F.try_divide(F.count_if(error), F.count("*")).alias("rate"),
    )


def _figure(section: Column, metric: str, value: Column) -> Column:
    return F.struct(
        section.alias("section"), F.lit(metric).alias("metric"), value.cast("double").alias("value")
    )


def _long_form(row: DataFrame, section: Column, names) -> DataFrame:
    return row.select(F.inline(F.array(*(_figure(section, n, F.col(n)) for n in names))))


REPORTED = [GENERAL_LABEL, *SPECIFIC_LABELS]
TIMES = ("n", "sum", "max", "min")


def summary(rows: DataFrame, *by: Column) -> DataFrame:
    """Everything a report needs of ``rows``, as one row of counts (for each value of ``by``).

    Counts of parts add up to those of the whole, see ``merged``.
    """
    balance = _balance()
    return rows.groupBy(*by).agg(
        *(balance[n].alias(n) for n in ("total", "positives", "negatives")),
        F.count_if(F.col("error") | is_unlabelled()).alias("errors"),
        *_cell_aggregates(REPORTED),
    )


def time_summary(rows: DataFrame, seconds: str, *by: Column) -> DataFrame:
    """Measured times as one row ``(n, sum, max, min)`` (for each value of ``by``)."""
    return rows.groupBy(*by).agg(
        F.count(seconds).alias("n"), F.sum(seconds).alias("sum"), F.max(seconds).alias("max"), F.min(seconds).alias("min")
    )


def merged(summaries: DataFrame) -> DataFrame:
    """One summary of any number of parts; parts are summaries of different rows."""
    counts = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("total", "positives", "negatives", "errors")]
    cells = [
        F.struct(*(F.coalesce(F.sum(f"l{i}.{n}"), F.lit(0)).alias(n) for n in CELLS)).alias(f"l{i}")
        for i in range(len(REPORTED))
    ]
    return summaries.agg(*counts, *cells)


def merged_times(summaries: DataFrame) -> DataFrame:
    return summaries.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.max("max").alias("max"), F.min("min").alias("min"))


def figures(counted: DataFrame, timed: DataFrame | None = None) -> DataFrame:
    """E11 from one summary: balance, general, per-label, error and latency figures in long form."""
    plain = [("balance", n, F.col(n)) for n in ("total", "positives", "negatives")]
    plain += [
        ("errors", "errors", F.col("errors")),
        ("errors", "rate", F.try_divide(F.col("errors"), F.col("total"))),
    ]

    def of_label(row: Column) -> Column:
        counts = {n: row[n] for n in CELLS}
        figures = {**counts, **ratio_metrics(**counts)}
        return F.array(*(_figure(row["label"], n, value) for n, value in figures.items()))

    totals = F.array(*(_figure(F.lit(section), n, value) for section, n, value in plain))
    per_label = F.flatten(F.transform(_cell_array(REPORTED), of_label))
    found = counted.select(F.inline(F.concat(totals, per_label)))
    if timed is None:
        return found
    latency = timed.select(F.try_divide("sum", "n").alias("avg_time"), F.col("max").alias("max_time"), F.col("min").alias("min_time"))
    return found.union(_long_form(latency, F.lit("latency"), latency.columns))


def report(rows: DataFrame, times: DataFrame | None = None, seconds: str = "seconds") -> DataFrame:
    """Balance, general, per-label, latency and error figures in long form.

    ``rows`` carries ``expected``, ``predicted`` and ``error``. All figures over it
    come from one aggregate; ``times`` is the table of measured times, if there is one.
    """
    return figures(summary(rows), None if times is None else time_summary(times, seconds))
