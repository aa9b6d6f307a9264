"""Evaluation figures against published logs and small fixtures."""

import pytest
from pyspark.sql import functions as F

from slyglot.operators import evaluate as E

# (tp, fp, tn, fn) and the published accuracy, precision, recall, F1
PUBLISHED = [
    ((857, 677, 78, 48), (0.5633, 0.5587, 0.9470, 0.7027)),
    ((365, 56, 699, 540), (0.6410, 0.8670, 0.4033, 0.5505)),
    ((871, 736, 19, 34), (0.5361, 0.5420, 0.9624, 0.6935)),
    ((283, 27, 728, 622), (0.6090, 0.9129, 0.3127, 0.4658)),
    ((147, 180, 1094, 239), (0.7476, 0.4495, 0.3808, 0.4123)),
    ((337, 1162, 148, 13), (0.2922, 0.2248, 0.9629, 0.3645)),
    ((21, 0, 1491, 148), (0.9108, 1.0000, 0.1243, 0.2211)),
    ((59, 85, 1406, 110), (0.8825, 0.4097, 0.3491, 0.3770)),
]
G, C, H, S = "linguistic-evasion", "character-substitution", "homophone", "spoonerism"


@pytest.mark.parametrize("cells,metrics", PUBLISHED)
def test_published_metrics(spark, cells, metrics):
    parts = [
        spark.range(n).select(F.lit(t).alias("t"), F.lit(p).alias("p"))
        for n, (t, p) in zip(cells, ((True, True), (False, True), (False, False), (True, False)))
    ]
    rows = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    counted = E.confusion(rows, F.col("t"), F.col("p"))
    assert tuple(counted.first()) == cells
    values = E.ratio_metrics(*(F.col(c) for c in E.CELLS))
    got = counted.select(*(v.alias(n) for n, v in values.items())).first()
    assert tuple(round(x, 4) for x in got) == metrics


@pytest.fixture
def rows(spark):
    data = [
        ([G, C], [C, G]), ([G, H], [C, G]), ([], []), ([], [H, G]), ([S], []), ([G, C], [C, H, G]),
    ]
    return spark.createDataFrame([(e, p, False) for e, p in data], "expected array<string>, predicted array<string>, error boolean")


def test_exact_match_and_mismatches(rows):
    assert tuple(E.exact_match(rows).first()) == (2, 6, 2 / 6)
    assert E.mismatches(rows).count() == 4
    assert tuple(E.class_balance(rows).first()) == (6, 4, 2, 0)


def test_general_truth_is_implied_by_a_specific_label(rows):
    row = E.evaluate_general(rows).first()
    assert (row.tp, row.fp, row.tn, row.fn) == (3, 1, 1, 1)


def test_per_label_and_undefined_guard(rows):
    got = {r.label: r for r in E.evaluate_per_label(rows).collect()}
    assert (got[C].tp, got[C].fp, got[C].tn, got[C].fn) == (2, 1, 3, 0)
    assert got[C].precision == 2 / 3 and got[C].recall == 1.0
    # spoonerism has true but no predicted positives
    assert got[S].fn == 1 and got[S].accuracy is None and got[S].f1 is None


def test_no_rows_and_all_positive(spark, rows):
    empty = rows.limit(0)
    assert tuple(E.exact_match(empty).first()) == (0, 0, None)
    general = E.evaluate_general(empty).first()
    assert (general.tp, general.accuracy) == (0, None)
    full = E.evaluate_general(rows.filter(F.array_contains("expected", C))).first()
    assert (full.tp, full.fp, full.tn, full.fn, full.accuracy) == (2, 0, 0, 0, 1.0)


def test_report_agrees_with_its_parts(spark, rows):
    times = spark.createDataFrame([(0.25,), (0.75,)], "s double")
    got = {(r.section, r.metric): r.value for r in E.report(rows, times, "s").collect()}
    assert got["balance", "positives"] == 4 and got["errors", "rate"] == 0
    assert got["latency", "avg_time"] == 0.5 and got["latency", "max_time"] == 0.75
    for r in E.evaluate_per_label(rows).union(E.evaluate_general(rows)).collect():
        for name in (*E.CELLS, *E.METRICS):
            assert got[r.label, name] == r[name]
    assert tuple(E.error_rate(rows).first()) == (0, 6, 0.0)
