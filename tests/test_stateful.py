"""Dogpile windows, trust, ensembles and late truth: streams against tables, tables against plain Python."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from slyglot.lexicons import GENERAL_LABEL, SPECIFIC_LABELS
from slyglot.operators import ensemble, evaluate, trust
from slyglot.streaming import dogpile, late_truth, trust_stream

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def replay(spark, frames, folder):
    """A stream that reads one file for each frame, in order."""
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{folder}/part={i}")
    schema = frames[0].schema
    import glob
    import os
    for i in range(len(frames)):  # the source takes older files first
        for path in glob.glob(f"{folder}/part={i}/*.parquet"):
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/part=*")


def at(minutes):
    return START + timedelta(minutes=minutes)


def posts_of(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, target string, author long")


def activity_rows(seed, n=900):
    """A hot target, some quiet ones, NULLs and repeated rows, in order of time."""
    rng = random.Random(seed)
    rows = [(at(rng.uniform(0, 600)), rng.choice(["hot", "hot", f"t{rng.randint(0, 9)}"]), rng.randint(0, 40)) for _ in range(n)]
    rows += [(at(30), "hot", None), (at(31), "hot", None)] + [rows[0]] * 20
    return sorted(rows, key=lambda r: r[0])


def plain_windows(rows, size=60, slide=10):
    found = {}
    for ts, target, author in rows:
        pane = math.floor((ts - START).total_seconds() / 60 / slide)
        for start in range(pane - size // slide + 1, pane + 1):
            found.setdefault((target, start * slide), []).append(author)
    return {k: (len(v), len({a for a in v if a is not None})) for k, v in found.items()}


def keyed(frame, authors):
    minutes = (F.unix_timestamp("window.start") - F.lit(int(START.timestamp()))) / 60
    return {(r.target, round(r.m)): (r.n_posts, r[authors]) for r in frame.withColumn("m", minutes).collect()}


def test_windows_equal_plain_counts(spark):
    rows = activity_rows(1)
    frame = posts_of(spark, [*rows, (None, "hot", 1), (at(1), None, 1)])
    wanted = plain_windows(rows)
    assert keyed(dogpile.exact_windows(frame), "n_authors") == wanted
    sketched = keyed(dogpile.sketched_windows(frame), "approx_authors")
    assert sketched.keys() == wanted.keys()
    assert all(sketched[k][0] == n and abs(sketched[k][1] - a) <= 1 for k, (n, a) in wanted.items())


def test_episodes_join_touching_windows(spark):
    rows = [(at(m), "a", i) for i, m in enumerate([5, 6, 7, 300, 301, 302, 9])] + [(at(5), "b", 1)]
    found = dogpile.episodes(dogpile.dogpiles(dogpile.exact_windows(posts_of(spark, rows)), 3, 3)).collect()
    spans = sorted((r.target, r.peak_posts, r.peak_authors, r.n_windows, (r.end - r.begin).total_seconds() / 60) for r in found)
    assert spans == [("a", 3, 3, 6, 110.0), ("a", 4, 4, 6, 110.0)]


def test_dogpile_stream_leaves_out_what_is_too_late(spark, tmp_path):
    rows = activity_rows(2)
    cuts = [rows[i::1][:300] for i in range(0, len(rows), 300)]
    late = [(at(0.5), "hot", 99)] * 50  # hours behind the watermark by then
    flush = [(at(60 * 48), "end", 1)]
    frames = [posts_of(spark, part) for part in (*cuts, late, flush, [(at(60 * 48 + 1), "end", 1)])]
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        stream = replay(spark, frames, str(tmp_path / "in")) if not (tmp_path / "in").exists() else None
        if stream is None:
            stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part=*"))
        dogpile.start_dogpiles(stream, out, str(tmp_path / "log"), 12, 8, availableNow=True).awaitTermination()
    wanted = {k: v for k, v in plain_windows(rows).items() if v[0] >= 12 and v[1] >= 8}
    assert keyed(spark.read.parquet(out), "approx_authors") == wanted and len(wanted) > 5


def history_rows(seed, n=800):
    rng = random.Random(seed)
    rows = []
    for author in range(12):
        minute = rng.uniform(0, 3000)
        for _ in range(n // 12):
            minute += rng.choice([1, 20, 300, 300, 2400])
            rows.append((author if author else 0, at(minute), rng.choice([0.0, 0.0, 0.5, 1.0])))
    return sorted(rows, key=lambda r: r[1])


def plain_trust(rows, half_life=trust.HALF_LIFE, pause=trust.PAUSE):
    lives = {}
    for author, ts, severity in sorted(rows, key=lambda r: r[1]):
        t, life = ts.timestamp(), lives.setdefault(author, [])
        if life and t - life[-1][0] > pause:
            life.clear()
        life.append((t, severity))
    latest, out = max(r[1].timestamp() for r in rows), {}
    for author, life in lives.items():
        last = life[-1][0]
        harm = sum(s * 0.5 ** ((last - t) / half_life) for t, s in life)
        exposure = sum(0.5 ** ((last - t) / half_life) for t, _ in life)
        out[author] = (len(life), round((1 + exposure - harm) / (2 + exposure), 9), latest - last > pause)
    return out


def scores(frame):
    return {int(r.author): (r.n_posts, round(r.trust, 9), r.expired) for r in frame.collect()}


HISTORY = "author long, ts timestamp, severity double"


def test_trust_equals_plain_decay(spark):
    rows = history_rows(3)
    frame = spark.createDataFrame([*rows, (None, at(1), 1.0), (5, None, 1.0)], HISTORY)
    assert scores(trust.trust_scores(frame)) == plain_trust(rows)
    assert trust.trust_scores(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        trust.trust_scores(frame, pause=60)


def test_trust_stream_equals_the_table(spark, tmp_path, rocksdb):
    rows = history_rows(4, 360)
    rng = random.Random(1)
    size = len(rows) // 5 + 1
    frames = []
    for i in range(0, len(rows), size):
        part = rows[i:i + size]
        rng.shuffle(part)  # any order within a batch
        frames.append(spark.createDataFrame(part, HISTORY))
    last = max(r[1] for r in rows)
    # two late marks move the watermark over all slots, and over the pause of some authors
    frames += [spark.createDataFrame([(99, last + timedelta(hours=h), 0.0)], HISTORY) for h in (3, 4)]
    stream = replay(spark, frames, str(tmp_path / "in"))
    query = (
        trust_stream.trust_updates(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "log")).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    updates = spark.read.parquet(str(tmp_path / "out"))
    got = scores(trust_stream.latest_scores(updates).filter("author <> '99'"))
    wanted = plain_trust([*rows, (99, last + timedelta(hours=1), 0.0)])
    wanted.pop(99)
    assert {a: v[:2] for a, v in got.items()} == {a: v[:2] for a, v in wanted.items()}
    # an author is told to be forgotten when the pause, and the slot it ended in, are over
    gone = {a for a, v in got.items() if v[2]}
    assert gone <= {a for a, v in wanted.items() if v[2]} and gone


def plain_curve(rows, weights):
    score = lambda r: sum(w for s, w in weights.items() if r[s])
    for t in sorted({score(r) for r in rows}):
        hit = [r["truth"] for r in rows if score(r) >= t]
        yield t, sum(hit), len(hit) - sum(hit), sum(r["truth"] for r in rows) - sum(hit)


def labelled(spark, n=600, seed=5):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        truth = rng.random() < 0.4
        rows.append({"truth": truth, "a": rng.random() < (0.8 if truth else 0.1), "b": rng.random() < (0.5 if truth else 0.4), "c": False})
    return rows, spark.createDataFrame([(r["truth"], r["a"], r["b"], r["c"]) for r in rows] + [(None, True, True, True)], "truth boolean, a boolean, b boolean, c boolean")


def test_curve_and_threshold_equal_plain_counts(spark):
    rows, frame = labelled(spark)
    weights = ensemble.learned_weights(frame, ["a", "b", "c"])
    yes, no = sum(r["truth"] for r in rows), sum(not r["truth"] for r in rows)
    for s, w in weights.items():
        y, n = sum(r[s] and r["truth"] for r in rows), sum(r[s] and not r["truth"] for r in rows)
        assert w == round(1000 * math.log((y + 1) / (yes + 2) / ((n + 1) / (no + 2))))
    wanted = sorted(plain_curve(rows, weights))
    curve = ensemble.precision_recall(frame, weights)
    assert sorted((r.threshold, r.tp, r.fp, r.fn) for r in curve.collect()) == wanted
    for r in ensemble.chosen_thresholds(curve, (0.5, 0.8, 0.999999)).collect():
        fit = [t for t, tp, fp, _ in wanted if tp + fp and tp / (tp + fp) >= r.target]
        assert r.threshold == (min(fit) if fit else None)
    chosen = ensemble.confident(frame, weights, wanted[-1][0]).filter("confident AND truth IS NOT NULL")
    assert chosen.count() == wanted[-1][1] + wanted[-1][2]


def test_many_scores_fall_into_bounded_bins(spark):
    rows, frame = labelled(spark)
    weights = {"a": 5_000_000, "b": -3_000, "c": 1}
    curve = ensemble.precision_recall(frame, weights).collect()
    assert len(curve) <= 4 and max(r.tp + r.fp for r in curve) == len(rows)
    assert ensemble.precision_recall(frame.limit(0), weights).collect() == []


def verdicts(spark, n=240):
    rng = random.Random(6)
    lists = [[], [GENERAL_LABEL], [GENERAL_LABEL, SPECIFIC_LABELS[0]], list(SPECIFIC_LABELS)]
    made = [(i, rng.choice(lists), i % 17 == 0, at(i)) for i in range(n)] + [(n, [], False, at(60 * 24)), (n + 1, [], False, at(60 * 24 + 1))]
    known = [(i, rng.choice(lists), at(i + rng.choice([0, 5, 100, 179, 200]))) for i in range(n) if i % 7] + [(n, [], at(60 * 24)), (n + 1, [], at(60 * 24 + 1))]
    return (
        spark.createDataFrame(made, "post_id long, predicted array<string>, error boolean, predicted_at timestamp"),
        spark.createDataFrame(known, "post_id long, expected array<string>, known_at timestamp"),
    )


def figures(frame):
    return {(r.section, r.metric): r.value for r in frame.collect()}


def test_evaluation_of_streams_equals_the_report(spark, tmp_path):
    made, known = verdicts(spark)
    wanted = figures(evaluate.report(late_truth.with_truth(made, known)))
    slices = lambda f, ts: [f.filter((F.col(ts) >= F.lit(at(lo))) & (F.col(ts) < F.lit(at(hi)))) for lo, hi in ((-1, 60), (60, 130), (130, 700), (700, 1441), (1441, 9000))]
    streams = [replay(spark, slices(f, ts), str(tmp_path / ts)) for f, ts in ((made, "predicted_at"), (known, "known_at"))]
    out = str(tmp_path / "out")
    late_truth.start_evaluation(*streams, out, str(tmp_path / "log"), availableNow=True).awaitTermination()
    assert spark.read.parquet(out).select("batch").distinct().count() > 2
    assert figures(late_truth.report_so_far(spark, out)) == wanted
    assert wanted["errors", "errors"] > 30


def test_summaries_of_parts_add_up(spark):
    made, known = verdicts(spark)
    rows = late_truth.with_truth(made, known)
    times = spark.createDataFrame([(i % 3, float(i)) for i in range(50)] + [(0, None)], "k int, seconds double")
    whole = figures(evaluate.report(rows, times))
    parts = evaluate.merged(evaluate.summary(rows, F.col("post_id") % 5))
    timed = evaluate.merged_times(evaluate.time_summary(times, "seconds", F.col("k")))
    assert figures(evaluate.figures(parts, timed)) == whole and whole["latency", "avg_time"] == 24.5
    nothing = evaluate.figures(evaluate.merged(evaluate.summary(rows.limit(0), F.col("post_id"))))
    assert figures(nothing)["balance", "total"] == 0
