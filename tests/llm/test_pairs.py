"""SimHash near-duplicates, containment search and nearest neighbours against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from slyglot.llm import components, decontaminate, kmeans_tree, simhash_cover

from .helpers import awkward, documents, empty


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_masks_cover_every_pair_within_the_radius():
    masks, rng = simhash_cover.masks(), random.Random(1)
    assert len(masks) == 31
    for _ in range(3000):
        bits = rng.sample(range(64), 4)
        diff = sum(1 << b for b in bits)
        assert any(m & diff == 0 for m in masks)


def test_fingerprint_equals_its_definition():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("abcAÉé \n\t\x0b .,") for _ in range(rng.randint(0, 80)))
        assert simhash_cover.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("block", [4096, 3])
def test_links_have_the_components_of_all_pairs(spark, block):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(8)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(25)} | {0, 1 << 63, 15}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = dict(components.components(simhash_cover.links(nodes, 4, block)).collect())
    mask = (1 << 64) - 1
    expected = plain_components(sorted(signed), lambda a, b: bin((a ^ b) & mask).count("1") <= 4)
    groups = {}
    for f in signed:
        groups.setdefault(found.get(f, f), set()).add(expected[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected.values()))


def test_components_of_chains_loops_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (200, 201), (201, 200), (300, 301), (300, 302)]
    found = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert len({found[i] for i in range(41)}) == 1 and 100 not in found
    assert found[200] == found[201] != found[0] and found[301] == found[302] == found[300]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    rows = simhash_cover.near_duplicates(awkward(spark)).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == "0" * 16 and by_id[0].component_id == by_id[1].component_id == by_id[6].component_id == by_id[None].component_id == 0
    assert by_id[2].component_id == by_id[3].component_id == 2
    kept = simhash_cover.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 5, 7]
    assert simhash_cover.near_duplicates(empty(spark)).count() == 0


def test_rows_without_an_id_go_by_their_text(spark):
    item = "one two three four five six"
    texts = ["alone in its group of near copies", "alone in its group of near copies", item, "also with an id", "also with an id"]
    frame = documents(spark, texts).select(
        F.when(F.col("doc_id") == 4, 4).cast("long").alias("doc_id"), "text", F.lit(1).alias("kept_id"), F.lit(2).alias("hit_id"), F.lit(3).alias("n"))
    kept = [(r.doc_id, r.text) for r in simhash_cover.keep_one(frame).collect()]
    assert sorted(kept, key=str) == [(4, texts[4]), (None, texts[0]), (None, item)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = decontaminate.decontaminated(frame, benchmark)
    assert clean.columns == frame.columns
    assert sorted(r.text for r in clean.collect()) == sorted(t for t in texts if t != item)


def test_one_id_on_several_texts(spark):
    """Each text of an id is kept or dropped with its own group, and a clean one is never lost."""
    a, b, x = ("a lone text of its own kind", "one two three four five six", "something else that nobody has copied")
    rows = [(1, a), (5, a), (5, b), (6, b), (7, x), (7, b), (7, x)]
    frame = spark.createDataFrame([(i, t, 0, "k", 9) for i, t in rows], "doc_id long, text string, kept1 int, hit2 string, k1 int")
    pairs = lambda found: sorted((r.doc_id, r.text) for r in found.collect())
    kept = simhash_cover.keep_one(frame)
    assert pairs(kept) == [(1, a), (5, b), (7, x)] and kept.columns == frame.columns
    benchmark = spark.createDataFrame([(1, b)], "item_id long, text string")
    clean = decontaminate.decontaminated(frame, benchmark)
    assert pairs(clean) == [(1, a), (5, a), (7, x), (7, x)] and clean.columns == frame.columns


def words_of(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def test_containment_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [make(n) for n in (1, 2, 3, 4, 5, 6, 9, 14, 20, 33, 50, 50)] + [["W3", "w4"], []]
    items[11] = items[10]
    docs = [make(rng.randint(0, 200)) for _ in range(40)]
    for d, doc in enumerate(docs):
        item = list(items[4 + d % 8])
        for _ in range(d % 3):
            item[rng.randrange(len(item))] = "odd"
        docs[d] = doc[: len(doc) // 2] + item + doc[len(doc) // 2:]
    frame = documents(spark, [", ".join(d) for d in docs] + ["", None, "W3 w4!"])
    benchmark = spark.createDataFrame([(i, " ".join(w), 1) for i, w in enumerate(items)] + [(99, None, 1)], "item_id long, text string, h int")
    texts = [r.text or "" for r in frame.orderBy("doc_id").collect()]
    expected = set()
    for i, item in enumerate(items):
        low = words_of(" ".join(item))
        k = min(5, len(low))
        need = {tuple(low[j:j + k]) for j in range(len(low) - k + 1)} if low else set()
        for d, text in enumerate(texts):
            doc = words_of(text)
            matched = len(need & {tuple(doc[j:j + k]) for j in range(len(doc) - k + 1)})
            if need and matched >= 0.8 * len(need) - 1e-9 and not (i == 11):
                expected.add((d, i, len(need), matched))
    found = {(r.doc_id, r.item_id, r.n_shingles, r.n_matched) for r in decontaminate.contained_items(frame, benchmark).collect()}
    assert found == expected and len(expected) > 20
    decontaminate.BROADCAST_ROWS, before = 0, decontaminate.BROADCAST_ROWS
    try:
        assert {(r.doc_id, r.item_id, r.n_shingles, r.n_matched) for r in decontaminate.contained_items(frame, benchmark).collect()} == expected
    finally:
        decontaminate.BROADCAST_ROWS = before
    clean = decontaminate.decontaminated(frame, benchmark)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, *_ in expected}


def test_containment_of_awkward_and_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "One two three four five six"), (2, "one, two three four five six"), (None, "x y z"), (3, "")], "item_id long, text string")
    rows = decontaminate.contained_items(awkward(spark), benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(2, 1), (3, 1)]
    assert decontaminate.contained_items(empty(spark), benchmark).count() == 0
    assert decontaminate.contained_items(awkward(spark), benchmark.limit(0)).count() == 0
    assert decontaminate.decontaminated(awkward(spark), benchmark).count() == 7


def test_items_without_an_id_or_of_one_id_are_told_apart(spark):
    items = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(40)]
    benchmark = spark.createDataFrame([(None if i < 20 else 7, t) for i, t in enumerate(items)], "item_id long, text string")
    # Halves of two items are no item, though their matches add up to one.
    texts = [f"before {t} after" for t in items] + [" ".join(t.split()[:15]) + " cut " + " ".join(u.split()[:15]) for t, u in zip(items, items[1:])]
    frame = documents(spark, texts)
    rows = decontaminate.contained_items(frame, benchmark).collect()
    assert sorted((r.doc_id, r.item_id, r.n_shingles, r.n_matched) for r in rows if r.item_id) == [(i, 7, 26, 26) for i in range(20, 40)]
    assert sorted((r.doc_id, r.n_matched) for r in rows if r.item_id is None) == [(i, 26) for i in range(20)]
    assert {r.doc_id for r in decontaminate.decontaminated(frame, benchmark).collect()} == set(range(40, 79))


SCHEMA = "vec_id long, embedding array<float>, label int, score double"


def test_nearest_neighbours_reach_the_recall_and_keep_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 1500)]
    x[700:760] = x[5]
    x = x.astype(np.float32).astype(float)
    frame = spark.createDataFrame([(i, v.tolist(), 1, 0.0) for i, v in enumerate(x)], SCHEMA)
    rows = kmeans_tree.nearest(frame, F.col("vec_id") % 20 == 0, 20, sample=700).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in range(0, 1500, 20):
        score = x @ x[q]
        score[q] = -np.inf
        order = np.lexsort((np.arange(1500), -np.round(score, 9)))[:20]
        got = found[q]
        assert [r for r, _, _ in got] == list(range(1, 21)) and q not in [v for _, v, _ in got]
        assert np.allclose([s for _, _, s in got], score[[v for _, v, _ in got]]) and [v for _, v, _ in got] == [v for _, v, _ in sorted(got, key=lambda g: (-g[2], g[1]))]
        hits += len(set(order) & {v for _, v, _ in got})
    assert hits / (75 * 20) >= 0.9
    assert [v for _, v, _ in found[720]][:1] == [5] or x[720] @ x[720] < max(x @ x[720])


def recall_and_share(spark, x, **bounds):
    """Recall of the queries against brute force, and the share of points that they visit."""
    frame = spark.createDataFrame([(i, v.tolist(), 1, 0.0) for i, v in enumerate(x)], SCHEMA).repartition(4)
    found = {}
    for r in kmeans_tree.nearest(frame, F.col("vec_id") % 20 == 0, 20, sample=400).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), 20):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-score)[:20].tolist()))
    points = frame.select(F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2"), F.col("embedding").cast("array<double>").alias("v"), F.array("vec_id").alias("ids"))
    built = kmeans_tree.index(points, 20, 400)
    return hits / len(found) / 20, built.share(x[::20]), built


def test_leaves_grow_in_number_with_the_table(spark, monkeypatch):
    """Beyond the sample, full leaves are split on the executors, and a query sees a smaller share."""
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 60)
    rng = np.random.default_rng(5)
    centres = 4 * rng.normal(size=(150, 12))
    made = lambda n: centres[rng.integers(0, 150, n)] + rng.normal(size=(n, 12))
    small, big = recall_and_share(spark, made(1000)), recall_and_share(spark, made(8000))
    assert small[0] >= 0.9 and big[0] >= 0.9
    assert big[1] < 0.75 * small[1]
    assert len(big[2].sizes) > 3 * len(small[2].sizes) and big[2].sizes.sum() == 8000 and np.median(big[2].sizes) <= 120
    monkeypatch.setattr(kmeans_tree, "TREE_BYTES", 8 * 13 * 100)
    bounded = recall_and_share(spark, made(8000))
    assert bounded[0] >= 0.9 and len(bounded[2].sizes) < len(big[2].sizes)


def test_nearest_neighbours_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, None), (7, [None, 1.0]), (8, [1.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (None, [1.0, 1.0]), (40, [])]
    frame = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], SCHEMA)
    found = sorted(tuple(r) for r in kmeans_tree.nearest(frame, F.col("vec_id") % 20 == 0, 20).collect())
    assert found == [(0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert kmeans_tree.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
