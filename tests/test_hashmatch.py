"""Image-hash matching against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slyglot.functions.hashes import sign_hash
from slyglot.operators import hashmatch


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def make(seed, count, near_to=()):
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(count)]
    for base in near_to:
        for flips in (0, 4, 18, 19, 20):
            out.append(base ^ sum(1 << b for b in rng.sample(range(64), flips)))
    return out


REFERENCES = make(1, 6) + [0, (1 << 64) - 1]
IMAGES = make(2, 60, REFERENCES)
WANTED = {signed(h): min((h ^ r).bit_count() for r in REFERENCES) for h in IMAGES}


def frames(spark):
    images = spark.createDataFrame([(str(i), signed(h)) for i, h in enumerate(IMAGES)] + [("none", None)], "cid string, hash long")
    references = spark.createDataFrame([(signed(r),) for r in REFERENCES], "hash long")
    return images, references


def test_nearest(spark):
    images, references = frames(spark)
    got = {r.hash: r.bits for r in hashmatch.with_nearest(images, references).collect()}
    assert got == {**WANTED, None: None}
    assert {r.bits for r in hashmatch.with_nearest(images, references.limit(0)).collect()} == {None}


def test_threshold_boundary():
    assert hashmatch.MAX_BITS == 19 and 19 / 64 <= 0.3 < 20 / 64


def test_long_reference_lists_give_the_same_rows(spark, monkeypatch):
    images, references = frames(spark)
    monkeypatch.setattr(hashmatch, "BLOCK", 3)
    for most in (1024, 0):
        monkeypatch.setattr(hashmatch, "BROADCAST_BLOCKS", most)
        got = {r.hash: r.bits for r in hashmatch.with_nearest(images, references).collect()}
        assert got == {**WANTED, None: None}


def test_posts_with_match(spark):
    images, references = frames(spark)
    matches = hashmatch.image_matches(images, references)
    near = {str(i) for i, h in enumerate(IMAGES) if WANTED[signed(h)] <= 19}
    posts = spark.range(len(IMAGES) * 2).select(
        F.col("id").alias("post_id"), (F.col("id") % len(IMAGES)).cast("string").alias("cid")
    )
    got = {r.post_id for r in hashmatch.posts_with_match(posts, matches).collect()}
    assert got == {i for i in range(len(IMAGES) * 2) if str(i % len(IMAGES)) in near}


def test_sign_hash(spark):
    rng = random.Random(4)
    vectors = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(5)] + [[0.0] * 64, [1.0] * 3, None]
    frame = spark.createDataFrame(list(enumerate(vectors)), "id int, v array<float>")
    got = [r[0] for r in frame.orderBy("id").select(sign_hash(F.col("v"))).collect()]
    wanted = [signed(sum(1 << i for i, x in enumerate(v) if x > 0)) for v in vectors[:6]] + [None, None]
    assert got == wanted


def plain_nearest(images, references):
    refs = np.array(references, np.uint64)
    return {signed(int(h)): int(np.bitwise_count(refs ^ np.uint64(h)).min()) for h in images}


@pytest.mark.parametrize("case", ["near", "far", "mixed"])
def test_many_references_by_parts(spark, monkeypatch, case):
    """The same minima as brute force, from far fewer pairs where references are near."""
    references = make(7, 6000)
    near = [b ^ sum(1 << i for i in random.Random(b).sample(range(64), b % 7)) for b in references[:900]]
    far = make(8, 40)
    images = {"near": near, "far": far, "mixed": near[:100] + far + references[:5]}[case]
    frame = spark.createDataFrame([(signed(h),) for h in images] + [(None,)], "hash long")
    known = spark.createDataFrame([(signed(r),) for r in references] + [(signed(references[0]),), (None,)], "hash long")
    pairs = []
    found = hashmatch.nearest(frame, known, by_parts=True, tell=lambda name, n: pairs.append((name, n)))
    assert {r.hash: r.bits for r in found.collect()} == plain_nearest(images, references)
    print(case, pairs, "of", len(images) * len(references))
    if case == "near":
        assert sum(n for _, n in pairs) < 0.05 * len(images) * len(references)
    within = hashmatch.nearest(frame, known, within=8, by_parts=True)
    wanted = {h: b for h, b in plain_nearest(images, references).items() if b <= 8}
    assert {r.hash: r.bits for r in within.collect() if r.bits <= 8} == wanted


def test_no_references_and_no_images(spark):
    images, references = frames(spark)
    assert hashmatch.nearest(images, references.limit(0), by_parts=True).count() == 0
    assert hashmatch.nearest(images.limit(0), references, by_parts=True).count() == 0


def test_a_value_that_many_hashes_share_meets_in_pieces(spark, monkeypatch):
    """Rows are meetings of two arrays of bounded size, never pairs, and the minima are exact."""
    monkeypatch.setattr(hashmatch, "PIECE", 64)
    monkeypatch.setattr(hashmatch, "TOGETHER", 1 << 10)
    references = [h << 16 | 0xABCD for h in make(11, 1000)]
    references = sorted({r & (1 << 64) - 1 for r in references})
    images = [r ^ 0b101 << 40 for r in references[:700]] + make(12, 20)
    frame = spark.createDataFrame([(signed(h),) for h in images], "hash long")
    known = spark.createDataFrame([(signed(r),) for r in references], "hash long")
    met = hashmatch._met_in_round(frame, known, 0, True)
    sizes = met.selectExpr("size(images) i", "size(refs) r").collect()
    assert sum(s.i * s.r for s in sizes) >= 700 * len(references) > 100 * len(sizes)
    assert max(max(s) for s in sizes) <= 2 * 64
    found = hashmatch.nearest(frame, known, by_parts=True)
    assert {r.hash: r.bits for r in found.collect()} == plain_nearest(images, references)


@pytest.mark.parametrize("flips", [0, 1, 2, 3])
def test_a_round_varies_a_value_by_listed_masks(spark, flips):
    """Only the wanted masks are tried, not all 65,536 values of a part."""
    masks = spark.range(1).select(hashmatch._masks(flips).alias("m")).first().m
    assert sorted(masks) == [v for v in range(1 << 16) if v.bit_count() == flips]
