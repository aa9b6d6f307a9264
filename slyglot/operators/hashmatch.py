"""Image-hash matching D16-D17: the exact nearest reference, for any number of references.

A few references are compared whole: images and references are dealt into blocks, and every
block of images meets every block of references once. A meeting is one row with two arrays,
which numpy compares, and gives one least distance for each image; so rows grow with images
times blocks and never with pairs. Blocks are broadcast while there are few of them; beyond
that the same rows come from a join by block number.

A longer list is searched by multi-index hashing. A hash is cut into four parts of 16
bits. Two hashes that differ in at most ``4 s + 3`` bits have a part in which they differ in
at most ``s``. So in round ``s`` the values of each part are varied in exactly ``s`` bits, and
the images of a value meet the references of each variant that some reference has; a value
that many share is several pieces. An image whose least distance so far is at most ``4 s + 4``
is done: nothing nearer can be left. There are never more than 65,536 values of a part to
vary, however many images there are. When trying all variants would take more than comparing
with every reference, the images that are left meet the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.functions.hashes import BITS
from slyglot.lexicons import IMAGE_THRESHOLD
from slyglot.operators.lexicon_join import settled

MAX_BITS = max(n for n in range(BITS + 1) if n / BITS <= IMAGE_THRESHOLD)
#: References, and images, of a block.
BLOCK, IMAGE_BLOCK = 1 << 16, 1 << 12
#: Blocks of references that are compared whole at most.
FEW_BLOCKS = 4
#: How many comparisons a try of one variant of a value is worth.
TRY = 64
#: Blocks that are broadcast at most: 8 MB of hashes.
BROADCAST_BLOCKS = 16
#: Parts of a hash, and bits of each.
PARTS, PART_BITS = 4, 16
#: Hashes of a part's value that go together at most, about.
PIECE = 1024
#: Comparisons that are made at once.
TOGETHER = 1 << 18
#: Meetings of two blocks in a task, about: 32 MB of hashes.
TASK_ROWS = 64


def reference_blocks(references: DataFrame, n_blocks: int) -> DataFrame:
    """``(block, refs)``: the distinct reference hashes, dealt by hash to ``n_blocks`` arrays."""
    known = references.select("hash").filter("hash is not null").distinct()
    block = F.pmod(F.xxhash64("hash"), F.lit(n_blocks)).cast("int")
    return known.groupBy(block.alias("block")).agg(F.collect_list("hash").alias("refs"))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(hash, bits)``: of each image of a row of ``(images, refs)`` the least distance to the references there."""
    for batch in batches:
        (images, of_row, begins, _), (refs, _, starts, sizes) = map(_flat, batch.columns)
        pairs = np.diff(begins) * sizes
        least = np.empty(len(images), np.uint8)
        small = np.flatnonzero(pairs <= TOGETHER >> 4)
        last = np.cumsum(pairs[small]) // TOGETHER
        for rows in np.split(small, np.flatnonzero(np.diff(last)) + 1) if len(small) else ():
            own = np.flatnonzero(np.isin(of_row, rows)) if len(rows) < len(pairs) else np.arange(len(images))
            met = sizes[of_row[own]]
            first = np.cumsum(met) - met
            at = np.arange(met.sum()) - np.repeat(first - starts[of_row[own]], met)
            least[own] = np.minimum.reduceat(np.bitwise_count(np.repeat(images[own], met) ^ refs[at]), first)
        for row in np.flatnonzero(pairs > TOGETHER >> 4).tolist():
            known = refs[starts[row]:starts[row] + sizes[row]]
            step = max(1, TOGETHER // PIECE)
            for i in range(begins[row], begins[row + 1], step):
                some = images[i:min(i + step, begins[row + 1]), None]
                found = [np.bitwise_count(some ^ known[k:k + PIECE]).min(axis=1) for k in range(0, len(known), PIECE)]
                least[i:i + step][:len(some)] = np.min(found, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(images.view(np.int64)), pa.array(least.astype(np.int32))], ["hash", "bits"])


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All values, the row of each, and where each row begins, with the end; and the rows' sizes."""
    begins = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()[begins[0]:begins[-1]].view(np.uint64)
    sizes = np.diff(begins)
    return values, np.repeat(np.arange(len(sizes)), sizes), begins - begins[0], sizes


def _spread(frame: DataFrame, rows: int = 0) -> DataFrame:
    """Rows are few and their work is large, so they are dealt to as many tasks as a shuffle has."""
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(max(tasks, rows // TASK_ROWS))


def _least(met: DataFrame) -> DataFrame:
    return met.select("images", "refs").mapInArrow(_met, "hash long, bits int").groupBy("hash").agg(F.min("bits").alias("bits"))


def _by_blocks(hashes: DataFrame, references: DataFrame, count: int) -> DataFrame:
    n_blocks = max(1, -(-count // BLOCK))
    blocks = reference_blocks(references, n_blocks)
    if n_blocks <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    groups = max(1, -(-hashes.count() // IMAGE_BLOCK))
    group = F.pmod(F.xxhash64("hash"), F.lit(groups)).alias("group")
    images = hashes.groupBy(group).agg(F.collect_list("hash").alias("images"))
    asked = _spread(images.select("images", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")), groups * n_blocks)
    return _least(asked.join(blocks, "block"))


def _parts(hashes: DataFrame, name: str) -> DataFrame:
    """``(name, part, value)``: the parts of every hash."""
    cut = [F.shiftrightunsigned("hash", PART_BITS * i).bitwiseAND(F.lit((1 << PART_BITS) - 1)) for i in range(PARTS)]
    return hashes.select(F.col("hash").alias(name), F.posexplode(F.array(*cut)).alias("part", "value"))


def _masks(flips: int) -> Column:
    """All values of a part with exactly so many bits."""
    return F.array(*(F.lit(sum(1 << b for b in bits)).cast("long") for bits in combinations(range(PART_BITS), flips)))


def _by_value(hashes: DataFrame, name: str) -> DataFrame:
    """``(part, value, name)``: the hashes with each value of a part, in pieces of about ``PIECE``."""
    cut = _parts(hashes, "hash")
    # at most 65,536 values of each part
    sizes = cut.groupBy("part", "value").agg(F.ceil(F.count("*") / PIECE).alias("pieces")).filter("pieces > 1")
    piece = F.pmod(F.xxhash64("hash"), F.coalesce("pieces", F.lit(1))).alias("piece")
    dealt = cut.join(F.broadcast(sizes), ["part", "value"], "left").select("part", "value", piece, "hash")
    return dealt.groupBy("part", "value", "piece").agg(F.collect_list("hash").alias(name)).drop("piece")


def _met_in_round(left: DataFrame, references: DataFrame, flips: int, broadcast: bool) -> DataFrame:
    """``(images, refs)``: images and references that differ in exactly ``flips`` bits of a part."""
    asked, known = _by_value(left, "images"), _by_value(references, "refs")
    variant = F.explode(_masks(flips)).alias("mask")
    asked = _spread(asked).select("part", "images", "value", variant)
    asked = asked.select("part", "images", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    known = F.broadcast(known) if broadcast else known.hint("merge")
    return asked.join(known, ["part", "value"]).select("images", "refs")


def _by_parts(hashes: DataFrame, references: DataFrame, count: int, within: int, tell: Callable[[str, int], None] | None) -> DataFrame:
    """Rounds of growing radius; written between rounds, so that none is run again."""
    left, done, best = settled(hashes, "hashes"), [], None
    known = settled(references.select("hash").filter("hash is not null").distinct(), "references")
    flips, n_left = 0, left.count()
    while n_left and (flips == 0 or TRY * PARTS * min(n_left, 1 << PART_BITS) * math.comb(PART_BITS, flips) <= n_left * count):
        met = _met_in_round(left, known, flips, count <= BLOCK * BROADCAST_BLOCKS)
        if tell is not None:
            tell(f"pairs in round {flips}", met.agg(F.sum(F.size("images").cast("long") * F.size("refs"))).first()[0] or 0)
        nearest_now = _least(met)
        if best is not None:
            nearest_now = nearest_now.union(best)
        least = settled(nearest_now.groupBy("hash").agg(F.min("bits").alias("bits")), "least")
        proven = PARTS * flips + PARTS
        done.append(least.filter(F.col("bits") <= proven))
        if proven > within:  # whatever is left is farther away than asked for
            return _united(done)
        best = least.filter(F.col("bits") > proven)
        left = settled(left.join(done[-1].select("hash"), "hash", "left_anti"), "left")
        flips, n_left = flips + 1, left.count()
    rest = _by_blocks(left, known, count)
    if tell is not None:
        tell("pairs in blocks", n_left * count)
    return _united([*done, rest])


def _united(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def nearest(
    images: DataFrame, references: DataFrame, within: int = BITS,
    by_parts: bool | None = None, tell: Callable[[str, int], None] | None = None,
) -> DataFrame:
    """``(hash, bits)`` of every distinct image hash; no row where there is no reference.

    Hashes farther than ``within`` bits from every reference may be left out. Up to
    ``FEW_BLOCKS`` blocks of references are compared whole, and more are searched by parts,
    unless ``by_parts`` says which; the rows are the same. ``tell`` is given the number of
    pairs compared, round by round, at the cost of counting them.
    """
    count = references.filter("hash is not null").distinct().count()
    hashes = images.select("hash").filter("hash is not null").distinct()
    if by_parts is None:
        by_parts = count > FEW_BLOCKS * BLOCK
    if not by_parts or not count:
        return _by_blocks(hashes, references, count)
    return _by_parts(hashes, references, count, within, tell)


def with_nearest(images: DataFrame, references: DataFrame) -> DataFrame:
    """Add ``bits``, the fewest differing bits to any reference hash.

    NULL stands for an infinite distance: no hash, or no reference.
    """
    return images.join(nearest(images, references), "hash", "left").select(*images.columns, "bits")


def image_matches(images: DataFrame, references: DataFrame) -> DataFrame:
    """Content ids of images within the threshold of a reference."""
    near = nearest(images, references, MAX_BITS).filter(F.col("bits") <= MAX_BITS)
    return images.join(near, "hash", "left_semi").select("cid").distinct()


def posts_with_match(post_images: DataFrame, matches: DataFrame) -> DataFrame:
    """Ids of posts with any matching image, from ``(post_id, cid)`` rows."""
    return post_images.join(matches, "cid", "left_semi").select("post_id").distinct()
