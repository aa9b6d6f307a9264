"""Benchmark decontamination: size-partitioned MinHash containment search, in SQL functions.

Documents are far longer than test items, so their Jaccard similarity says nothing; what
counts is containment, the share of an item's word shingles found in a document. The
smallest hashed shingles of an item are a MinHash sketch of it: a document that contains
the item at share t holds each of them with probability t. Items are partitioned by size
class, and the longest size of a class sets how many minimum values its items keep: one
more than the shingles that may be missing. So a document at or above the threshold holds
at least one of them and no item is missed. Documents that share a sketch value are
candidates; their whole shingles are then compared as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slyglot.session import scratch_path

from .shared import checkpointed, row_keys, whole_text

SHINGLE = 5
SHARE = 0.8
#: Rows up to which item shingles are broadcast; beyond, the joins shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _window(i: Column, k: int) -> list[Column]:
    return [F.get(F.col("words"), i + j) for j in range(k)]


def _windows(sizes: list[int], made: Callable[[int, list[Column]], Column], kind: str) -> Column:
    """`made` of every window of the given lengths over the column `words`."""
    parts = []
    for k in sizes:
        each = F.transform(F.sequence(F.lit(0), F.size("words") - k), _each(k, made))
        parts.append(F.when(F.size("words") >= k, each).otherwise(F.array().cast(f"array<{kind}>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _each(k: int, made: Callable[[int, list[Column]], Column]) -> Callable[[Column], Column]:
    return lambda i: made(k, _window(i, k))


def _hashes(sizes: list[int]) -> Column:
    return _windows(sizes, lambda k, words: F.xxhash64(F.lit(k), *words), "bigint")


def _strings(sizes: list[int]) -> Column:
    return F.array_distinct(_windows(sizes, lambda _, words: F.concat_ws(" ", *words), "string"))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """item, item_id, k, n_shingles, shingle, h: the distinct shingles of every different item.

    Items are told apart by `item`, a hash of their words, since an item_id may be NULL or
    stand on several texts. Items with the same words are one, under their smallest id. An
    item of fewer than five words has one shingle of its own length k; one without words
    has none.
    """
    items = (
        benchmark.select("item_id", words(whole_text()).alias("words")).where(F.size("words") > 0)
        .groupBy("words").agg(F.min("item_id").alias("item_id"))
        .withColumn("item", F.xxhash64("words"))
        .withColumn("k", F.least(F.size("words"), F.lit(SHINGLE)))
    )
    cut = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("k") + 1), lambda i: F.array_join(F.slice("words", i, F.col("k")), " ")
    ))
    rows = items.select("item", "item_id", "k", cut.alias("s")).select(
        "item", "item_id", "k", F.size("s").alias("n_shingles"), F.explode("s").alias("shingle")
    )
    word = F.split("shingle", " ")
    hashes = F.coalesce(*[
        F.when(F.col("k") == k, F.xxhash64(F.lit(k), *[F.get(word, F.lit(j)) for j in range(k)])) for k in range(1, SHINGLE + 1)
    ])
    return rows.withColumn("h", hashes)


def sketches(shingles: DataFrame, share: float = SHARE) -> DataFrame:
    """item, h: the minimum values each item keeps, by its size class."""
    longest = F.pow(F.lit(2.0), F.floor(F.log2("n_shingles")) + 1) - 1
    kept = F.floor(longest * (1 - share) + 1e-9) + 1
    order = W.partitionBy("item").orderBy(F.xxhash64(F.lit(11), "h"), "h")
    return shingles.withColumn("place", F.row_number().over(order)).where(F.col("place") <= kept).select("item", "h")


def contained_items(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, n_shingles, n_matched, containment of every pair at or above `share`.

    item_id stands for all items of the same words; different texts under one item_id, or
    without one, are items of their own and give a row each. Rows that share a doc_id are one
    document; a row without a doc_id has no name to return and gives no row. NULL and wordless texts and items match nothing; an empty table on either
    side gives no rows; other columns are ignored. A passage in very many documents costs
    one row each: items are broadcast while under `BROADCAST_ROWS` shingles, and a larger
    list joins by shuffle with the same result.
    """
    shingles = checkpointed(item_shingles(benchmark))
    sizes = sorted(r.k for r in shingles.select("k").distinct().collect()) or [SHINGLE]
    small = shingles.count() <= BROADCAST_ROWS
    side = F.broadcast if small else (lambda frame: frame)
    docs = docs.select("doc_id", words(whole_text()).alias("words"))

    probes = docs.select("doc_id", F.explode(_hashes(sizes)).alias("h"))
    found = probes.join(side(sketches(shingles, share).select("h").distinct()), "h", "left_semi")
    path = scratch_path(docs.sparkSession, "candidates")
    found.select("doc_id").distinct().write.parquet(path)
    candidates = docs.sparkSession.read.parquet(path)

    near = docs.join(candidates, "doc_id", "left_semi")
    held = near.select("doc_id", F.explode(_strings(sizes)).alias("shingle"))
    pairs = (
        held.join(side(shingles.select("item", "item_id", "n_shingles", "shingle")), "shingle")
        .groupBy("doc_id", "item", "item_id", "n_shingles").agg(F.countDistinct("shingle").alias("n_matched"))
    )
    least = F.ceil(F.col("n_shingles") * share - 1e-9)
    return pairs.where(F.col("n_matched") >= least).select(
        "doc_id", "item_id", F.col("n_shingles").cast("long").alias("n_shingles"), "n_matched",
        (F.col("n_matched") / F.col("n_shingles")).alias("containment"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of `docs` that contain no item at `share` or more.

    Rows are told apart by id and text together: of several texts under one id, only those
    that contain an item go. NULL and wordless texts stay, very long texts are read whole,
    and an empty table on either side drops nothing.
    """
    k1, k2 = row_keys(docs)
    hits = contained_items(docs.select(F.struct(k1.alias("k1"), k2.alias("k2")).alias("doc_id"), docs["text"]), benchmark, share)
    # A written list has a size before the join is planned, so texts are shuffled only beside a long one.
    path = scratch_path(docs.sparkSession, "contaminated")
    hits.select(F.col("doc_id.k1").alias("hit1"), F.col("doc_id.k2").alias("hit2")).distinct().write.parquet(path)
    hit = docs.sparkSession.read.parquet(path)
    return docs.join(hit, (k1 == hit["hit1"]) & (k2 == hit["hit2"]), "left_anti")
