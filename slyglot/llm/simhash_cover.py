"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is the majority over the XXH64 hashes of all word shingles of a text.
To link fingerprints that differ in at most r bits, every bit position gets a nonzero
vector of r + 1 bits. Each of the 2^(r+1) - 1 nonzero vectors v is a table whose mask
keeps the positions whose vector has an odd product with v. Any r differing positions
span at most r dimensions, so some v is orthogonal to all of them and its mask keeps none
of them: each pair within the radius shares a key in some table, with certainty.

Equal fingerprints are one node. The members of a bucket are compared in numpy blocks. A
bucket beyond `BLOCK` nodes is not gathered: two fingerprints within four bits have a
common neighbour two flips from both, so every member is spread over the flips of its
masked-out bits and joins the smallest member at the same point. That is linear in the
bucket, finds exactly the same components, and its points are dealt out by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.session import scratch_path

from .components import components
from .shared import checkpointed, row_keys, whole_text

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
#: Low bits of a bucket key that hold the number of its table.
TABLE = 31
#: Nodes of a bucket that one task compares with each other.
BLOCK = 4096


def masks(radius: int = RADIUS) -> list[int]:
    """The masks of all tables, as unsigned 64-bit integers."""
    size = (1 << (radius + 1)) - 1
    vectors = np.random.default_rng(7).permutation(np.resize(np.arange(1, size + 1), BITS)).tolist()
    return [sum(1 << i for i, v in enumerate(vectors) if bin(v & t).count("1") % 2) for t in range(1, size + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text; zero for a text without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], "<u8")
    ones = np.zeros(BITS, np.int64)
    for block in np.array_split(hashes, len(hashes) // 8192 + 1):
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, ids: dict[str, Column] | None = None) -> DataFrame:
    """The longs `ids` (doc_id, if not given) and fp, the fingerprint as a signed long, for every row of `docs`."""
    ids = ids or {"doc_id": F.col("doc_id").cast("long")}
    names = [*ids, "fp"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            found = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found.view(np.int64))], names)

    picked = docs.select(*(c.alias(name) for name, c in ids.items()), whole_text().alias("text"))
    return picked.mapInArrow(hashed, ", ".join(f"{name} long" for name in names))


def _bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = [], []
        for members in batch.column(0):
            fps = np.array(members.values, np.int64).view(np.uint64)
            for start in range(0, len(fps), 256):
                rows = fps[start:start + 256]
                near = np.bitwise_count(rows[:, None] ^ fps[None, start:]) <= radius
                # One member is linked to all its later neighbours, the next ones only to
                # what is not linked to it already, so links stay in proportion to members.
                i, j = _spanning(np.triu(near, 1))
                left.append(rows[i])
                right.append(fps[start + j])
        a = np.concatenate(left) if left else np.zeros(0, np.uint64)
        b = np.concatenate(right) if right else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})


def _spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of links with the components of all links of the matrix.

    Each column keeps the link to its first row, and each further row of the column one
    link for all columns with the same first row.
    """
    first = near.argmax(axis=0)
    i, j = np.nonzero(near)
    keep = first[j] == i
    keep[np.unique(np.stack([first[j], i]), axis=1, return_index=True)[1]] = True
    return i[keep], j[keep]


def links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of `nodes.fp` within `radius`."""
    if radius > 4:
        raise ValueError("buckets beyond `block` are only split for a radius of at most 4")
    signed = [_signed(m) for m in masks(radius)]
    # The low bits of a key are the number of its table.
    keys = [F.xxhash64(F.col("fp").bitwiseAND(F.lit(m))).bitwiseAND(F.lit(~TABLE)).bitwiseOR(F.lit(i)) for i, m in enumerate(signed)]
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    many = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = keyed.join(many.hint("merge"), "key")
    small = members.where(F.col("n") <= block).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    found = small.select("fps").mapInArrow(lambda b: _bucket_links(b, radius), "a long, b long")
    if not many.where(F.col("n") > block).isEmpty():
        found = found.union(_hot_links(members.where(F.col("n") > block), signed))
    return found.distinct()


def _points(batches: Iterator[pa.RecordBatch], signed: list[int]) -> Iterator[pa.RecordBatch]:
    flips = []
    for mask in signed:
        bits = np.array([1 << i for i in range(BITS) if not (mask >> i) & 1], np.uint64)
        i, j = np.triu_indices(len(bits), 1)
        flips.append(np.r_[np.zeros(1, np.uint64), bits, bits[i] | bits[j]].view(np.int64))
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            key, fp = (np.array(c) for c in batch.slice(start, 500).columns)
            ways = [flips[t] for t in key & TABLE]
            sizes = [len(w) for w in ways]
            fps = np.repeat(fp, sizes)
            yield pa.RecordBatch.from_pydict({"key": np.repeat(key, sizes), "fp": fps, "point": fps ^ np.concatenate(ways)})


def _hot_links(members: DataFrame, signed: list[int]) -> DataFrame:
    """Links within large buckets through common points two flips away."""
    points = members.select("key", "fp").mapInArrow(lambda b: _points(b, signed), "key long, fp long, point long")
    first = points.groupBy("key", "point").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a <> top")
    return points.join(first.select("key", "point", "a"), ["key", "point"]).where("a <> fp").select("a", F.col("fp").alias("b"))


def component_roots(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, root) of every fingerprint that has a link."""
    return components(links(nodes, radius))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable).

    One row per row of `docs`. A NULL or wordless text has fingerprint zero and is linked
    like any other; repeated rows share a fingerprint; a NULL doc_id is linked but never
    names a component unless no other id is in it. Other columns are not carried.
    """
    prints = checkpointed(fingerprints(docs, shingle))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = component_roots(nodes.select("fp"), radius)
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = placed.join(named, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of `docs` for each group of near-duplicates: that of the smallest doc_id.

    Rows are told apart by id and text together, so an id may stand on several texts, and
    each of them is kept or dropped with its own group. In a group, a row without an id
    comes after all others, and of rows tied by id the one of the smaller text hash comes
    first. Of rows repeated with the same id and text one stays, whichever. Very long texts
    are read whole; an empty table stays empty.
    """
    k1, k2 = row_keys(docs)
    prints = fingerprints(docs, shingle, {"id": docs["doc_id"].cast("long"), "k1": k1, "k2": k2})
    rows = checkpointed(prints.groupBy("fp", "id", "k1", "k2").agg(F.count("*").alias("n")))
    # the first row of each fingerprint, then of each component: both combine before they shuffle
    order = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2", "n")
    first = rows.groupBy("fp").agg(F.min(order).alias("at"))
    roots = component_roots(rows.select("fp").distinct(), radius)
    placed = first.join(roots, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "at")
    kept = placed.groupBy("root").agg(F.min("at").alias("at"))
    path = scratch_path(docs.sparkSession, "kept")
    kept.select(F.col("at.k1").alias("kept1"), F.col("at.k2").alias("kept2"), F.col("at.n").alias("kept_n")).write.parquet(path)
    kept = docs.sparkSession.read.parquet(path)
    # The rows kept grow with the table: joined by shuffle at every size.
    found = lambda some: docs.join(some.hint("merge"), (k1 == some["kept1"]) & (k2 == some["kept2"]), "left_semi")
    once = found(kept.where("kept_n = 1"))
    if kept.where("kept_n > 1").isEmpty():
        return once
    return once.unionByName(found(kept.where("kept_n > 1")).dropDuplicates(["doc_id", "text"]))
