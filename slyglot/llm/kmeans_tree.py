"""Nearest neighbours by inner product: a hierarchical k-means tree, best bin first.

Inner products become distances by one added coordinate: with M the largest length of all
vectors, x gets sqrt(M^2 - |x|^2) and a query, scaled to length M, gets 0. The upper levels
of the tree are fitted on a bounded sample; leaves that then hold many vectors are split by
further levels on the executors, so the leaves grow in number with the table and not in
size, as far as the tree fits a bound. Every vector is put into a leaf. A query goes
through the tree with a priority queue of nodes by distance to their centres, and visits
leaves, the nearest first, until it has seen as many as calibration found necessary for
the wanted recall, and at least one vector more than it must return. Calibration compares
a few hundred vectors of the sample with the whole table.

Equal vectors are one point with its smallest ids, as many as a result can hold, so that
copies neither crowd a leaf nor a result. Leaves are split into blocks of bounded size,
for vectors and for queries, and each pair of blocks is one matrix product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import checkpointed, hashed_share

#: About how many different vectors the tree and its calibration see at most.
SAMPLE = 20_000
BRANCHES = 16
LEAF = 100
#: Points of a leaf beyond which further levels split it, and about how many of them those levels see.
LEAF_ROWS = 1000
SPLIT_SAMPLE = 4096
#: Bytes of the centres of all nodes, which every task holds. Beyond it leaves grow instead.
TREE_BYTES = 64_000_000
PROBES = 300
RECALL = 0.97
#: Vectors and queries of one leaf that meet in one task.
BLOCK = 4096
KEY = ["k1", "k2"]


@dataclass
class Tree:
    """Centres and children of the nodes; a leaf has its number instead of children."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_of: dict[int, int]

    @staticmethod
    def grow(x: np.ndarray, seed: int = 3, most: int = LEAF) -> Tree:
        """Levels of k-means until no leaf has more than `most` rows of `x`."""
        random = np.random.default_rng(seed)
        centres, children, leaf_of = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [[]], {}
        open_nodes = [(0, np.arange(len(x)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            parts = _split(x[rows], random) if len(rows) > most else []
            if len(parts) < 2:
                leaf_of[node] = len(leaf_of)
            for part in parts:
                child = len(centres)
                centres.append(x[rows[part]].mean(axis=0))
                children.append([])
                children[node].append(child)
                open_nodes.append((child, rows[part]))
        return Tree(np.array(centres), children, leaf_of)

    def with_levels(self, leaf: np.ndarray, node: np.ndarray, parent: np.ndarray, centres: np.ndarray) -> Tree:
        """The tree with further nodes under its leaves; node 0 of a leaf is the leaf itself."""
        kids, at = [list(k) for k in self.children], {}
        begin = {number: n for n, number in self.leaf_of.items()}
        for i, (of, own, above) in enumerate(zip(leaf.tolist(), node.tolist(), parent.tolist())):
            at[of, own] = len(kids)
            kids.append([])
            kids[at.get((of, above), begin[of])].append(at[of, own])
        leaves = [n for n, below in enumerate(kids) if not below]
        return Tree(np.concatenate([self.centres, centres.reshape(len(leaf), -1)]) if len(leaf) else self.centres, kids, {n: i for i, n in enumerate(leaves)})

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the nearest centres."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node in self.leaf_of:
                out[rows] = self.leaf_of[node]
                continue
            kids = np.array(self.children[node])
            nearest = _nearest(x[rows], self.centres[kids])
            todo += [(int(kid), rows[nearest == i]) for i, kid in enumerate(kids)]
        return out

    def visits(self, query: np.ndarray, sizes: np.ndarray, leaves: int, least: int) -> list[int]:
        """Leaves for one query, best bin first, until `leaves` of them and `least` vectors."""
        queue, found, seen = [(0.0, 0)], [], 0
        while queue and (len(found) < leaves or seen < least):
            _, node = heapq.heappop(queue)
            if node in self.leaf_of:
                leaf = self.leaf_of[node]
                if sizes[leaf]:
                    found.append(leaf)
                    seen += int(sizes[leaf])
                continue
            kids = self.children[node]
            far = ((self.centres[kids] - query) ** 2).sum(axis=1)
            for distance, kid in zip(far.tolist(), kids):
                heapq.heappush(queue, (distance, kid))
        return found


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def _split(x: np.ndarray, random: np.random.Generator) -> list[np.ndarray]:
    """Rows of each k-means cluster; one part where all rows are equal."""
    centres = x[random.choice(len(x), min(BRANCHES, len(x)), replace=False)]
    for _ in range(12):
        of = _nearest(x, centres)
        centres = np.array([x[of == i].mean(axis=0) for i in range(len(centres)) if (of == i).any()])
    of = _nearest(x, centres)
    return [np.flatnonzero(of == i) for i in range(len(centres)) if (of == i).any()]


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(longest ** 2 - (x ** 2).sum(axis=1), 0))]


def _as_query(x: np.ndarray, longest: float) -> np.ndarray:
    return np.c_[x * (longest / np.linalg.norm(x, axis=1, keepdims=True)), np.zeros(len(x))]


@dataclass
class Index:
    """Placed points (k1, k2, v, ids, leaf), the tree on all executors, and how far a query goes."""

    points: DataFrame
    tree: Broadcast
    sizes: np.ndarray
    longest: float
    leaves: int

    def share(self, x: np.ndarray) -> float:
        """The mean share of all points in the leaves that the queries `x` visit."""
        seen = [self.sizes[self.tree.value.visits(q, self.sizes, self.leaves, 0)].sum() for q in _as_query(x, self.longest)]
        return float(np.mean(seen) / max(1, self.sizes.sum()))


def _placed(points: DataFrame, tree: Broadcast, longest: float) -> DataFrame:
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.place(_lifted(_vectors(batch.column(2)), longest)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], ["k1", "k2", "v", "ids", "leaf"])

    return checkpointed(points.mapInArrow(placed, "k1 long, k2 long, v array<double>, ids array<bigint>, leaf long"))


def _sizes(in_leaf: DataFrame, leaves: int) -> np.ndarray:
    sizes = np.zeros(leaves, np.int64)
    for row in in_leaf.groupBy("leaf").count().collect():  # one row for each leaf of the tree
        sizes[row.leaf] = row["count"]
    return sizes


def deepened(tree: Tree, in_leaf: DataFrame, sizes: np.ndarray, longest: float, most: int) -> Tree:
    """The tree with further levels under every leaf of over `most` points.

    A task fits them on about `SPLIT_SAMPLE` points of one leaf, chosen by hash. The driver
    gets the centres, which are fewer than points over `most`, about.
    """
    shares = [min(1.0, SPLIT_SAMPLE / n) if n > most else 0.0 for n in sizes.tolist()]
    if not any(shares):
        return tree
    share = F.get(F.array(*[F.lit(int(s * 1_000_000)) for s in shares]), F.col("leaf").cast("int"))  # as many as the sample gave
    chosen = in_leaf.where(F.pmod(F.xxhash64(F.lit(23), "k1"), F.lit(1_000_000)) < share)

    def split(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        of = int(key[0])
        x = _lifted(np.stack(rows.sort_values(KEY)["v"].to_numpy()), longest)
        sub = Tree.grow(x, most=max(2, int(len(x) * most / sizes[of])))
        parent = {kid: node for node, kids in enumerate(sub.children) for kid in kids}
        nodes = range(1, len(sub.centres))
        return pd.DataFrame({"of": of, "node": pd.Series(nodes, dtype="int64"), "parent": pd.Series([parent[n] for n in nodes], dtype="int64"),
                             "centre": pd.Series([sub.centres[n] for n in nodes], dtype=object)})

    grown = chosen.groupBy("leaf").applyInPandas(split, "of long, node long, parent long, centre array<double>")
    rows = grown.orderBy("of", "node").collect()
    columns = [np.array([r[name] for r in rows], np.int64) for name in ("of", "node", "parent")]
    return tree.with_levels(*columns, np.array([r.centre for r in rows], np.float64))


def calibrated(in_leaf: DataFrame, tree: Broadcast, sizes: np.ndarray, probes: np.ndarray, longest: float, k: int) -> int:
    """Leaves to visit for a recall of `RECALL` at `k`, by the true neighbours of `probes` among all points.

    One pass over the points; each task keeps the nearest of each probe.
    """
    total = len(sizes)
    if not len(probes):
        return total

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, at = np.full((len(probes), k + 1), -np.inf), np.zeros((len(probes), k + 1), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                score = np.c_[best, probes @ _vectors(part.column(0)).T]
                leaf = np.c_[at, np.broadcast_to(np.array(part.column(1)), (len(probes), part.num_rows))]
                top = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                best, at = np.take_along_axis(score, top, axis=1), np.take_along_axis(leaf, top, axis=1)
        probe, place = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_pydict({"probe": probe, "score": best[probe, place], "leaf": at[probe, place]})

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = []
            for probe, leaves in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                order = tree.value.visits(_as_query(probes[probe:probe + 1], longest)[0], sizes, total, 0)
                place = dict(zip(order, range(1, total + 1)))
                ranks += [place[leaf] for leaf in leaves]
            yield pa.RecordBatch.from_pydict({"rank": pa.array(ranks, pa.int64())})

    near = in_leaf.select("v", "leaf").mapInArrow(closest, "probe long, score double, leaf long")
    first = near.withColumn("r", F.row_number().over(W.partitionBy("probe").orderBy(F.desc("score"), "leaf"))).where(F.col("r") <= k + 1)
    ranks = first.groupBy("probe").agg(F.collect_list("leaf").alias("leaves")).mapInArrow(ranked, "rank long")
    # at most k + 1 for each probe
    return int(np.quantile([r.rank for r in ranks.collect()], RECALL, method="higher"))


def index(points: DataFrame, k: int, sample: int = SAMPLE) -> Index:
    """Grow, deepen and calibrate the tree for `points` (k1, k2, v, ids)."""
    context = points.sparkSession.sparkContext
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e))
    count, longest, width = points.agg(F.count("*"), F.max(size), F.max(F.size("v"))).first()
    longest = longest or 0.0
    share = min(1.0, sample / max(1, count))
    seen = points.where(hashed_share(F.col("k1"), share)) if share < 1 else points
    x = np.array([r.v for r in seen.orderBy(*KEY).select("v").toLocalIterator()], np.float64)
    x = x.reshape(len(x), -1) if len(x) else np.zeros((0, width or 1))
    tree = Tree.grow(_lifted(x, longest))
    sent = context.broadcast(tree)
    in_leaf = _placed(points, sent, longest)
    sizes = _sizes(in_leaf, len(tree.leaf_of))
    nodes = max(1, TREE_BYTES // (8 * ((width or 1) + 1)))
    deeper = deepened(tree, in_leaf, sizes, longest, max(LEAF_ROWS, 2 * count // nodes))
    if deeper is not tree:
        sent = context.broadcast(deeper)
        in_leaf = _placed(points, sent, longest)
        sizes = _sizes(in_leaf, len(deeper.leaf_of))
    leaves = calibrated(in_leaf, sent, sizes, x[:: max(1, len(x) // PROBES)], longest, k)
    return Index(in_leaf, sent, sizes, longest, leaves)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v: vectors without NULL or non-finite components, not zero, of the common length."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    odd = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = rows.where(~odd & F.exists("v", lambda e: e != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common.n if common else 0))


def _vectors(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found of each query among all other rows.

    Nearness is the inner product in double precision; ties go to the smaller vec_id.
    Vectors that are NULL, zero, of an uncommon length, or hold NULL or non-finite
    components take no part, nor do rows without an id. Rows repeated with the same id
    and vector are one. With fewer than `k` others, all are returned; an empty table
    gives an empty result; other columns are ignored.
    """
    keys = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2")]
    rows = usable(vectors).select("vec_id", *keys, "v")
    ranked = rows.select("vec_id", *KEY).distinct().withColumn(
        "r", F.row_number().over(W.partitionBy(*KEY).orderBy("vec_id"))).where(F.col("r") <= k + 1)
    ids = ranked.groupBy(*KEY).agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    first = ids.select(F.col("ids")[0].alias("vec_id"), *KEY, "ids")
    points = checkpointed(rows.dropDuplicates(["vec_id", *KEY]).join(first, ["vec_id", *KEY]).select(*KEY, "v", "ids"))

    built = index(points, k, sample)
    in_leaf, tree, sizes, longest, leaves = built.points, built.tree, built.sizes, built.longest, built.leaves

    asking = rows.where(is_query).select("vec_id", *KEY).distinct()
    queries = in_leaf.join(asking.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, "v")

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lifted = _as_query(_vectors(batch.column(2)), longest)
                visits = [tree.value.visits(q, sizes, leaves, k + 1) for q in lifted]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(visits, pa.list_(pa.int64()))], ["k1", "k2", "v", "leaves"])

    visits = checkpointed(
        queries.mapInArrow(visiting, "k1 long, k2 long, v array<double>, leaves array<bigint>")
        .select(*KEY, "v", F.explode("leaves").alias("leaf"))
    )
    # blocks of points and of queries: one row for each leaf, so bounded by the tree
    dealing = visits.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("qn")).join(
        F.broadcast(in_leaf.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("xn"))), "leaf")
    dealing = checkpointed(dealing)
    in_block = lambda n: F.pmod(F.xxhash64(F.lit(9), *KEY), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = in_leaf.join(F.broadcast(dealing), "leaf").select("leaf", *KEY, "v", "ids", in_block(F.col("xn")).alias("xb"), every(F.col("qn")).alias("qb"))
    right = visits.join(F.broadcast(dealing), "leaf").select("leaf", *KEY, "v", every(F.col("xn")).alias("xb"), in_block(F.col("qn")).alias("qb"))

    def compared(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"k1": [], "k2": [], "score": [], "ids": []}
        if len(points) and len(queries):
            points = points.assign(low=[i[0] for i in points["ids"]]).sort_values("low", kind="stable")
            px, ids = np.stack(points["v"].to_numpy()), points["ids"].to_numpy()
            for start in range(0, len(queries), 256):
                part = queries.iloc[start:start + 256]
                score = np.stack(part["v"].to_numpy()) @ px.T
                best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                for name in KEY:
                    out[name].append(np.repeat(part[name].to_numpy(), best.shape[1]))
                out["score"].append(np.take_along_axis(score, best, axis=1).ravel())
                out["ids"].extend(ids[best.ravel()])
        flat = {n: np.concatenate(out[n]) if out[n] else np.zeros(0) for n in ("k1", "k2", "score")}
        return pd.DataFrame({**flat, "ids": pd.Series(out["ids"], dtype=object)})

    on = ["leaf", "xb", "qb"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(compared, "k1 long, k2 long, score double, ids array<bigint>")
    best = found.withColumn("r", F.row_number().over(W.partitionBy(*KEY).orderBy(F.desc("score"), F.col("ids")[0]))).where(F.col("r") <= k + 1)
    pairs = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("id")))
    lists = best.groupBy(*KEY).agg(F.array_sort(F.flatten(F.collect_list(pairs))).alias("near"))
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("query_id")), 1, k)
    return (
        asking.withColumnRenamed("vec_id", "query_id").join(lists, KEY)
        .select("query_id", F.posexplode(others).alias("place", "n"))
        .select("query_id", (F.col("place") + 1).alias("rank"), F.col("n.id").alias("vec_id"), (-F.col("n.s")).alias("score"))
    )
