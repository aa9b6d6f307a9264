"""Vector code compression: product codes by k-means, with memoised grid cells.

Components become integers, and vectors are cut into equal parts with a codebook for each
position. To find the nearest entry of a part, its coarse grid cell is hashed. For a cell
seen for the first time, the least and greatest distance of each entry to the cell's box
are worked out: an entry whose least distance is above the least of all greatest
distances is farther than another one everywhere in the box, so it is dominated. The
entries left are remembered for the cell, and only those are measured exactly, ties to
the lower index. So the codes equal those of a full search.

A round of k-means is one pass: each task adds up counts and sums for its parts, which
Spark adds up over tasks. Only a codebook goes to the tasks, and only its sums come back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.session import scratch_path

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components are held between plus and minus this, so that no error leaves a long.
MOST = 1 << 27
#: Cells remembered by a task for one part, and rows measured together.
CELLS = 200_000
ROWS = 8192
#: Slices of the rows of one label in the join with its sum.
SALTS = 64


class CellIndex:
    """Nearest entries of one codebook, through memoised cells."""

    def __init__(self, book: np.ndarray):
        self.book = book
        spread = int(book.max() - book.min()) if book.size else 0
        # A cell's width is a power of two, about an eighth of the codebook's spread: narrower
        # cells leave fewer entries each, wider ones are met again more often.
        self.shift = max(0, spread.bit_length() - 3)
        self.known: dict[bytes, np.ndarray] = {}
        self.measured = 0

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        """For each cell the entries that can be nearest to some point of its box."""
        low = cells << self.shift
        high = low + (1 << self.shift) - 1
        out = np.empty((len(cells), len(self.book)), bool)
        for start in range(0, len(cells), ROWS):
            lo, hi = low[start:start + ROWS, None, :], high[start:start + ROWS, None, :]
            below, above = lo - self.book, self.book - hi
            least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
            most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
            out[start:start + ROWS] = least <= most.min(axis=1, keepdims=True)
        return out

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part, and its squared distance."""
        cells = np.ascontiguousarray(parts >> self.shift)
        names = cells.view(np.dtype((np.void, cells.shape[1] * 8))).ravel()
        different, first, which = np.unique(names, return_index=True, return_inverse=True)
        keys = [name.tobytes() for name in different]
        if len(self.known) + len(keys) > CELLS:
            self.known.clear()
        fresh = [i for i, key in enumerate(keys) if key not in self.known]
        if fresh:
            self.known.update(zip((keys[i] for i in fresh), self._undominated(cells[first[fresh]])))
        masks = np.stack([self.known[key] for key in keys])[which]
        rows, entries = np.nonzero(masks)
        self.measured += len(rows)
        far = np.full(masks.shape, np.iinfo(np.int64).max)
        far[rows, entries] = ((parts[rows] - self.book[entries]) ** 2).sum(axis=1)
        best = far.argmin(axis=1)
        return best, far[np.arange(len(parts)), best]


def integers(column: pa.Array, width: int) -> np.ndarray:
    """The integer components of usable vectors of `width` components, with zeros up to whole parts."""
    flat = np.asarray(column.flatten(), np.float64).reshape(-1, width)
    floors = np.clip(np.floor(flat * SCALE), -MOST, MOST).astype(np.int64)
    return np.pad(floors, ((0, 0), (0, -width % PARTS)))


def _usable(vectors: DataFrame) -> DataFrame:
    odd = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.where((F.size("v") > 0) & ~odd)


def _measure(books: list[np.ndarray], rows: np.ndarray, indexes: list[CellIndex]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: parts of all rows, their entries and distances."""
    size = rows.shape[1] // PARTS
    for at in range(PARTS if books else 0):
        part = np.ascontiguousarray(rows[:, at * size:(at + 1) * size])
        yield at, part, *indexes[at].nearest(part)


def _sums(books: list[np.ndarray], width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [CellIndex(book) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros(book.shape, np.int64) for book in books]
        for batch in batches:
            rows = integers(batch.column(0), width)
            for start in range(0, len(rows), ROWS):
                for at, part, entry, _ in _measure(books, rows[start:start + ROWS], indexes):
                    counts[at] += np.bincount(entry, minlength=len(books[at]))
                    np.add.at(totals[at], entry, part)
        named = [(at, e, int(n), totals[at][e].tolist()) for at, count in enumerate(counts) for e, n in enumerate(count) if n]
        part, entry, n, total = zip(*named) if named else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))],
            ["part", "entry", "n", "total"])

    return run


def first_books(kept: DataFrame, width: int) -> list[np.ndarray]:
    """Codebooks of the vectors with the smallest ids; ids of several vectors take the least vector."""
    smallest = [r.vec_id for r in kept.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(ENTRIES).collect()]
    rows = kept.where(F.col("vec_id").isin(smallest)).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
    if not rows:
        return []
    vectors = integers(pa.array([r.v for r in rows], pa.list_(pa.float64())), width)
    return [np.ascontiguousarray(part) for part in np.split(vectors, PARTS, axis=1)]


def learn(kept: DataFrame, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks after `rounds` passes. `kept` has vec_id and v, all of `width` components."""
    books = first_books(kept, width)
    for _ in range(rounds if books else 0):
        summed = (
            kept.select("v").mapInArrow(_sums(books, width), "part int, entry int, n long, total array<long>")
            .select("part", "entry", "n", F.posexplode("total").alias("place", "total"))
            .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        )
        books = [book.copy() for book in books]
        for row in summed.collect():  # one row for each number of the codebooks
            books[row.part][row.entry, row.place] = row.total // row.n
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every usable vector.

    `code` has two hex digits for each part, `error` is the squared distance to the
    entries over all parts, `label_error` the sum of errors over rows of the same label,
    NULL labels being one. Vectors that are NULL, empty or hold NULL or non-finite
    components are dropped, and so are those not of the commonest length (of two equally
    common ones, the shorter); a length that parts do not divide is filled up with zeros.
    Components beyond 32,768 either way count as that, and a
    label_error beyond a long as the greatest long. Repeated rows are coded each. Rows
    without an id are coded but start no codebook, nor do further vectors of an id; with
    fewer than 16 ids, codebooks have so many entries, and with none codes are empty, and
    error is 0. An empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    label: Column = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    kept = _usable(rows)
    common = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = common.n if common else 0
    kept = kept.where(F.size("v") == width)
    books = learn(kept, width, rounds)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = [CellIndex(book) for book in books]
        for batch in batches:
            rows = integers(batch.column(2), width)
            error, code = np.zeros(len(rows), np.int64), np.zeros((len(rows), PARTS if books else 0), np.uint8)
            for start in range(0, len(rows), ROWS):
                for at, _, entry, far in _measure(books, rows[start:start + ROWS], indexes):
                    code[start:start + ROWS, at] = entry
                    error[start:start + ROWS] += far
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"])

    name = kept.schema["label"].dataType.simpleString()
    path = scratch_path(spark, "codes")
    kept.mapInArrow(coded, f"vec_id long, label {name}, code string, error long").write.parquet(path)
    codes = spark.read.parquet(path)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)"))
    sums = codes.groupBy("label").agg(total.cast("long").alias("label_error"))
    salted = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    dealt = codes.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return (
        dealt.join(salted, F.col("label").eqNullSafe(F.col("_label")) & (dealt["_salt"] == salted["_salt"]))
        .select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
    )
