"""Anchors of substring patterns: the rarest q-gram of each, and a Bloom filter of them all.

A text that contains a pattern contains each of its q-grams. So a pattern is looked for
only where one of them stands, and the one that a sample of the texts shows least often
is its anchor. The scan hashes the q-grams at all positions of a batch of texts at once,
in numpy, and looks them up in a filter of all anchors: few as a sorted list, more as a
Bloom filter of bounded size. Sample and filter decide how much is looked at, never what
is found: what passes is joined with the patterns, which are then looked for in the text
around it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lengths of anchors, each made of two shorter ones; a pattern has the longest that it can hold.
GRAMS = (1, 2, 3, 4, 6, 8, 12, 16)
HALVES = {2: (1, 1), 3: (2, 1), 4: (2, 2), 6: (4, 2), 8: (4, 4), 12: (8, 4), 16: (8, 8)}
#: Texts in which q-grams are counted.
SAMPLE_ROWS = 1000
#: Slots that q-grams are counted in, by hash.
SLOTS = 1 << 20
#: Bits of the filter for each anchor, and its words of 64 bits at most (64 MB).
BITS_PER_ANCHOR = 16
MOST_WORDS = 1 << 23
#: Words of a page of the filter, in which all bits of an anchor are, and the low bits of a hash that place one.
PAGE_WORDS = 1 << 12
PLACE_BITS = 18
PROBES = 5
#: Characters that are hashed together, of several texts or of a piece of a longer one.
CHUNK_CHARS = 100_000
#: Bytes of text that a batch of found places takes along at most, but for a single place.
BATCH_BYTES = 1 << 24


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def gram_hashes(points: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """The hash of the q-gram at each position, for every wanted length; shorter arrays for longer ones."""
    needed = set(sizes)
    for q in reversed(GRAMS):
        needed.update(HALVES.get(q, ()) if q in needed else ())
    made = {1: _mixed(points.astype(np.uint64) + np.uint64(1))}
    for q in GRAMS[1:]:  # halves come before what is made of them
        if q in needed:
            (h, _), n = HALVES[q], max(0, len(points) - q + 1)
            head, tail = (made[half] for half in HALVES[q])
            made[q] = _mixed(head[:n] * np.uint64(2 * q + 1) + tail[h:h + n])
    return {q: made[q] for q in sizes}


def pieces(text: str, sizes: list[int]) -> Iterator[tuple[int, dict[int, np.ndarray]]]:
    """The start of each piece of a text, and the hashes of the q-grams that begin in it, however long the text is."""
    for start in range(0, len(text), CHUNK_CHARS):
        points = points_of(text[start:start + CHUNK_CHARS + max(sizes, default=1) - 1])
        yield start, {q: found[:CHUNK_CHARS] for q, found in gram_hashes(points, sizes).items()}


@dataclass
class AnchorFilter:
    """The hashes of all anchors: sorted, or as the words of a Bloom filter."""

    sizes: list[int]
    hashes: np.ndarray | None = None
    words: np.ndarray | None = None

    def passed(self, found: np.ndarray) -> np.ndarray:
        """The indices of the hashes that pass; each bit is looked up only for those that passed so far."""
        if self.hashes is not None:
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            return np.flatnonzero(self.hashes[at] == found)
        left = np.arange(len(found))
        for probe in range(PROBES):
            place = placed_bits(found if probe == 0 else found[left], len(self.words), probe)
            left = left[(self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
        return left

    def test(self, found: np.ndarray) -> np.ndarray:
        mask = np.zeros(len(found), bool)
        mask[self.passed(found)] = True
        return mask


def page_of(hashes: np.ndarray, words: int) -> np.ndarray:
    """The page of the filter that a hash has its bits in, by its high bits."""
    return (hashes >> np.uint64(40)) & np.uint64(max(1, words // PAGE_WORDS) - 1)


def placed_bits(hashes: np.ndarray, words: int, probe: int) -> np.ndarray:
    """The place in the filter of one of the bits of each hash."""
    bits = _mixed(hashes) if probe > 1 else hashes
    within = (bits >> np.uint64(PLACE_BITS * (probe - 2 if probe > 1 else probe))) & np.uint64(min(words, PAGE_WORDS) * 64 - 1)
    return page_of(hashes, words) * np.uint64(PAGE_WORDS * 64) + within


def gram_counts(texts: DataFrame, sizes: list[int]) -> np.ndarray:
    """How often q-grams stand in a sample of ``texts.text``, by the low bits of their hash.

    The sample is in one task or a few, and the driver gets the ``SLOTS`` counts of each.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(SLOTS, np.int32), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, hashes in pieces(text or "", sizes):
                    for found in hashes.values():
                        held.append((found & np.uint64(SLOTS - 1)).astype(np.int64))
                        n += len(found)
                    if n > SLOTS:
                        total += np.bincount(np.concatenate(held), minlength=SLOTS).astype(np.int32)
                        held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=SLOTS).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"counts": pa.array([total.tobytes()], pa.binary())})

    sample = texts.select(F.lower("text").alias("text")).limit(SAMPLE_ROWS)
    held = [np.frombuffer(r.counts, np.int32) for r in sample.mapInArrow(counted, "counts binary").collect()]
    return np.sum(held, axis=0, dtype=np.int64) if held else np.zeros(SLOTS, np.int64)


def anchored(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """``(pattern, q, anchor, gram)``: the rarest q-gram of each pattern in a sample of ``texts.text``, and its hash.

    Of equally rare ones a hashed one, so that patterns that share words rarely share an
    anchor. A narrow pass over the patterns, many at once.
    """
    q = F.lit(GRAMS[0])
    for size in GRAMS[1:]:
        q = F.when(F.length("pattern") >= size, F.lit(size)).otherwise(q)
    sized = patterns.select("pattern", q.alias("q"))
    counts = gram_counts(texts, sorted(r.q for r in sized.select("q").distinct().collect()))  # at most one for each length of GRAMS

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch, 0):
                patterns, q = part.column(0).to_pylist(), np.asarray(part.column(1))
                begins, grams = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.uint64)
                for size in np.unique(q).tolist():
                    rows = np.flatnonzero(q == size)
                    begins[rows], grams[rows] = rarest([patterns[i] for i in rows.tolist()], size, counts)
                anchors = [p[at:at + n] for p, at, n in zip(patterns, begins.tolist(), q.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(anchors, pa.string()), pa.array(grams.view(np.int64))], ["pattern", "q", "anchor", "gram"])

    return sized.mapInArrow(chosen, "pattern string, q int, anchor string, gram long")


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))


def rarest(patterns: list[str], q: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the rarest q-gram of each pattern begins, and its hash; patterns have ``q`` characters at least."""
    lengths = np.array([len(p) for p in patterns])
    begins, n = np.cumsum(lengths) - lengths, lengths - q + 1
    firsts = np.cumsum(n) - n
    found = gram_hashes(points_of("".join(patterns)), [q])[q][_ranges(begins, n)]
    seen = counts[(found & np.uint64(SLOTS - 1)).astype(np.int64)]
    tied = np.flatnonzero(seen == np.repeat(np.minimum.reduceat(seen, firsts), n))
    before = np.searchsorted(tied, firsts)
    n_tied = np.diff(np.r_[before, len(tied)])
    digests = np.array([zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in patterns], np.int64)
    at = tied[before + digests % n_tied]
    return at - firsts, found[at]


def _hashes(anchors: list[str]) -> np.ndarray:
    lengths = np.array([len(a) for a in anchors], np.int64)
    made = np.zeros(len(anchors), np.uint64)
    for q in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == q)
        made[rows] = gram_hashes(points_of("".join(anchors[i] for i in rows.tolist())), [q])[q][::q]
    return made


def anchor_filter(placed: DataFrame, most_listed: int) -> AnchorFilter:
    """The filter over ``placed.anchor``. The driver gets the list, or the filter's pages, each made by one task."""
    sizes = sorted(r.q for r in placed.select("q").distinct().collect())  # at most one for each length of GRAMS
    known = placed.select("anchor")
    few = known.limit(most_listed + 1).collect()
    if len(few) <= most_listed:
        return AnchorFilter(sizes, hashes=np.unique(_hashes([r.anchor for r in few])))
    wanted = max(1, -(-known.count() * BITS_PER_ANCHOR // 64))
    words = min(MOST_WORDS, 1 << (wanted - 1).bit_length())
    size = min(words, PAGE_WORDS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = _hashes(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(page_of(grams, words).astype(np.int32)), pa.array(grams.view(np.int64))], ["page", "gram"])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, touched = np.zeros(words, np.uint64), np.zeros(words // size, bool)
        for batch in batches:
            touched[np.asarray(batch.column(0))] = True
            grams = np.asarray(batch.column(1)).view(np.uint64)
            for probe in range(PROBES):
                place = placed_bits(grams, words, probe)
                np.bitwise_or.at(bits, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        for page in np.flatnonzero(touched).tolist():
            yield pa.RecordBatch.from_pydict({"page": pa.array([page], pa.int32()), "bits": pa.array([bits[page * size:(page + 1) * size].tobytes()], pa.binary())})

    pages = known.mapInArrow(hashed, "page int, gram long").repartition("page").mapInArrow(filled, "page int, bits binary")
    made = np.zeros((words // size, size), np.uint64)
    for r in pages.collect():  # the filter itself, at most MOST_WORDS
        made[r.page] = np.frombuffer(r.bits, np.uint64)
    return AnchorFilter(sizes, words=made.reshape(-1))


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `CHUNK_CHARS` bytes of text in a column; a longer text is alone."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0))
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and size + n > CHUNK_CHARS:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield batch.slice(first)


def cut_out(text: str, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, pa.Array]]:
    """The ranges ``text[begin:end]`` as arrays of up to about `BATCH_BYTES`, each with the first and last range that it has."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) > len(text):
        starts = np.r_[np.flatnonzero(data & 0xC0 != 0x80), len(data)]
        begins, ends = starts[begins], starts[ends]
    lengths = ends - begins
    sizes = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(sizes, BATCH_BYTES + (sizes[first - 1] if first else 0), side="right")))
        offsets = np.r_[0, np.cumsum(lengths[first:last])].astype(np.int32)
        held = data[_ranges(begins[first:last], lengths[first:last])]
        yield first, last, pa.StringArray.from_buffers(last - first, pa.py_buffer(offsets), pa.py_buffer(held))
        first = last


def stands(texts: DataFrame, keys: list[str], wanted: list[tuple[AnchorFilter, dict[int, int]]]) -> DataFrame:
    """``(keys, kind, anchor, around)``: where an anchor, by its hash, may stand in ``texts.lowered``, with the text around it.

    ``wanted`` has a filter, and the longest pattern for each length of anchors, for each
    kind of patterns; the texts are read and hashed once for all. Only as much text goes
    along as a pattern with that anchor can cover. A single letter is told once of a text
    and chunk.
    """
    schema = texts.select(*keys).schema.add("kind", "integer").add("anchor", "long").add("around", "string")
    sizes = sorted({q for anchors, _ in wanted for q in anchors.sizes})
    reach = max((n for _, longest in wanted for n in longest.values()), default=0)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch, batch.num_columns - 1):
                texts = part.column(part.num_columns - 1).to_pylist()
                text, ends = "".join(texts), np.cumsum([len(t) for t in texts])
                begins = np.r_[0, ends[:-1]]
                for start, hashes in pieces(text, sizes):
                    rows, kinds, grams, lefts, rights = [], [], [], [], []
                    for kind, (known, longest) in enumerate(wanted):
                        for q in known.sizes:
                            at = known.passed(hashes[q])
                            owner = np.searchsorted(ends, at + start, side="right")
                            inside = at + start + q <= ends[owner]
                            at, owner = at[inside], owner[inside]
                            gram = hashes[q][at]
                            if q == 1:  # hashes of single letters are all different
                                kept = np.unique(np.stack([owner.astype(np.uint64), gram]), axis=1, return_index=True)[1]
                                at, owner, gram = at[kept], owner[kept], gram[kept]
                            rows.append(owner)
                            kinds.append(np.full(len(at), kind, np.int32))
                            grams.append(gram)
                            lefts.append(np.maximum(begins[owner], at + start - longest[q] + q))
                            rights.append(np.minimum(ends[owner], at + start + longest[q]))
                    if not sum(map(len, rows)):
                        continue
                    low = max(0, start - reach)
                    piece = text[low:start + CHUNK_CHARS + reach]
                    rows, kinds, grams = np.concatenate(rows), np.concatenate(kinds), np.concatenate(grams).view(np.int64)
                    for first, last, around in cut_out(piece, np.concatenate(lefts) - low, np.concatenate(rights) - low):
                        picked = part.select(keys).take(pa.array(rows[first:last]))
                        made = [pa.array(kinds[first:last]), pa.array(grams[first:last]), around]
                        yield pa.RecordBatch.from_arrays([*picked.columns, *made], [*keys, "kind", "anchor", "around"])

    return texts.select(*keys, "lowered").mapInArrow(found, schema)
