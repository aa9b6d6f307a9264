"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, seeded by its code point, so that no two
letters share one, of whatever script. A letter n-gram is bound to one vector: the vectors
of its letters, permuted (rotated) once for each place from the end, multiplied element by
element. A text is the bundle, that is the sum, of its n-gram vectors, and a language's
prototype is the bundle of its training texts. Texts go to the prototype of the largest
cosine.

Bundling is linear, so a text's n-grams are counted first and each different one is bound
once. Signs are kept as bits, so a product is an exclusive or. Prototypes are made centred
on their common part, which all languages share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fold, hashed_share, whole_text

FOLDS, HELD_OUT = 4, 2
#: A multiple of 64; a rotation moves 64 places.
DIMENSION = 1024
ORDER = 3
SEED = 5
#: About how many labelled documents the prototypes are made from at most.
SAMPLE = 20_000
#: Bits of a code point, so that an n-gram is one integer.
POINT = 21
#: N-grams bound together, and texts and their characters that share them.
BLOCK = 1024
CHUNK_TEXTS, CHUNK_CHARS = 64, 200_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letter_of() -> np.ndarray:
    """The lower-cased letter of every code point, as a code point; 0 for all that part words."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            table[point] = ord(letter.lower()[0])
    return table


def letter_bits(points: np.ndarray) -> np.ndarray:
    """The vector of each code point as bits in 64-bit words; a set bit is -1. 0 stands between words."""
    words = np.arange(DIMENSION // 64, dtype=np.uint64)
    x = (points.astype(np.uint64)[:, None] << np.uint64(8)) + words + np.uint64(SEED << 40)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (29, 0xD6E8FEB86659FD93)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of a text's letters, `POINT` bits a letter, and how often each occurs; none without letters."""
    letters = _letter_of()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    if not letters.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = np.r_[0, letters, 0].astype(np.int64)
    letters = letters[np.r_[True, (letters[1:] > 0) | (letters[:-1] > 0)]]
    codes = letters[: len(letters) - ORDER + 1]
    for place in range(1, ORDER):
        codes = (codes << POINT) | letters[place: len(letters) - ORDER + 1 + place]
    return np.unique(codes, return_counts=True)


def _bound(grams: np.ndarray) -> np.ndarray:
    """The vector of each n-gram as bits, one byte each; 1 is -1."""
    bits = np.zeros((len(grams), DIMENSION // 64), np.uint64)
    for place in range(ORDER):  # from the last letter, which is not rotated
        letters, of = np.unique((grams >> (POINT * place)) & ((1 << POINT) - 1), return_inverse=True)
        bits ^= np.roll(letter_bits(letters), place, axis=1)[of]
    return np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")


def bundles(texts: list[str]) -> np.ndarray:
    """The vector of each text, a row; zero without letters.

    Texts go in chunks of bounded characters, a longer one alone. The n-grams of a chunk
    are bound once, in blocks, each of which is one matrix product with the counts.
    """
    total = np.zeros((len(texts), DIMENSION))
    first = 0
    while first < len(texts):
        last, chars = first + 1, len(texts[first])
        while last < len(texts) and last - first < CHUNK_TEXTS and chars + len(texts[last]) <= CHUNK_CHARS:
            chars += len(texts[last])
            last += 1
        found = [gram_counts(text) for text in texts[first:last]]
        row = np.repeat(np.arange(last - first), [len(grams) for grams, _ in found])
        grams, of = np.unique(np.concatenate([grams for grams, _ in found]), return_inverse=True)
        times = np.concatenate([counts for _, counts in found])
        exact = np.float32 if chars < 1 << 24 else np.float64  # whole numbers up to the characters
        by_gram = np.argsort(of, kind="stable")
        ends = np.searchsorted(of[by_gram], np.arange(0, len(grams) + BLOCK, BLOCK))
        for block, (begin, end) in enumerate(zip(ends[:-1], ends[1:])):
            at, start = by_gram[begin:end], block * BLOCK
            held = np.zeros((last - first, len(grams[start:start + BLOCK])), exact)
            held[row[at], of[at] - start] = times[at]
            total[first:last] += held.sum(axis=1, keepdims=True) - 2 * (held @ _bound(grams[start:start + BLOCK]).astype(exact))
        first = last
    return total


def bundle(text: str) -> np.ndarray:
    """The vector of one text."""
    return bundles([text])[0]


def _of_column(texts: pa.Array) -> np.ndarray:
    """The vectors of a column, a slice of which is held as strings."""
    parts = [bundles(texts.slice(at, CHUNK_TEXTS).to_pylist()) for at in range(0, len(texts), CHUNK_TEXTS)]
    return np.concatenate(parts) if parts else np.zeros((0, DIMENSION))


def prototypes(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and their centred unit prototypes.

    Learned from about `sample` documents at most, which have an id, a language and are
    not held out. What reaches the driver is one vector per language. Each text counts
    alike, however long.
    """
    usable = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    share = min(1.0, sample / max(1, usable.count()))
    chosen = usable.where(hashed_share(F.col("doc_id"), share)) if share < 1 else usable

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, vector in zip(batch.column(0).to_pylist(), _of_column(batch.column(1))):
                length = np.linalg.norm(vector)
                if length:
                    # Whole numbers add up to the same sums in any order.
                    sums[lang] = sums.get(lang, 0) + np.rint(vector / length * 1e6).astype(np.int64)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(list(sums), pa.string()), "v": pa.array(list(sums.values()), pa.list_(pa.int64()))
        })

    parts = chosen.select("lang", whole_text().alias("text")).mapInArrow(bundled, "lang string, v array<bigint>")
    total = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = total.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("lang").collect()
    vectors = np.array([[e.x for e in row.v] for row in rows], np.float64).reshape(-1, DIMENSION)
    return [row.lang for row in rows], _centred(vectors)


def _centred(vectors: np.ndarray) -> np.ndarray:
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    if len(unit) > 1:
        unit = unit - unit.mean(axis=0)
        unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    return unit


def identify(docs: DataFrame, languages: list[str], profiles: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    The score is the cosine with the chosen prototype, moved from -1..1 to 0..1. NULL
    texts, texts without a letter, and all texts where no language was learned are `und`
    with score 0. Very long texts are read whole. Ties go to the language first in order;
    repeated rows are judged alike; a NULL id is not held out; other columns are not carried.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*languages, UNKNOWN]
        for batch in batches:
            vectors = _of_column(batch.column(2))
            lengths = np.linalg.norm(vectors, axis=1)
            known = (lengths > 0) & (len(languages) > 0)
            best, score = np.full(len(vectors), len(languages)), np.zeros(len(vectors))
            if known.any():
                cosine = vectors[known] @ profiles.T / lengths[known, None]
                best[known] = cosine.argmax(axis=1)
                score[known] = np.clip((cosine.max(axis=1) + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "held_out": batch.column(1),
                "lang_pred": [names[i] for i in best], "score": score,
            })

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), whole_text().alias("text"))
    return picked.mapInArrow(judged, "doc_id long, held_out boolean, lang_pred string, score double")
