"""Byte-level BPE: encoding by merge rounds over padded matrices, and decoding.

A text is cut into the matches of the vocabulary's pattern. Different matches ("words")
are encoded together: words of like length are the rows of a padded matrix of token ids,
beside a matrix of the ranks of neighbouring pairs. In each round every row merges its
leftmost pair of least rank, the matrices close the gap and so lose a column, and only the
two pairs beside the merge are looked up anew, in a hash table of pairs. Rows without a
pair leave. A token's id is its rank, so a merge writes the rank it was chosen by.

A word that is itself a token is that token, as in the usual encoder. Words longer than
`WIDEST` bytes would need one round for each merge over a very wide row; they keep their
pairs in a priority queue instead, by (rank, place), which merges in the same order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import whole_text

#: Bits of a token id in one half of a pair key.
HALF = 24
WIDEST = 256
#: Cells of one matrix, characters encoded together, and words remembered by a worker.
CELLS = 1_000_000
CHUNK_CHARS = 2_000_000
REMEMBERED = 300_000
NONE = np.iinfo(np.int32).max


class PairTable:
    """Ranks of pairs of ids in a hash table with linear probing, for whole arrays at once."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] < 0]
            self.keys[slot[first]], self.ranks[slot[first]] = keys[first], ranks[first]
            keys, ranks, slot = (np.delete(a, first) for a in (keys, ranks, slot))
            slot = (slot + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, `NONE` where it does not merge or an id is negative (padding)."""
        keys = (left.astype(np.int64) << HALF) | right
        keys[(left < 0) | (right < 0)] = -2
        out = np.full(keys.shape, NONE, np.int32)
        at, slot = np.flatnonzero(keys >= 0), self._slot(keys[keys >= 0])
        while len(at):
            held = self.keys[slot]
            same = held == keys.ravel()[at]
            out.ravel()[at[same]] = self.ranks[slot[same]]
            on = ~same & (held >= 0)
            at, slot = at[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out


class ByteCodec:
    """The ranks of one vocabulary file and its word pattern."""

    def __init__(self, rank_file: str, pattern: str):
        import regex

        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        # \s in the pattern is Unicode white space, as in the usual encoder
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.raw = {rank: token for token, rank in self.ranks.items()}
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[(left << HALF) | right] = rank
        self.table = PairTable(self.pairs)
        self.memory: dict[str, tuple[int, ...]] = {}

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each word: words of one bucket of lengths share their matrices."""
        found: list[tuple[int, ...]] = [()] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                found[i] = (whole,)
            elif len(word) > WIDEST:
                found[i] = self._queued(word)
            elif word:
                buckets.setdefault((len(word) - 1).bit_length(), []).append(i)
        for width, members in buckets.items():
            rows = max(1, CELLS >> width)
            for start in range(0, len(members), rows):
                part = members[start:start + rows]
                for i, ids in zip(part, self._rounds([words[i] for i in part], 1 << width)):
                    found[i] = ids
        return found

    def _rounds(self, words: list[bytes], width: int) -> list[tuple[int, ...]]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        padded = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[padded], -1)
        pairs = self.table.find(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(words)), [()] * len(words)
        while len(rows):
            at = pairs.argmin(axis=1) if pairs.shape[1] else np.zeros(len(rows), np.int64)
            rank = pairs[np.arange(len(rows)), at] if pairs.shape[1] else np.full(len(rows), NONE)
            for i in np.flatnonzero(rank == NONE).tolist():
                row = ids[i]
                out[rows[i]] = tuple(row[row >= 0].tolist())
            going = rank != NONE
            rows, at, rank, ids, pairs = rows[going], at[going], rank[going], ids[going], pairs[going]
            if not len(rows):
                break
            every, place = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids = np.where(place > at[:, None], ids[:, 1:], ids[:, :-1])
            ids[every, at] = rank
            pairs = np.where(place[:-1] > at[:, None], pairs[:, 1:], pairs[:, :-1])
            after = at < ids.shape[1] - 1
            pairs[every[after], at[after]] = self.table.find(ids[every[after], at[after]], ids[every[after], at[after] + 1])
            before = at > 0
            pairs[every[before], at[before] - 1] = self.table.find(ids[every[before], at[before] - 1], ids[every[before], at[before]])
        return out

    def _queued(self, word: bytes) -> tuple[int, ...]:
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        known = self.table.find(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        queue = [(rank, i, ids[i], ids[i + 1]) for i, rank in enumerate(known) if rank != NONE]
        heapq.heapify(queue)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    made = self.pairs.get((ids[a] << HALF) | ids[b])
                    if made is not None:
                        heapq.heappush(queue, (made, a, ids[a], ids[b]))
        return tuple(i for i in ids if i >= 0)

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        cut = [self.words.findall(text) for text in texts]
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        memory = self.memory
        fresh = list({word for words in cut for word in words if word not in memory})
        memory.update(zip(fresh, self.merge([word.encode() for word in fresh]), strict=True))
        return [list(chain.from_iterable(map(memory.__getitem__, words))) for words in cut]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(rank_file: str, pattern: str) -> ByteCodec:
    return ByteCodec(rank_file, pattern)


def chunks(texts: Iterable[str], most: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about `most` characters in all; a longer text is alone."""
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > most:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


def encode(docs: DataFrame, rank_file: str, pattern: str, digest_only: bool = False) -> DataFrame:
    """Token ids of every whole text.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, ids array<int>; `digest_only`
    leaves the ids out. A NULL or empty text has no ids. Very long texts are encoded whole,
    and so is a very long word. Of pairs of equal rank the leftmost merges first. Repeated
    rows are encoded each, a NULL id is kept, an empty table gives an empty result, and
    other columns are not carried, whatever their names. One narrow pass, in which a lost
    task is simply run again.
    """
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema = columns if digest_only else columns + ", ids array<int>"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(rank_file, pattern)
        names = {i: str(i) for i in model.raw}
        for batch in batches:
            rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for chunk in chunks(t.as_py() for t in batch.column(1)):
                for ids in model.encode_many(chunk):
                    rows["n_tokens"].append(len(ids))
                    rows["ids_sha256"].append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                    rows["decoded_sha256"].append(hashlib.sha256(model.decode(ids)).hexdigest())
                    if not digest_only:
                        rows["ids"].append(np.array(ids, np.int32))
            out = {"doc_id": batch.column(0), **{k: rows[k] for k in ("n_tokens", "ids_sha256", "decoded_sha256")}}
            if not digest_only:
                out["ids"] = pa.array(rows["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return picked.mapInArrow(encoded, schema)


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and text of rows with ids; NULL gives the empty text, bytes that are no UTF-8 U+FFFD."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(rank_file, pattern)
        for batch in batches:
            texts = [model.decode(ids.as_py() or []).decode("utf-8", "replace") for ids in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")
