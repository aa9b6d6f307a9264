"""SentencePiece BPE: encoding by vectorised merge rounds, and decoding.

Texts are cut where no piece of the vocabulary can cross: before a run of spaces that
follows another character, and, if no piece crosses there, around line feeds and between
letters and other characters. Distinct words
of a chunk are then encoded together. All symbols lie in one flat array. In each round
every word takes its best pair (the pair whose merged piece has the highest score),
merges all of its occurrences from the left, and the array is compacted; a word without a
mergeable pair is finished. The result equals that of the sequential algorithm:

- pairs that overlap are in a run of neighbours; every second one of a run is merged,
  which is what merging from the left does;
- after a merge, a new pair could only come first if its piece scores at least as high as
  the piece just made. Such pieces ("open") are found in the vocabulary beforehand, and
  of those only the leftmost pair of a word is merged in a round. A word that needs more
  than `ROUNDS` rounds, such as thousands of spaces, is finished with a priority queue.

Characters outside the vocabulary become their UTF-8 bytes' pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import whole_text

SPACE = "▁"
#: Room for a character's code point behind the vocabulary, in one half of a pair key.
HALF = 22
#: Characters encoded together, and words remembered by a worker.
CHUNK_CHARS = 2_000_000
REMEMBERED = 300_000
ROUNDS = 200
#: Cells of a pair table, as a power of two.
CELLS = 21
LETTER = r"[^\W\d_]"


class PieceCodec:
    """The vocabulary of one model file, as arrays for merge rounds and decoding."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        reserved = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        self.size, self.bos, self.eos, self.unk = size, model.bos_id(), model.eos_id(), model.unk_id()
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        ids = {name: i for i, name in enumerate(names) if not reserved[i]}
        scores = {i: model.get_score(i) for i in ids.values()}
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self._pairs(ids, scores, ranks)
        self.char_ids = np.arange(size, size + 0x110000)
        for name, i in ids.items():
            if len(name) == 1:
                self.char_ids[ord(name)] = i
        self.char_ids[32] = self.char_ids[ord(SPACE)]
        self.cut = re.compile(self._cut_pattern(ids), re.S)
        self.raw = [b"" if model.is_control(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)]
        self.raw[self.unk] = " ⁇ ".encode()
        for b, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([b])
        self.memory: dict[str, bytes] = {}

    @staticmethod
    def _cut_pattern(names: Iterable[str]) -> str:
        bare = [name.lstrip(SPACE) for name in names]
        if any(SPACE in name for name in bare):
            return r".+"
        if any("\n" in name for name in names):
            return r" +[^ ]*|[^ ]+"
        kinds = (re.sub(LETTER, "a", name) for name in bare)
        if any("a" in kind and kind.strip("a") for kind in kinds):
            return r"\n| +[^ \n]*|[^ \n]+"
        return rf" *{LETTER}+| *(?:[^\w \n]|[\d_])+| +|\n"

    def _pairs(self, ids: dict[str, int], scores: dict[int, float], ranks: dict[float, int]) -> None:
        keys, merged, rank, made_of = [], [], [], []
        for name, i in ids.items():
            for at in range(1, len(name)):
                left, right = ids.get(name[:at]), ids.get(name[at:])
                if left is not None and right is not None:
                    keys.append((left << HALF) | right)
                    merged.append(i)
                    rank.append(ranks[scores[i]])
                    made_of += [p for p in (left, right) if scores[i] >= scores[p]]
        self.keys = np.array([*keys, -1], np.int64)
        self.merged = np.array([*merged, 0], np.int64)
        self.rank = np.array([*rank, np.iinfo(np.int64).max], np.int64)
        self.tables = self._cells(self.keys[:-1])
        self.open = np.zeros(self.size, bool)
        self.open[made_of] = True

    @staticmethod
    def _cells(keys: np.ndarray) -> list[tuple[np.uint64, np.ndarray]]:
        """Hash tables of positions in `keys`; what collides in one goes to the next."""
        tables, left, random = [], np.arange(len(keys)), np.random.default_rng(0)
        while len(left):
            factor = random.integers(1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            cell = (keys[left].astype(np.uint64) * factor) >> np.uint64(64 - CELLS)
            _, first = np.unique(cell, return_index=True)
            table = np.full(1 << CELLS, len(keys), np.int32)
            table[cell[first]] = left[first]
            tables.append((factor, table))
            left = np.delete(left, first)
        return tables

    def _find(self, pairs: np.ndarray) -> np.ndarray:
        """Positions of the pairs in `keys`; the last position for those not there."""
        found, unsigned = np.full(len(pairs), len(self.keys) - 1, np.int32), pairs.astype(np.uint64)
        for factor, table in self.tables:
            at = table[(unsigned * factor) >> np.uint64(64 - CELLS)]
            hit = self.keys[at] == pairs
            found[hit] = at[hit]
        return found

    def words(self, text: str) -> list[str]:
        """The pieces of the text between which nothing can merge."""
        return self.cut.findall(" " + text.replace(SPACE, " ")) if text else []

    def _symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        return self.char_ids[points], np.repeat(np.arange(len(words)), lengths)

    def merge(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        symbols, owner = self._symbols(words)
        done_symbols, done_owner = [], []
        worst, rounds = np.iinfo(np.int64).max, 0
        while len(symbols):
            rounds += 1
            if rounds > ROUNDS:
                symbols, owner = self._queued(symbols, owner)
            at = self._find((symbols[:-1] << HALF) | symbols[1:])
            rank = np.full(len(symbols), worst)
            rank[:-1] = np.where(owner[:-1] == owner[1:], self.rank[at], worst)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            going = np.repeat(best != worst, sizes)
            if not going.all():
                done_symbols.append(symbols[~going])
                done_owner.append(owner[~going])
            hit = going & (rank == np.repeat(best, sizes))
            where = np.flatnonzero(hit)
            made = self.merged[at[where]]
            fresh = np.r_[True, where[1:] != where[:-1] + 1] if len(where) else np.zeros(0, bool)
            offset = where - where[np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))] if len(where) else where
            take = offset % 2 == 0
            if self.open[made].any():
                first = np.r_[True, owner[where[1:]] != owner[where[:-1]]]
                opened = np.zeros(int(owner[-1]) + 1, bool)
                opened[owner[where[self.open[made]]]] = True
                take &= first | ~opened[owner[where]]
            where, made = where[take], made[take]
            symbols = symbols.copy()
            symbols[where] = made
            going[where + 1] = False
            symbols, owner = symbols[going], owner[going]
        symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        owner = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        symbols, owner = symbols[order], owner[order]
        ends = np.searchsorted(owner, np.arange(len(words)), side="right")
        odd = set(owner[symbols >= self.size].tolist())
        buffer, start = symbols.astype("<u4").tobytes(), 0
        for word, end in enumerate(ends.tolist()):
            if word in odd:
                yield np.array([i for s in symbols[start:end].tolist() for i in self._fallback(s)], "<u4").tobytes()
            else:
                yield buffer[4 * start:4 * end]
            start = end

    def _queued(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words with all their merges done, each by a queue of pairs."""
        done, owners = [], []
        for word in np.unique(owner):
            now = symbols[owner == word].tolist()
            size = len(now)
            after, before = [*range(1, size), -1], [-1, *range(size - 1)]
            known = self._find((np.array(now[:-1], np.int64) << HALF) | np.array(now[1:], np.int64))
            queue = [(int(self.rank[k]), i, now[i], now[i + 1], int(self.merged[k]))
                     for i, k in enumerate(known.tolist()) if k < len(self.keys) - 1]
            heapq.heapify(queue)
            while queue:
                _, i, left, right, made = heapq.heappop(queue)
                j = after[i]
                if now[i] != left or j < 0 or now[j] != right:
                    continue
                now[i], now[j], after[i] = made, -1, after[j]
                if after[i] >= 0:
                    before[after[i]] = i
                for a, b in ((before[i], i), (i, after[i])):
                    if a >= 0 and b >= 0:
                        k = int(self._find(np.array([(now[a] << HALF) | now[b]]))[0])
                        if k < len(self.keys) - 1:
                            heapq.heappush(queue, (int(self.rank[k]), a, now[a], now[b], int(self.merged[k])))
            kept = [s for s in now if s >= 0]
            done.append(np.array(kept, np.int64))
            owners.append(np.full(len(kept), word))
        return np.concatenate(done), np.concatenate(owners)

    def _fallback(self, symbol: int) -> list[int]:
        if symbol < self.size:
            return [symbol]
        return [self.byte_ids[b] for b in chr(symbol - self.size).encode()]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with begin and end ids."""
        cut = [self.words(text) for text in texts]
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        memory = self.memory
        fresh = list({word for words in cut for word in words if word not in memory})
        memory.update(zip(fresh, self.merge(fresh), strict=True))
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.bos, self.eos))
        return [np.frombuffer(b"".join([begin, *map(memory.__getitem__, words), end]), "<u4") for words in cut]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a list of ids; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if self.raw[i]), None)
        if first is not None and self.raw[first][:1] == b" " and first != self.unk:
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)


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


def encode(docs: DataFrame, model_file: str, digest_only: bool = False) -> DataFrame:
    """Token ids of every whole text.

    Returns doc_id, ids array<int>, n_tokens, ids_sha256, decoded_sha256; `digest_only`
    leaves the ids out. A NULL text counts as empty and has the begin and end ids only.
    Repeated rows are encoded each; other columns are not carried. One narrow pass, in
    which a lost task is simply run again.
    """
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema = columns if digest_only else columns + ", ids array<int>"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(model_file)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for chunk in chunks(t.as_py() for t in texts):
                for found in model.encode_many(chunk):
                    rows["n_tokens"].append(len(found))
                    rows["ids_sha256"].append(hashlib.sha256(found).hexdigest())
                    text = model.decode(found.tolist())
                    rows["decoded_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
                    if not digest_only:
                        rows["ids"].append(found.astype(np.int32))
            out = {"doc_id": ids, **{k: rows[k] for k in ("n_tokens", "ids_sha256", "decoded_sha256")}}
            if not digest_only:
                out["ids"] = pa.array(rows["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return picked.mapInArrow(encoded, schema)


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of rows with ids; a NULL list gives the empty text."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(model_file)
        for batch in batches:
            texts = [model.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")
