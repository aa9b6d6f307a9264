"""Vector codes against full search, byte-level encoding against the library."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from slyglot.llm import byte_bpe, cell_codes
from slyglot.llm.queries import byte_ranks

from .helpers import awkward, empty

VECTORS = "vec_id long, embedding array<double>, label int, code string, v double, _salt int"


def full_search(rows):
    """codes, errors and codebooks by measuring every entry for every part."""
    kept = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    x = np.floor(np.array([r[1] for r in kept]) * 4096).astype(np.int64)
    first = {}
    for r, v in zip(kept, x.tolist()):
        if r[0] is not None:
            first[r[0]] = min(first.get(r[0], v), v)
    size = x.shape[1] // 8
    start = np.array([first[i] for i in sorted(first)[:16]])
    books = [start[:, p * size:(p + 1) * size].copy() for p in range(8)]

    def distances():
        return [((x[:, None, p * size:(p + 1) * size] - books[p]) ** 2).sum(axis=2) for p in range(8)]

    for _ in range(6):
        for p, far in enumerate(distances()):
            of = far.argmin(axis=1)
            for e in range(len(books[p])):
                if (of == e).any():
                    books[p][e] = x[of == e, p * size:(p + 1) * size].sum(axis=0) // (of == e).sum()
    far = distances()
    errors = sum(f.min(axis=1) for f in far).tolist()
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    sums = {}
    for r, e in zip(kept, errors):
        sums[r[2]] = sums.get(r[2], 0) + e
    codes = ["".join(f"{f[i].argmin():02x}" for f in far) for i in range(len(kept))]
    return [(r[0], c, e, sums[r[2]], sha) for r, c, e in zip(kept, codes, errors)]


def coded(frame):
    return sorted(map(tuple, cell_codes.encode(frame).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_codes_equal_full_search(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet").repartition(5)
    rows = [(r.vec_id, list(r.embedding), r.label) for r in frame.collect()]
    assert coded(frame) == sorted(full_search(rows), key=repr)


@pytest.mark.parametrize("seed,ids", [(1, 60), (2, 9), (3, 200)])
def test_awkward_vectors(spark, seed, ids):
    rng = np.random.default_rng(seed)
    grid = lambda: (rng.integers(-3, 4, 16) / 4096).tolist()  # noqa: E731  many ties and equal parts
    rows = [(int(rng.integers(ids)), grid(), rng.choice([None, 1, 2])) for _ in range(300)]
    rows = [r if i % 9 else (None, *r[1:]) for i, r in enumerate(rows)]
    rows += [rows[7]] * 20 + [(500, None, 1), (501, [], 1), (502, [None] * 16, 1), (503, [float("nan")] * 16, None), (504, [float("inf")] * 16, 2), (505, [0.0] * 16, None), (506, (rng.normal(size=16) * 1000).tolist(), 2)]
    frame = spark.createDataFrame([(i, v, None if n is None else int(n), "c", 0.5, 3) for i, v, n in rows], VECTORS).repartition(4)
    assert coded(frame) == sorted(full_search(rows), key=repr)


def test_no_vectors_no_ids_and_odd_lengths(spark):
    make = lambda rows: spark.createDataFrame([(i, v, None, "c", 0.5, 3) for i, v in rows], VECTORS)
    assert coded(make([])) == [] and coded(make([(1, None), (2, [])])) == []
    assert [r[:3] for r in coded(make([(None, [1.0] * 8)]))] == [(None, "", 0)]
    some = coded(make([(1, [0.5] * 10), (2, [0.25] * 10), (3, [1.0])]))
    assert [r[0] for r in some] == [1, 2] and all(len(r[1]) == 16 and r[2] == 0 for r in some)
    huge = coded(make([(1, [1e300] * 8), (2, [-1e300] * 8)]))
    assert [r[1] for r in huge] == ["00" * 8, "01" * 8]


def test_no_undominated_entry_is_nearer_than_the_chosen_one():
    rng = np.random.default_rng(0)
    book = rng.integers(-2000, 2000, (16, 8))
    index, parts = cell_codes.CellIndex(book), rng.integers(-3000, 3000, (20_000, 8))
    found, far = index.nearest(parts)
    every = ((parts[:, None] - book) ** 2).sum(axis=2)
    assert (found == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert index.measured < 0.75 * every.size


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(*byte_ranks())


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=byte_ranks()[1], mergeable_ranks=codec.ranks, special_tokens={})


def test_encoding_equals_the_library(codec, library):
    rng = random.Random(3)
    texts = ["", "a", "x" * 100_000, "ab" * 30_000, "日本語" * 3000, " " * 2000 + "x\n\n y", "<|endoftext|>", "\x00\x1c\x85   z"]
    texts += [f"a{chr(i)}b {chr(i)}{chr(i)} 1{chr(i)}2" for i in range(0, 0x110000, 7) if not 0xD800 <= i < 0xE000]
    texts += ["".join(rng.choice("abcdefgh'sтеst é😀 \n\t1.") for _ in range(rng.randint(1, 300))) for _ in range(1500)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 600))) for _ in range(800)]
    found = codec.encode_many(texts)
    assert found == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(ids).decode() for ids in found] == texts


def test_every_pair_is_found_and_no_other(codec):
    keys = np.array(list(codec.pairs), np.int64)
    mask = (1 << byte_bpe.HALF) - 1
    assert codec.table.find(keys >> byte_bpe.HALF, keys & mask).tolist() == list(codec.pairs.values())
    left, right = np.random.default_rng(0).integers(-1, 50_256, (2, 200, 300))
    want = [[codec.pairs.get((a << byte_bpe.HALF) | b, byte_bpe.NONE) if min(a, b) >= 0 else byte_bpe.NONE for a, b in zip(*row)] for row in zip(left.tolist(), right.tolist())]
    assert codec.table.find(left, right).tolist() == want


def test_documents_and_awkward_rows(spark, sf_dir, library):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), awkward(spark), empty(spark)):
        encoded = byte_bpe.encode(docs, *byte_ranks())
        want = []
        for r in docs.collect():
            ids = library.encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert sorted(map(tuple, encoded.drop("ids").collect()), key=repr) == sorted(want, key=repr)
        texts = byte_bpe.decode(encoded, *byte_ranks()).collect()
        assert sorted(((r.doc_id, r.text) for r in texts), key=repr) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)
