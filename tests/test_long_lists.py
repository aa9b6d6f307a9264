"""Long lists of patterns, terms and words against plain search."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slyglot.functions.phonetic import phonetic_key
from slyglot.lexicons import IMAGE_LABEL, TS_LABEL
from slyglot.operators import anchors, collect, lexicon_join, trigram_index
from slyglot.operators.lexicon_prep import phonetic_vocabulary
from slyglot.operators.trigram_index import TrigramIndex
from slyglot.plans.oracles import ORACLES
from slyglot.plans.queries import QUERIES
from tests.compare import connect, differences
from tests.test_plans import built_sides, plan_of

POSTS = "post_id long, url string, text string"


def made_words(rng, n, letters="abcdé😀k", most=7):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n)]


def made_posts(seed, n=700):
    rng = random.Random(seed)
    words = made_words(rng, 200)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [(i, f"u{i}", t) for i, t in enumerate([*texts, "", None, "a", "xy", "É", "İab", "z" * 5000 + "end"])], words


def patterns_of(rng, rows, words):
    listed = {*words, "a", "é", "zz", "never there", "z" * 300 + "end", "İab".lower(), ""}
    for _, _, text in rows[:60]:
        if text and len(text) > 30:
            begin = rng.randint(0, 10)
            listed.add(text[begin:begin + rng.choice([12, 30, 64, 65, 150])].lower())
    return sorted(listed)


@pytest.mark.parametrize("listed", [10_000, 0])
@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_patterns_are_found_by_their_anchors(spark, monkeypatch, listed, broadcast):
    """As a list or as a Bloom filter of anchors, joined by broadcast or by shuffle."""
    for name, value in (("INLINE_PATTERNS", 0), ("INLINE_ANCHORS", listed), ("BROADCAST_ROWS", broadcast)):
        monkeypatch.setattr(lexicon_join, name, value)
    rows, words = made_posts(1)
    patterns = patterns_of(random.Random(2), rows, words)
    frame = spark.createDataFrame(rows, POSTS).repartition(3)
    listed_frame = spark.createDataFrame([(p,) for p in [*patterns, None, patterns[3]]], "pattern string")
    found = lexicon_join.substring_hits(frame, listed_frame, ["post_id", "url"]).collect()
    lowered = {r.post_id: r.lowered for r in frame.select("post_id", F.lower("text").alias("lowered")).collect()}
    wanted = {(i, p) for i, t in lowered.items() if t for p in patterns if p and p in t}
    assert {(r.post_id, r.pattern) for r in found} == wanted and len(found) == len(wanted) > 1000


@pytest.mark.parametrize("inline", [0, 256])
def test_basic_labels_from_tables(spark, monkeypatch, inline):
    """T&S, citations in list order, then the image, in any way of search; a NULL text can only have the image."""
    monkeypatch.setattr(lexicon_join, "INLINE_PATTERNS", inline)
    texts = {1: "spam from b.com and A.com", 2: "a.com", 3: None, 4: "none", 5: "", 6: "b.com again by both.b.com scam"}
    posts = spark.createDataFrame(list(texts.items()), "post_id long, text string")
    ts = spark.createDataFrame([("spam",), ("scam",), ("spam",), (None,), ("",)], "pattern string")
    entries = spark.createDataFrame([(3, "a.com", "A"), (1, "b.com", "B"), (2, "both.b.com", "A"), (0, "spam", "S")], "pos int, pattern string, label string")
    images = spark.createDataFrame([(1,), (3,), (3,), (99,)], "post_id long")
    got = {r.post_id: r.labels for r in lexicon_join.label_basic_join(posts, ts, entries, images).collect()}
    assert got == {1: [TS_LABEL, "S", "B", "A", IMAGE_LABEL], 2: ["A"], 3: [IMAGE_LABEL], 4: [], 5: [], 6: [TS_LABEL, "B", "A"]}
    nothing = lexicon_join.label_basic_join(posts, ts.limit(0), entries.limit(0), images.limit(0))
    assert {tuple(r.labels) for r in nothing.collect()} == {()} and nothing.count() == 6


def test_phonetic_codes_from_a_table(spark):
    """A table of codes gives what the key function does; a word that it lacks sounds like nothing."""
    words = spark.createDataFrame([("phishing",), ("fishing",), ("fishinq",), ("other",)], "word string")
    lexicon = words.filter("word = 'phishing'")
    known = phonetic_vocabulary(words, phonetic_key)
    by_table = {r.word for r in lexicon_join.phonetic_words(words, lexicon, known.filter("word <> 'fishinq'")).collect()}
    assert "fishing" in by_table and "fishinq" not in by_table
    by_key = {r.word for r in lexicon_join.phonetic_words(words, lexicon, phonetic_key).collect()}
    assert {r.word for r in lexicon_join.phonetic_words(words, lexicon, known.union(known)).collect()} == by_key


def test_patterns_across_the_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(lexicon_join, "INLINE_PATTERNS", 0)
    size = anchors.CHUNK_CHARS
    text = "x" * (size - 5) + "straddling" + "y" * (size - 13) + "one very long pattern " * 5 + "z" * size + "end"
    posts = spark.createDataFrame([(1, text), (2, "straddl"), (3, "one very long pattern")], "post_id long, text string")
    listed = ["straddling", "one very long pattern " * 5, "zend", "xs", "one very long patterns", "d"]
    found = lexicon_join.substring_hits(posts, spark.createDataFrame([(p,) for p in listed], "pattern string")).collect()
    assert {(r.post_id, r.pattern) for r in found} == {(1, p) for p in listed if p in text} | {(2, "d")}


def test_the_rarest_gram_is_the_anchor(spark):
    texts = spark.createDataFrame([("the cat sat on the mat",)] * 5, "text string")
    patterns = spark.createDataFrame([("the catx",), ("ca",), ("q",), ("on the mats are",)], "pattern string")
    placed = {r.pattern: (r.q, r.anchor) for r in anchors.anchored(patterns, texts).collect()}
    assert placed["q"] == (1, "q") and placed["ca"] == (2, "ca") and placed["the catx"] == (8, "the catx")
    q, anchor = placed["on the mats are"]
    assert q == 12 and "the cat sat on the mat".find(anchor) < 0


def test_filter_passes_every_anchor_and_few_others(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(3000)})
    placed = spark.createDataFrame([(w, 8, w) for w in words], "pattern string, q int, anchor string")
    bloom = anchors.anchor_filter(placed, 0)
    assert bloom.words is not None and len(bloom.words) == 1024
    hashes = lambda listed: np.concatenate([anchors.gram_hashes(anchors.points_of(w), [8])[8] for w in listed])
    assert bloom.test(hashes(words)).all()
    others = ["".join(rng.choice("ijklmnop") for _ in range(8)) for _ in range(3000)]
    assert bloom.test(hashes(others)).mean() < 0.02


def test_a_larger_filter_passes_no_more(spark):
    """Over two pages, at the fewest bits for each anchor."""
    rng = random.Random(9)
    words = {"".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(34_000)}
    words = sorted(words)[:32_768]
    bloom = anchors.anchor_filter(spark.createDataFrame([(w, 8, w) for w in words], "pattern string, q int, anchor string"), 0)
    assert len(bloom.words) == 8192 == 2 * anchors.PAGE_WORDS
    assert bloom.test(anchors._hashes(words)).all()
    others = ["".join(rng.choice("ijklmnop") for _ in range(8)) for _ in range(100_000)]
    assert bloom.test(anchors._hashes(others)).mean() < 0.003


def test_many_patterns_are_anchored_together(monkeypatch):
    """As one by one: the rarest gram, a hashed one of equal ones; grams of one length are hashed in one call."""
    rng = random.Random(10)
    counts = np.array([rng.randint(0, 2) for _ in range(anchors.SLOTS)])
    whole, calls = anchors.gram_hashes, []
    for q in anchors.GRAMS:
        patterns = ["".join(rng.choice("abcé😀") for _ in range(rng.randint(q, q + 30))) for _ in range(100)]
        wanted = []
        for p in patterns:
            found = whole(anchors.points_of(p), [q])[q]
            seen = [counts[int(h) % anchors.SLOTS] for h in found]
            tied = [i for i, n in enumerate(seen) if n == min(seen)]
            at = tied[zlib.crc32(p.encode()) % len(tied)]
            wanted.append((at, int(found[at])))
        monkeypatch.setattr(anchors, "gram_hashes", lambda *given: calls.append(given) or whole(*given))
        begins, grams = anchors.rarest(patterns, q, counts)
        assert list(zip(begins.tolist(), grams.tolist())) == wanted
        assert anchors._hashes([p[:q] for p in patterns]).tolist() == [int(whole(anchors.points_of(p[:q]), [q])[q][0]) for p in patterns]
    assert len(calls) == 2 * len(anchors.GRAMS)


@pytest.mark.parametrize("most", [1, 40, 1 << 24])
def test_ranges_are_cut_out_of_a_text(monkeypatch, most):
    monkeypatch.setattr(anchors, "BATCH_BYTES", most)
    rng = random.Random(11)
    for letters in ("abc", "abé😀"):
        text = "".join(rng.choice(letters) for _ in range(500))
        begins = np.array([rng.randint(0, 500) for _ in range(99)])
        ends = np.minimum(begins + [rng.randint(0, 30) for _ in begins], 500)
        parts = list(anchors.cut_out(text, begins, ends))
        assert [t for _, _, cut in parts for t in cut.to_pylist()] == [text[b:e] for b, e in zip(begins, ends)]
        assert [first for first, _, _ in parts] == [0, *(last for _, last, _ in parts[:-1])] and parts[-1][1] == 99


def test_no_more_text_goes_along_than_a_pattern_covers(spark):
    """Grams of 8 letters have patterns of up to 11 letters, whatever the longest pattern; a letter is told once of a text."""
    long = "x" * 20 + "the longest of all the patterns" + "y" * 10
    placed = spark.createDataFrame([("abcdefgh", 8, "abcdefgh"), (long, 16, long[20:36]), ("q", 1, "q")], "pattern string, q int, anchor string")
    wanted = [(anchors.anchor_filter(placed, 100), {8: 11, 16: len(long), 1: 1}), (anchors.AnchorFilter([]), {})]
    texts = spark.createDataFrame([(1, "qq 0123456abcdefgh6543210 q"), (2, "é" + long + "😀"), (3, "abcdefgh"), (4, "q")], "id long, lowered string")
    found = anchors.stands(texts, ["id"], wanted).collect()
    assert sorted((r.id, r.kind, r.around) for r in found) == sorted([
        (1, 0, "456abcdefgh654"), (1, 0, "q"), (2, 0, "é" + long + "😀"), (3, 0, "abcdefgh"), (4, 0, "q"),
    ])


@pytest.mark.parametrize("chars", [1, 5, 16, 1000])
def test_pieces_hold_every_gram_once(monkeypatch, chars):
    monkeypatch.setattr(anchors, "CHUNK_CHARS", chars)
    text = "abc😀éfgh" * 9
    whole = anchors.gram_hashes(anchors.points_of(text), list(anchors.GRAMS))
    parts = list(anchors.pieces(text, list(anchors.GRAMS)))
    assert [start for start, _ in parts] == list(range(0, len(text), chars))
    for q, found in whole.items():
        assert np.array_equal(np.concatenate([hashes[q] for _, hashes in parts]), found)
    assert list(anchors.pieces("", [])) == []


def test_gram_hashes_depend_on_all_characters():
    points = anchors.points_of("abcdefghijklmnopqrstuvwxyz" * 2)
    for q, found in anchors.gram_hashes(points, list(anchors.GRAMS)).items():
        assert len(found) == 52 - q + 1 and len(set(found.tolist())) == 26 and found[0] == found[26]


def plain_search(rows, terms, limit):
    wanted = {}
    for pos, term in terms:
        if term:
            wanted[pos] = [(i, u) for i, u, t in sorted(rows) if t and term.lower() in t.lower()][:limit]
    return {pos: hits for pos, hits in wanted.items() if hits}


def searched(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.pos, []).append((r.post_id, r.url))
    return {pos: sorted(hits) for pos, hits in found.items()}


@pytest.mark.parametrize("limit,few", [(3, 1000), (1000, 0)])
def test_index_finds_the_first_posts_of_every_term(spark, monkeypatch, tmp_path, limit, few):
    """In two segments stored out of order, over slices of a few rows, with terms of every kind."""
    monkeypatch.setattr(trigram_index, "FEW_TERMS", few)
    monkeypatch.setattr(trigram_index, "SLICE", 4)
    rows, words = made_posts(4)
    rows = [r for r in rows if "İ" not in (r[2] or "")]
    terms = list(enumerate([*words, "a", "É", "ab", "b c", "zzz", "😀", "a", "xy", "y", "never there", "zend"]))
    index = TrigramIndex(spark, str(tmp_path / "index"))
    mixed = rows[:]
    random.Random(5).shuffle(mixed)
    index.append(spark.createDataFrame(mixed[:300], POSTS).repartition(3), 0)
    index.append(spark.createDataFrame(mixed[300:310], POSTS), 1)
    index.append(spark.createDataFrame(mixed[300:], POSTS), 1)  # the segment again
    frame = spark.createDataFrame([*terms, (900, ""), (901, None)], "pos int, term string")
    assert searched(index.search(frame, limit)) == plain_search(rows, terms, limit)
    assert index.search(frame.limit(0), limit).collect() == []


def test_many_terms_are_not_asked_of_every_slice(spark, monkeypatch, tmp_path):
    """Only short terms are paired with slices; the others are found by one scan of each wave, once each."""
    for module, name, value in ((trigram_index, "FEW_TERMS", 0), (trigram_index, "SLICE", 4), (lexicon_join, "INLINE_PATTERNS", 0)):
        monkeypatch.setattr(module, name, value)
    rows, words = made_posts(8)
    rows = [r for r in rows if "İ" not in (r[2] or "")]
    rows += [(i, f"again{i}", t) for i, _, t in rows[:50]]
    terms = list(enumerate([*words, "a", "É", "ab", "b c", "zzz", "😀", words[0], "never there", "zend"]))
    index, paired = TrigramIndex(spark, str(tmp_path / "index")), []
    kept = TrigramIndex._verified
    monkeypatch.setattr(TrigramIndex, "_verified", lambda self, asked, *rest: paired.append(asked) or kept(self, asked, *rest))
    index.append(spark.createDataFrame(rows, POSTS).repartition(3), 0)
    found = index.search(spark.createDataFrame(terms, "pos int, term string"), 7)
    assert searched(found) == plain_search(rows, terms, 7)
    short = {pos for pos, term in terms if len(term) <= 2}
    assert paired and all({r.pos for r in asked.collect()} <= short for asked in paired)


def test_appending_leaves_stored_lists_alone(spark, tmp_path):
    index = TrigramIndex(spark, str(tmp_path / "index"))
    index.append(spark.createDataFrame([(1, "u1", "first post")], POSTS), 0)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    index.append(spark.createDataFrame([(2, "u2", "second post")], POSTS), 1)
    assert {p: p.stat().st_mtime_ns for p in before} == before
    terms = spark.createDataFrame([(0, "post"), (1, "second")], "pos int, term string")
    labelled = collect.collect_indexed(index, terms.withColumn("label", F.lit("x")))
    assert sorted((r.pos, r.post_id, r.labels[1]) for r in labelled.collect()) == [(0, 1, "x"), (0, 2, "x"), (1, 2, "x")]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def changed(rng, word, n):
    letters = list(word)
    for _ in range(min(n, len(word) - 1)):
        at, what = rng.randrange(len(letters)), rng.choice("sid")
        letters[at:at + 1] = {"s": [rng.choice("abz")], "i": [letters[at], rng.choice("abz")], "d": []}[what]
    return "".join(letters)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_close_words_equal_edit_distances(spark, monkeypatch, broadcast):
    """Words of 4 to 40 letters: through deletions up to two edits, through pieces beyond."""
    monkeypatch.setattr(lexicon_join, "BROADCAST_ROWS", broadcast)
    rng = random.Random(6)
    known = sorted({"".join(rng.choice("abcdefé") for _ in range(rng.choice([4, 6, 7, 9, 13, 14, 18, 20, 27, 40]))) for _ in range(150)})
    said = sorted({changed(rng, rng.choice(known), rng.randint(0, 6)) for _ in range(500)} - {""})
    make = lambda words: spark.createDataFrame([(w,) for w in words], "word string")
    wanted = set()
    for w in said:
        for k in known:
            if w != k and len(w) >= 4 and abs(len(w) - len(k)) <= 1 and 1 - edits(w, k) / max(len(w), len(k)) >= (0.85 + 0.05 if len(k) < 6 else 0.85):
                wanted.add(w)
    found = [r.word for r in lexicon_join.fuzzy_words(make(said), make(known)).collect()]
    assert set(found) == wanted and len(found) == len(wanted) > 60


@pytest.mark.parametrize("name", ["ts_words_long", "label_citations_long"])
def test_long_list_queries_join_on_anchors(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "anchor" in plan and "around" in plan and "BroadcastNestedLoopJoin" not in plan
    assert all("documents" not in side for side in built_sides(plan))


@pytest.mark.parametrize("inline", [0, 256])
def test_passages_are_searched_for_whole(spark, monkeypatch, tmp_path, inline):
    """A post with only the beginning of an item, of any length, does not contain it."""
    monkeypatch.setattr(lexicon_join, "INLINE_PATTERNS", inline)
    items = ["An item of " + "some few words " * n + f"and its end {n}." for n in (15, 20, 3000)]
    texts = [t for item in items for t in (f"Before. {item.upper()} After.", item[:-2], item[:200])] + ["", None, "q" + items[1]]
    tables = {
        "documents": pd.DataFrame({"doc_id": range(len(texts)), "text": texts}),
        "benchmark": pd.DataFrame({"item_id": range(len(items) + 2), "text": [*items, "", None]}),
        "part": pd.DataFrame({"p_partkey": [1], "p_name": ["never there"]}),
    }
    for name, rows in tables.items():
        rows.to_parquet(tmp_path / f"{name}.parquet")
    found = QUERIES["ts_words_long"](spark, str(tmp_path))
    assert {r.post_id: r.n_patterns for r in found.collect()} == {0: 1, 3: 1, 6: 1, 11: 2}
    assert differences(found, connect(str(tmp_path)), ORACLES["ts_words_long"]) == ""
