"""Detectors and labelers against brute force; the join paths against the inline ones."""

import random

import pytest
from pyspark.sql import functions as F

from slyglot.functions import text as T
from slyglot.lexicons import Lexicons
from slyglot.operators import detect, lexicon_join
from slyglot.operators import labelers as L
from slyglot.operators import lexicon_prep as prep
from slyglot.plans import corpus
from tests import spec

LEX = Lexicons()
CASES = [
    None, "", "stupid", "so stupid!", "what a m0r0n move", "terrorists are dead wrong",
    "terrorists are wrong", "racists here and dead", "please hayt dead", "please hayt it",
    "yill kou dead", "ock fuff with dead", "hit shead with death", "kyll them with death",
    "kyll them with hate", "hate him with dead", "k1ll with dead", "suicidé in dead air",
    "die Kinder der Stadt kommen", "beach death party", "sutpid stpid stupidd dead",
    "dead dead dead", "terorists and hate speech", "shead hit dead", "a b dead", "ass die fat gay dead",
]


def generated(count, seed):
    rng = random.Random(seed)
    words = list(LEX.harmful) + list(LEX.context) + [v for _, vs in LEX.homophones for v in vs]
    words += [w for o, s in LEX.spoonerisms for w in (*o, *s)]
    words += "the they heat had quail these terorist retards sexists Stup1d $lut raci5t ünder".split()

    def mutate(word):
        at = rng.randrange(len(word))
        return rng.choice((word, word, word[:at] + word[at + 1:], word[:at] + rng.choice("aeist0$k") + word[at:]))

    return [" ".join(mutate(rng.choice(words)) for _ in range(rng.randint(1, 7))) for _ in range(count)]


TEXTS = CASES + generated(600, 3)


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "post_id long, text string").cache()


@pytest.mark.parametrize("phonetic", [False, True])
def test_labels_equal_brute_force(posts, phonetic):
    got = {r.post_id: r.labels for r in posts.transform(lambda p: L.label_evasion(p, phonetic=phonetic)).collect()}
    assert {i: got[i] for i in got} == {i: spec.labels(t, LEX, phonetic) for i, t in enumerate(TEXTS)}


def test_generated_posts_exercise_every_detector():
    texts = [t for t in TEXTS if t]
    for check in (spec.has_charsub, spec.has_listed_homophone, spec.has_phonetic, spec.has_spoonerism):
        assert 10 < sum(check(t, LEX) for t in texts) < len(texts) - 10


def test_other_lexicon(spark, posts):
    # long words allow two and three edits, which the shipped list never does
    lex = Lexicons(harmful=("reprehensibleness", "abominableness", "kill"), context={"dead": 2})
    base = "reprehensibleness"
    texts = [
        f"dead word {base}", f"dead word {base[1:]}x", f"dead word {base[:5]}zz{base[7:]}",
        f"dead word {base[:5]}zzz{base[8:]}", f"dead word {base[2:]}ab", f"word word {base[1:]}",
        "dead abomnablenes word", "dead abominablenessy word", "dead bominablenessy word",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "post_id long, text string")
    got = [r.labels for r in L.label_evasion(frame, lex, phonetic=False).orderBy("post_id").collect()]
    assert got == [spec.labels(t, lex, False) for t in texts]
    assert 3 < sum(map(bool, got)) < len(texts)
    norm = L.with_norm_score(L.with_norm_words(frame, lex), lex)
    tokens = lexicon_join.post_tokens(norm, "norm_words", detect.context_gate(F.col("norm_score")))
    lexicon = spark.createDataFrame([(w,) for w in lex.harmful], "word string")
    near = {r.word for r in lexicon_join.fuzzy_words(tokens, lexicon).collect()}
    words = {r.word for r in tokens.collect()}
    assert near == {
        w for w in words for h in lex.harmful
        if w != h and abs(len(w) - len(h)) <= 1 and spec.similarity(w, h) >= spec.limit(h, 0.85)
    }


def ids(frame):
    return {r.post_id for r in frame.collect()}


def test_join_paths_equal_inline_paths(spark, posts):
    lexicon = spark.createDataFrame([(w,) for w in LEX.harmful], "word string")
    norm = L.with_norm_score(L.with_norm_words(posts, LEX), LEX)
    raw = L.with_raw_words(posts, LEX)
    two = T.has_two_long_words(F.col("norm_words"))
    exact = lexicon_join.posts_with_words(lexicon_join.post_tokens(norm, "norm_words", two), lexicon)
    assert ids(exact) == ids(norm.filter(detect.charsub_exact(F.col("norm_words"), LEX)))

    gate = two & detect.context_gate(F.col("norm_score"))
    tokens = lexicon_join.post_tokens(norm, "norm_words", gate)
    fuzzy = lexicon_join.posts_with_words(tokens, lexicon_join.fuzzy_words(tokens, lexicon))
    assert ids(fuzzy) == ids(norm.filter(detect.charsub_fuzzy(F.col("norm_words"), F.col("norm_score"), LEX)))

    strict = detect.homophone_gate(F.col("raw_words"), F.col("raw_score"), 3)
    tokens = lexicon_join.post_tokens(raw, "raw_words", strict)
    sounds = lexicon_join.posts_with_words(tokens, lexicon_join.phonetic_words(tokens, lexicon))
    assert ids(sounds) == {i for i, t in enumerate(TEXTS) if t and spec.has_phonetic(t, LEX)}


@pytest.mark.parametrize("phonetic", [False, True])
def test_labels_by_join_equal_brute_force(spark, posts, phonetic):
    entries = [(w, v) for w, variants in LEX.homophones for v in variants]
    related = prep.homophone_lookup(spark.createDataFrame(entries, "word string, variant string"))
    swaps = spark.createDataFrame(
        [(*s, *o) for o, s in LEX.spoonerisms], "s1 string, s2 string, o1 string, o2 string"
    )
    lexicon = spark.createDataFrame([(w,) for w in LEX.harmful], "word string")
    out = lexicon_join.label_evasion_join(posts, lexicon, related, swaps, LEX, phonetic)
    got = {r.post_id: r.labels for r in out.collect()}
    assert got == {i: spec.labels(t, LEX, phonetic) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("inline", [0, 256])
def test_substring_join(spark, monkeypatch, inline):
    monkeypatch.setattr(lexicon_join, "INLINE_PATTERNS", inline)
    texts = ["", "spamming the Platform", "x" * 255 + "phishing", "x" * 250 + "User Data" + "y" * 600, "none", None]
    texts.append("ab" * 400 + "virality")
    posts = spark.createDataFrame(list(enumerate(texts)), "post_id long, text string")
    patterns = spark.createDataFrame([(w,) for w in (*LEX.ts_words, "q")], "pattern string")
    got = {(r.post_id, r.pattern) for r in lexicon_join.substring_hits(posts, patterns).collect()}
    wanted = {(i, p) for i, t in enumerate(texts) if t for p in LEX.ts_words if p in t.lower()}
    assert got == wanted


def test_expected_suffix_labels(spark):
    # what each corpus suffix earns on its own
    frame = spark.createDataFrame(
        [(i, s.strip()) for i, (s, _) in enumerate(corpus.SUFFIXES)], "post_id long, text string"
    )
    got = {r.post_id: r.labels for r in L.label_evasion(frame, LEX).collect()}
    for i, (_, wanted) in enumerate(corpus.SUFFIXES):
        assert set(got[i]) - {"linguistic-evasion"} >= set(wanted), i
    assert got[0] == got[10] == got[11] == []


def test_published_hit_counts(spark):
    """Known counts of the shipped lexicon on the plain documents."""
    docs = corpus.plain_posts(spark, "/root/testdata/sf0.01")
    flags = L.with_evasion_flags(docs, LEX, phonetic=False).agg(
        F.count_if("charsub"), F.count_if("homophone"), F.count_if("spoonerism"),
        F.count_if(F.col("charsub") | F.col("homophone") | F.col("spoonerism")),
    ).first()
    assert tuple(flags) == (67, 17, 23, 84)


def test_basic_labels(spark):
    texts = [
        "SPAMMING all day", "see bbc.com and NYTimes.com and bbc.com", "a keyword", "plain", None,
        "www.tspa.org via apnews.com",
    ]
    posts = spark.createDataFrame([(i, t, i == 3 or None) for i, t in enumerate(texts)], "post_id int, text string, m boolean")
    got = [r.labels for r in L.label_basic(posts, F.col("m"), LEX).orderBy("post_id").collect()]
    assert got == [["t-and-s"], ["bbc", "nyt"], ["t-and-s"], ["dog"], [], ["t-and-s", "ap"]]


def test_news_label_is_not_repeated(spark):
    lex = Lexicons(news=(("a.com", "x"), ("b.com", "y"), ("c.com", "x")))
    frame = spark.createDataFrame([("c.com b.com a.com",)], "lowered string")
    assert frame.select(detect.pair_labels(F.col("lowered"), lex.news)).first()[0] == ["x", "y"]


def test_long_lists_give_the_same_rows_inline_and_joined(spark, monkeypatch):
    words = tuple(f"term{i:05d}" for i in range(3000)) + LEX.ts_words
    texts = ["a term00017 b", "TERM02999", "term0", None, "spamming", "none"] + [t for t in TEXTS if t]
    posts = spark.createDataFrame(list(enumerate(texts)), "post_id long, text string")
    wanted = {i for i, t in enumerate(texts) if t and any(w in t.lower() for w in words)}
    patterns = spark.createDataFrame([(w,) for w in words], "pattern string")
    assert {r.post_id for r in lexicon_join.ts_posts(posts, patterns).collect()} == wanted
    monkeypatch.setattr(lexicon_join, "INLINE_PATTERNS", 10_000)
    assert {r.post_id for r in lexicon_join.ts_posts(posts, patterns).collect()} == wanted
    for name in ("INLINE_PATTERNS", "INLINE_ANCHORS", "BROADCAST_ROWS"):
        monkeypatch.setattr(lexicon_join, name, 0)
    assert {r.post_id for r in lexicon_join.ts_posts(posts, patterns).collect()} == wanted
    assert lexicon_join.ts_posts(posts, patterns.limit(0)).count() == 0


def test_citation_labels_by_join_keep_list_order(spark):
    entries = spark.createDataFrame([(0, "a.com", "x"), (1, "b.com", "y"), (2, "c.com", "x"), (3, "z", "q")], "pos int, pattern string, label string")
    posts = spark.createDataFrame([(1, "c.com B.com a.com"), (2, "nothing"), (3, None)], "post_id long, text string")
    got = {r.post_id: r.labels for r in lexicon_join.cited_labels(posts, entries).collect()}
    assert got == {1: ["x", "y"], 2: [], 3: []}
