"""Lexicon files, labelled CSV, lookups and label events."""

import json

import pytest
from pyspark.sql import functions as F

from slyglot import lexicons as fixed
from slyglot.operators import events
from slyglot.operators import lexicon_prep as prep
from slyglot.sources import lexicon_files as files
from slyglot.sources import posts as sources


@pytest.fixture
def folder(tmp_path):
    def lines(name, values):
        (tmp_path / name).write_text("\n".join(values))

    lines("harmful_words.txt", fixed.HARMFUL_LINES)
    lines("t-and-s-words.csv", fixed.TS_WORD_LINES)
    lines("t-and-s-domains.csv", fixed.TS_DOMAIN_LINES)
    lines("news-domains.csv", ["Domain,Source", *(",".join(e) for e in fixed.NEWS_ENTRIES)])
    pairs = ",".join(f"{json.dumps(a)}:{json.dumps(b)}" for a, b in fixed.SUBSTITUTION_ENTRIES)
    (tmp_path / "char_substitutions.json").write_text(f'{{"character_substitutions":\n{{{pairs}}}}}')
    (tmp_path / "homophones.json").write_text(json.dumps({"homophones": dict(fixed.HOMOPHONE_ENTRIES)}))
    (tmp_path / "spoonerisms.json").write_text(
        json.dumps({"spoonerisms": [{"original": o, "spoonerism": s} for o, s in fixed.SPOONERISM_ENTRIES]}, indent=1)
    )
    return tmp_path


def test_loaded_lexicons_equal_the_fixed_ones(spark, folder):
    got, wanted = files.load_lexicons(spark, str(folder)), fixed.Lexicons()
    assert set(got.harmful) == set(wanted.harmful) and len(got.harmful) == 29
    assert got.substitutions == wanted.substitutions and len(got.substitutions) == 25
    assert got.homophones == wanted.homophones
    assert got.spoonerisms == wanted.spoonerisms
    assert set(got.ts_words) == set(wanted.ts_words) and "word" in got.ts_words
    assert set(got.ts_domains) == set(wanted.ts_domains)
    assert got.news == (("Domain", "Source"), *wanted.news)


def test_header_option(spark, folder):
    path = str(folder / "t-and-s-words.csv")
    assert files.read_words(spark, path).count() == 27
    assert files.read_words(spark, path, header_as_entry=False).count() == 26
    assert files.read_pairs(spark, str(folder / "news-domains.csv"), header_as_entry=False).count() == 7


def test_later_pair_wins_at_first_position(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a.com,one\nb.com,two\na.com,three\n")
    rows = files.read_pairs(spark, str(tmp_path / "p.csv")).orderBy("pos").collect()
    assert [(r.domain, r.label) for r in rows] == [("a.com", "three"), ("b.com", "two")]


def test_unreadable_json_is_empty(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{nope")
    assert files.read_homophones(spark, str(tmp_path / "bad.json")).count() == 0
    assert files.read_spoonerisms(spark, str(tmp_path / "none.json")).count() == 0
    assert files.read_substitutions(spark, str(tmp_path / "none.json")).count() == 0


def test_unreadable_lists_are_empty(spark, tmp_path):
    words, pairs = files.read_words(spark, str(tmp_path / "none.txt")), files.read_pairs(spark, str(tmp_path / "none.csv"))
    assert words.columns == ["word"] and words.count() == 0
    assert pairs.columns == ["domain", "label", "pos"] and pairs.count() == 0
    loaded = files.load_lexicons(spark, str(tmp_path))
    assert (loaded.harmful, loaded.ts_words, loaded.news, loaded.homophones) == ((), (), (), ())


def test_large_list_is_not_pulled_to_the_driver(spark):
    with pytest.raises(ValueError, match="lexicon_join"):
        files.bounded_rows(spark.range(11), 10)


def test_lookup_keeps_overwritten_variants():
    related = fixed.two_way((("to", ("two",)), ("two", ("too",))))
    assert related == {"to": {"two"}, "two": {"too"}, "too": {"two"}}
    assert set(fixed.Lexicons().firing_homophones()) >= {
        "keel", "hayt", "hait", "beach", "beech", "sheet", "cheat", "phuck", "fack", "tranz", "trance"
    }
    assert len(fixed.Lexicons().firing_spoonerisms()) == 8
    assert set(fixed.Lexicons().high_confidence()) == {"suicide", "stupid", "retard", "terrorist", "racist", "sexist"}


def test_lexicon_preparation(spark):
    entries = spark.createDataFrame([("hate", "hait"), ("hate", "h8"), ("hait", "hate")], "word string, variant string")
    got = {tuple(r) for r in prep.homophone_lookup(entries).collect()}
    assert got == {("hate", "hait"), ("hait", "hate"), ("hate", "h8"), ("h8", "hate")}
    pairs = spark.createDataFrame(
        [("kill", "you", "yill", "kou", 1), ("bill", "you", "yill", "kou", 2)],
        "o1 string, o2 string, s1 string, s2 string, pos int",
    )
    assert [tuple(r) for r in prep.spoonerism_lookup(pairs).collect()] == [("yill", "kou", "bill", "you")]
    subs = spark.createDataFrame(list(fixed.Lexicons().substitutions), "source string, target string")
    back = {}
    for r in prep.reverse_substitutions(subs).collect():
        back.setdefault(r.target, set()).add(r.source)
    assert back["i"] == {"1", "!", "|"} and back["q"] == {"9"} and back["g"] == {"6"}


def test_labeled_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('URL,Labels\nhttps://x/1,"[""linguistic-evasion"", ""homophone""]"\nhttps://x/2,[]\nhttps://x/3,["nyt"]\n')
    rows = {r.URL: r.labels for r in sources.read_labeled_posts(spark, str(path)).collect()}
    assert rows == {"https://x/1": ["linguistic-evasion", "homophone"], "https://x/2": [], "https://x/3": ["nyt"]}
    again = spark.createDataFrame(list(rows.items()), "url string, labels array<string>")
    out = str(tmp_path / "out")
    sources.write_labeled_posts(again, out)
    sources.write_labeled_posts(again, out)
    back = sources.read_labeled_posts(spark, out)
    assert back.count() == 6
    assert {r.URL: r.labels for r in back.collect()} == rows


def test_lookup_with_one_very_frequent_url(spark):
    posts = spark.range(50).select(
        F.concat(F.lit("u"), "id").alias("author_handle"), F.concat(F.lit("r"), "id").alias("rkey"), "id"
    )
    wanted = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 60)
    urls = spark.range(3000).select(
        F.format_string("https://bsky.app/profile/u%d/post/r%d", wanted, wanted).alias("url")
    )
    found = sources.lookup_posts(urls, posts)
    assert found.count() == 3000
    assert found.filter("id is null").count() == urls.filter("url rlike 'r5[0-9]$'").count() > 0


def test_resolve_handles_keeps_one_row_per_request(spark):
    accounts = spark.createDataFrame([("a", "d1"), ("a", "d0"), ("b", "d2")], "handle string, did string")
    requests = spark.createDataFrame([(1, "a"), (2, "a"), (3, "c")], "n int, handle string")
    got = {r.n: r.did for r in sources.resolve_handles(requests, accounts).collect()}
    assert got == {1: "d0", 2: "d0", 3: None}


def test_query_labels_escapes_pattern_characters(spark):
    labels = spark.createDataFrame(
        [("at://a_b/x", "s1"), ("at://azb/x", "s1"), ("at://a_b/y", "s2")], "uri string, src string"
    )
    got = sources.query_labels(labels, ["at://a_b/*"], ["s1"]).collect()
    assert [r.uri for r in got] == ["at://a_b/x"]


def test_events(spark, tmp_path):
    labeled = spark.createDataFrame(
        [("at://1", "c1", ["dog"]), ("at://2", "c2", [])], "uri string, cid string, labels array<string>"
    )
    rows = events.post_events(labeled, "me").collect()
    assert [(r.created_by, r.event.create_label_vals, r.event.negate_label_vals, r.subject.uri, r.subject.cid, r.subject.did, r.subject_blob_cids) for r in rows] == [
        ("me", ["dog"], [], "at://1", "c1", None, [])
    ]
    assert events.post_events(labeled, "me", emit=False).count() == 0
    accounts = spark.createDataFrame([("h", "did:1")], "handle string, did string")
    requests = spark.createDataFrame([("h", ["spam"]), ("gone", ["spam"])], "handle string, labels array<string>")
    account = events.account_events(requests, accounts, "me").collect()
    assert [(r.subject.did, r.event.create_label_vals) for r in account] == [("did:1", ["spam"])]
    path = str(tmp_path / "events")
    events.write_events(events.post_events(labeled, "me"), path)
    events.write_events(events.account_events(requests, accounts, "me"), path)
    assert spark.read.parquet(path).count() == 2


def test_reference_hashes_by_extension(spark):
    images = spark.createDataFrame(
        [("a.jpg", 1), ("b.jpeg", 1), ("c.png", 2), ("d.txt", 3), ("e.jpg", None)], "path string, hash long"
    )
    assert sorted(r.hash for r in sources.reference_hashes(images).collect()) == [1, 2]
