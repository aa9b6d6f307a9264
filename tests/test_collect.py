"""Search, weak labels, deduplication and append."""

from pyspark.sql import functions as F

from slyglot.lexicons import NEUTRAL_TERMS, NEUTRAL_TOPICS
from slyglot.operators import collect, topk


def test_top_k_of_a_hot_key(spark):
    # key 0 owns a third of the rows
    rows = spark.range(0, 30_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.xxhash64("id").alias("v"), "id"
    )
    order = [F.col("v"), F.col("id")]
    got = {}
    for r in topk.top_k_per_key(rows, "k", order, 25).collect():
        got.setdefault(r.k, set()).add(r.id)
    wanted = {}
    for r in sorted(rows.collect(), key=lambda r: (r.v, r.id)):
        if len(wanted.setdefault(r.k, set())) < 25:
            wanted[r.k].add(r.id)
    assert got == wanted
    plan = topk.top_k_per_key(rows, "k", order, 25)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4


def test_first_per_key(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "url string, pos int, v string")
    got = topk.first_per_key(rows, "url", F.col("pos")).collect()
    assert {(r.url, r.pos, r.v) for r in got} == {("a", 1, "y"), ("b", 3, "z")}


def corpus(spark):
    texts = ["F@CK this", "f@ck and sh1t", "good morning world", "yill kou", "nothing", "good morning sh1t"]
    return spark.createDataFrame(
        [(i, f"u{i}", t) for i, t in enumerate(texts)], "post_id int, url string, text string"
    )


def test_positive_hits_and_first_term_wins(spark):
    hits = collect.collect_positive(corpus(spark))
    assert {(r.pos, r.url) for r in hits.collect()} == {(0, "u0"), (0, "u1"), (1, "u1"), (1, "u5"), (41, "u3")}
    first = {r.url: (r.pos, r.labels) for r in collect.first_wins(hits).collect()}
    assert first["u1"] == (0, ["linguistic-evasion", "character-substitution"])
    assert first["u3"] == (41, ["linguistic-evasion", "spoonerism"])


def test_limit_applies_before_deduplication(spark):
    hits = collect.collect_positive(corpus(spark), limit=1)
    assert {(r.pos, r.url) for r in hits.collect()} == {(0, "u0"), (1, "u1"), (41, "u3")}


def test_corpus_skips_stored_and_prefers_positive(spark):
    stored = spark.createDataFrame([("u0",), ("u0",)], "url string")
    got = {r.url: r.labels for r in collect.collect_corpus(corpus(spark), collect.neutral_queries(), stored).collect()}
    assert got == {
        "u1": ["linguistic-evasion", "character-substitution"],
        "u3": ["linguistic-evasion", "spoonerism"],
        "u5": ["linguistic-evasion", "character-substitution"],
        "u2": [],
    }


def test_expansion_on_tables_equals_the_inlined_list(spark):
    terms = spark.createDataFrame(list(enumerate(NEUTRAL_TERMS)), "pos int, term string")
    topics = spark.createDataFrame([(t,) for t in NEUTRAL_TOPICS], "topic string")
    rows = collect.expand_queries(terms, topics).collect()
    ordered = [r["query"] for r in sorted(rows, key=lambda r: (r["round"], r["pos"], r["rank"]))]
    assert list(enumerate(ordered)) == collect.neutral_queries()
    assert len(ordered) == 16 + 5 * 3 == len(set(ordered))
    assert collect.neutral_queries("other") != collect.neutral_queries()


def test_append_is_incremental(spark, tmp_path):
    from slyglot.sources import posts as sources

    path = str(tmp_path / "corpus")
    rows = corpus(spark).select("url", F.array().cast("array<string>").alias("labels"))
    sources.write_labeled_posts(rows.limit(2), path)
    existing = sources.read_labeled_posts(spark, path).select(F.col("URL").alias("url"))
    sources.write_labeled_posts(collect.new_rows(rows, existing), path)
    assert sorted(r.URL for r in sources.read_labeled_posts(spark, path).collect()) == [f"u{i}" for i in range(6)]
