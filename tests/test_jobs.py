"""The end-to-end jobs."""

from pyspark.sql import functions as F

from slyglot.lexicons import Lexicons
from slyglot.plans import corpus, jobs
from slyglot.sources import posts as sources


def examples_of(spark, posts, path):
    sources.write_labeled_posts(posts.select("url", F.col("expected").alias("labels")), path)
    missing = spark.createDataFrame(
        [("https://bsky.app/profile/nobody/post/none", ["linguistic-evasion", "homophone"])], "url string, labels array<string>"
    )
    sources.write_labeled_posts(missing, path)
    return sources.read_labeled_posts(spark, path)


def test_evaluate_evasion(spark, sf_dir, tmp_path):
    posts = corpus.posts(spark, sf_dir)
    examples = examples_of(spark, posts, str(tmp_path / "csv"))
    got = {(r.section, r.metric): r.value for r in jobs.evaluate_evasion(examples, posts).collect()}
    assert got["balance", "total"] == posts.count() + 1
    assert got["errors", "errors"] == 1
    assert got["linguistic-evasion", "fn"] >= 1
    assert got["character-substitution", "recall"] == 1.0
    assert not any(section == "latency" for section, _ in got)


def test_evaluate_basic_and_emit(spark, sf_dir, tmp_path):
    posts = corpus.posts(spark, sf_dir)
    truth = posts.withColumn("expected", F.when(F.col("post_id") % 12 == 11, F.array(F.lit("nyt"))).otherwise(F.array().cast("array<string>")))
    examples = examples_of(spark, truth, str(tmp_path / "csv"))
    references = sources.reference_hashes(corpus.reference_images(spark, sf_dir))
    labeler = jobs.basic_labeler(corpus.images(spark, sf_dir), references, Lexicons())
    out = str(tmp_path / "events")
    summary, wrong = jobs.evaluate_basic(examples, posts, labeler, "me", out)
    row = summary.first()
    assert row.total == posts.count() + 1 and row.num_correct + wrong.count() == row.total
    labels = {tuple(r.predicted) for r in wrong.collect()}
    assert ("t-and-s", "bbc", "nyt") in labels and () in labels
    assert any("dog" in found for found in labels)
    events = spark.read.parquet(out)
    assert events.filter("size(event.create_label_vals) = 0").count() == 0 < events.count()


def test_collect_examples_twice_adds_nothing(spark, sf_dir, tmp_path):
    posts, path = corpus.searchable_posts(spark, sf_dir), str(tmp_path / "corpus")
    jobs.collect_examples(spark, posts, path)
    first = sources.read_labeled_posts(spark, path)
    urls = first.count()
    assert urls == first.select("URL").distinct().count() > 100
    jobs.collect_examples(spark, posts, path)
    assert sources.read_labeled_posts(spark, path).count() == urls
