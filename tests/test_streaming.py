"""The labelers on a stream give the batch result."""

from pyspark.sql import functions as F

from slyglot.operators import labelers as L
from slyglot.operators.events import post_events
from slyglot.plans import corpus
from slyglot.streaming import label_stream


def source_folder(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "posts")
    corpus.posts(spark, sf_dir).select("post_id", "uri", "cid", "url", "text").repartition(3).write.parquet(folder)
    return folder


def as_set(frame):
    rows = frame.select("subject.uri", F.array_join("event.create_label_vals", ",")).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    folder = source_folder(spark, sf_dir, tmp_path)
    batch = as_set(post_events(L.label_evasion(spark.read.parquet(folder)), "me"))
    schema = spark.read.parquet(folder).schema

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    for start, name in ((label_stream.start_label_events, "a"), (label_stream.start_label_batches, "b")):
        out, log = str(tmp_path / name), str(tmp_path / f"{name}-log")
        for _ in range(2):  # the second run finds nothing new
            start(stream(), L.label_evasion, "me", out, log, availableNow=True).awaitTermination()
        assert as_set(spark.read.parquet(out)) == batch and batch


def test_unseen_posts(spark, tmp_path):
    folder = str(tmp_path / "urls")
    rows = [(f"u{i % 4}", f"2024-01-01 00:0{i}:00") for i in range(8)]
    frame = spark.createDataFrame(rows, "url string, ts string").withColumn("ts", F.to_timestamp("ts"))
    frame.repartition(2).write.parquet(folder)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (
        label_stream.unseen_posts(stream).writeStream.format("memory").queryName("unseen")
        .option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.url for r in spark.table("unseen").collect()) == ["u0", "u1", "u2", "u3"]
