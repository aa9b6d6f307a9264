"""The bucketed store and the event sink."""

import glob
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from slyglot.sources import event_sink
from slyglot.sources.store import PostStore
from tests.test_plans import plan_of

ROWS = "url string, labels string"


@pytest.fixture
def store(spark, tmp_path):
    made = PostStore(spark, f"store_{uuid.uuid4().hex}", str(tmp_path / "store"), buckets=8)
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.name}")


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_only_new_urls_are_stored(spark, store):
    make = lambda rows: spark.createDataFrame(rows, ROWS)
    first = make([("a", "1"), ("b", "2"), ("b", "3")])
    assert rows_of(store.new_rows(first)) == [("a", "1"), ("b", "2"), ("b", "3")]
    store.append_new(first)
    again = make([("b", "9"), ("c", "4"), ("c", "0")])
    for _ in range(2):  # repeated, it stores nothing more
        store.append_new(again)
    assert rows_of(store.table()) == [("a", "1"), ("b", "2"), ("c", "0")]
    found = store.lookup(make([("c", ""), ("x", "")]).select("url"))
    assert rows_of(found) == [("c", "0"), ("x", None)]
    store.append_new(make([]))
    assert store.table().count() == 3


def test_stored_rows_are_not_shuffled(spark, store):
    known = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("x").alias("labels"))
    store.append(known)
    store.append(known.limit(10))  # a second file in some buckets
    fresh = spark.range(2990, 3010).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("y").alias("labels"))
    for frame in (store.new_rows(fresh), store.lookup(fresh.select("url"))):
        plan = plan_of(frame)
        assert "Bucketed: true" in plan and "Broadcast" not in plan
        assert len(re.findall(r"Exchange hashpartitioning\(url", plan)) == 1, plan
    assert store.new_rows(fresh).count() == 10


def test_store_of_an_earlier_session(spark, store):
    store.append(spark.createDataFrame([("a", "1"), ("b", "2")], ROWS))
    later = PostStore(spark, store.name + "_later", store.path, buckets=8).open(ROWS)
    fresh = spark.createDataFrame([("b", ""), ("z", "")], ROWS)
    assert rows_of(later.new_rows(fresh)) == [("z", "")] and "Bucketed: true" in plan_of(later.new_rows(fresh))
    spark.sql(f"DROP TABLE {later.name}")


EVENTS = "uri string, labels array<string>, subject struct<did: string>"


def events(spark, n=20):
    return spark.range(n).select(
        F.concat(F.lit("at://"), "id").alias("uri"), F.array(F.lit("x"), F.lit(None).cast("string")).alias("labels"),
        F.struct(F.when(F.col("id") % 2 == 0, "d").alias("did")).alias("subject"))


def stored(spark, path):
    return rows_of(event_sink.stored_events(spark, path, EVENTS).select("uri", "labels", "subject.did"))


def test_a_batch_is_stored_once(spark, tmp_path):
    path, made = str(tmp_path / "events"), events(spark).repartition(3)
    wanted = rows_of(made.select("uri", "labels", "subject.did"))
    assert stored(spark, path) == []
    for _ in range(2):
        event_sink.write_batch(made, path, "a")
    assert stored(spark, path) == wanted
    assert len(glob.glob(f"{path}/data/*")) == 3  # the second copy is gone
    event_sink.write_batch(made.limit(0), path, "b")
    event_sink.write_batch(made, path)
    assert len(stored(spark, path)) == 40


def test_a_failed_batch_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "events")
    broken = events(spark).repartition(4).withColumn("uri", F.when(F.col("uri") == "at://7", F.raise_error(F.lit("lost"))).otherwise(F.col("uri")))
    with pytest.raises(Exception):
        event_sink.write_batch(broken, path, "a")
    assert stored(spark, path) == []
    event_sink.write_batch(events(spark), path, "a")
    assert len(stored(spark, path)) == 20


def test_files_without_a_commit_are_not_read(spark, tmp_path):
    path = str(tmp_path / "events")
    event_sink.write_batch(events(spark, 4), path, "a")
    folder = event_sink.EventFolder(path)
    folder.write(iter(events(spark, 9).toArrow().to_batches()))  # a task whose job never came to its end
    assert len(stored(spark, path)) == 4


def test_a_replayed_micro_batch_leaves_one_copy(spark, tmp_path):
    source, path, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    made = events(spark)
    for part in range(3):
        made.filter(F.regexp_extract("uri", r"(\d+)", 1).cast("int") % 3 == part).coalesce(1).write.mode("append").parquet(source)
    spark.dataSource.register(event_sink.LabelEventSink)

    def run():
        stream = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(source)
        stream.writeStream.format(event_sink.NAME).option("path", path).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()

    run()
    wanted = rows_of(made.select("uri", "labels", "subject.did"))
    assert stored(spark, path) == wanted
    last = max(glob.glob(f"{log}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for name in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(name):
            os.remove(name)  # as if the driver was lost before it noted the last batch
    run()
    assert stored(spark, path) == wanted
