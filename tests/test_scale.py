"""Steps whose cost must not grow faster than their input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywell.operators import image_sets, warehouse
from tallywell.storage import fresh_path, names_in

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as with tables too large to broadcast, and plans as they are written."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_hot_key_is_ranked_in_several_tasks(shuffled):
    rows = shuffled.range(4000).select(F.when(F.col("id") % 40 > 0, "hot").alias("filename"), F.format_string("p%05d", "id").alias("s3path"))
    listed = image_sets.files_by_name(rows)
    assert listed.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] < 2500
    want = {}
    for name, path in sorted(map(tuple, rows.collect()), key=lambda r: (r[0] or "", r[1])):
        want[path] = (name, sum(1 for n, _ in want.values() if n == name))
    assert {r.s3path: (r.filename, r.position) for r in listed.collect()} == want


def test_files_of_batches_move_once(shuffled):
    data = [(1, 1, "a", "f"), (1, 1, "a", "f"), (1, 2, "b", "f"), (1, 3, "c", "f"), (None, 1, "d", "f"), (1, None, "e", "f"), (1, None, "e", "f")]
    files = shuffled.createDataFrame(data, "experiment long, batchid long, s3path string, filename string")
    batches = shuffled.createDataFrame([(1, 1), (1, 2), (None, 1), (1, None)], "experiment long, batchid long")
    told = warehouse.ingest_batch_files(files, batches)
    assert told._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # files, batches
    lost = "unknown batch"
    assert sorted((r.s3path, r.experiment, r.batchid, r.reason) for r in told.collect()) == [
        ("a", 1, 1, None), ("b", 1, 2, None), ("c", 1, 3, lost), ("d", None, 1, lost), ("e", 1, None, lost),
    ]


def test_documents_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from tallywell.plans import files

    suppliers = [(i, f"Supplier#{i}", i % 3, 1.0) for i in range(60)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    nations = spark.createDataFrame([(i, f"N{i}", 0) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int")
    nations.coalesce(1).write.parquet(f"{tmp_path}/nation.parquet")
    root = fresh_path(spark, "documents")
    monkeypatch.setattr(files, "fresh_path", lambda *_: root)
    assert files.scan_experiment_json(spark, str(tmp_path)).count() == 69  # every seventh twice
    written = [name for name in names_in(spark, root) if name.startswith("part-")]
    assert len(written) == 69
    assert len({name.split("-")[1] for name in written}) > 1


def test_state_of_many_sets_is_few_rows(spark):
    from tallywell.streaming import feed, keyed
    from tallywell.streaming.image_sets import complete_sets

    big = (1 << 60) + 1
    data = [(None if s == 7 else big + s, "ab"[i], START) for s in range(1000) for i in range(1 + s % 2)]
    path, target = fresh_path(spark, "many-sets"), fresh_path(spark, "complete")
    frame = spark.createDataFrame(data, "s long, channel string, ts timestamp")
    frame.write.parquet(path)
    sets = complete_sets(feed.image_feed(spark, path, frame.schema), ["s"], "channel", ["a", "b"], "ts")
    query = sets.writeStream.format("parquet").option("checkpointLocation", f"{target}-progress").trigger(availableNow=True).start(target)
    query.awaitTermination()
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= keyed.BUCKETS
    got = {r.s for r in spark.read.parquet(target).collect()}
    assert got == {None if s == 7 else big + s for s in range(1, 1000, 2)}


def test_a_large_table_comes_in_few_epochs(spark, monkeypatch):
    from tallywell.plans import streams
    from tallywell.streaming import feed

    monkeypatch.setattr(streams, "FILE_ROWS", 5)
    rows = spark.range(0, 1000, 1, 4)
    target = fresh_path(spark, "epochs")
    assert feed.drain_to_table(streams._as_stream(rows, "long-feed"), "epochs", target).distinct().count() == 1000
    assert len([name for name in names_in(spark, f"{target}-progress/commits") if name.isdigit()]) <= streams.EPOCHS


def test_a_join_of_streams_holds_few_states(spark):
    """A state row per image and position took longer than the join, and each epoch went through all of them."""
    from tallywell.streaming import feed, timed_join, totals

    frames = [
        spark.range(4000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("n"), F.lit(START).cast("timestamp").alias("seen")),
        spark.range(500).select(F.col("id").alias("k"), F.lit(START).cast("timestamp").alias("t"), (F.col("id") * 0.5).alias("x")),
    ]
    paths, target = [fresh_path(spark, "sides") for _ in frames], fresh_path(spark, "joined")
    for path, frame in zip(paths, frames):
        frame.write.parquet(path)
    streams = [feed.image_feed(spark, path, frame.schema) for path, frame in zip(paths, frames)]
    joined = totals.join_coordinates(*streams, ["k"], "seen", "t", within_minutes=30)
    query = joined.writeStream.format("parquet").option("checkpointLocation", f"{target}-progress").trigger(availableNow=True).start(target)
    query.awaitTermination()
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= timed_join.BUCKETS
    assert {(r.k, r.n, r.x) for r in spark.read.parquet(target).collect()} == {(n % 1000, n, n % 1000 * 0.5) for n in range(4000) if n % 1000 < 500}


def test_parts_of_a_state_go_with_the_feeds(spark):
    from types import SimpleNamespace

    from tallywell.plans import streams
    from tallywell.streaming import feed

    cores = spark.sparkContext.defaultParallelism
    for files, rounds in ((1, 1), (streams.STATE_FILES * cores, 1), (streams.STATE_FILES * cores + 1, 2)):
        assert streams._parts(spark, [SimpleNamespace(files=files)]) == rounds * cores
    path, target = fresh_path(spark, "parts-feed"), fresh_path(spark, "parts")
    spark.range(100).write.parquet(path)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    stream = feed.image_feed(spark, path, "id long").dropDuplicates(["id"])
    assert feed.drain_to_table(stream, "parts", target, rocks_db=True, partitions=3).count() == 100
    assert len([name for name in names_in(spark, f"{target}-progress/state/0") if name.isdigit()]) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
