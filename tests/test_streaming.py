import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallywell.storage import fresh_path, shared_root
from tallywell.streaming import batches as bt
from tallywell.streaming import feed
from tallywell.streaming.image_sets import complete_sets

START = dt.datetime(2024, 1, 1)


def stream(df, files, per_trigger=1):
    path = fresh_path(df.sparkSession, "test-feed")
    df.repartition(files).write.parquet(path)
    return feed.image_feed(df.sparkSession, path, df.schema, per_trigger)


def arrivals(spark):
    data = []
    for s in range(40):
        channels = "abc" if s % 4 else "ab"
        for repeat in range(1 + s % 3):
            data += [(f"set{s}", c, START + dt.timedelta(minutes=s + repeat)) for c in channels]
    # A third of all rows belong to one set.
    data += [("set1", "a", START + dt.timedelta(minutes=i)) for i in range(100)]
    data += [("set2", "unexpected", START)]
    return spark.createDataFrame(data, "image_set string, channel string, ts timestamp")


@pytest.mark.parametrize("files", [1, 6])
def test_each_complete_set_once(spark, files):
    sets = complete_sets(stream(arrivals(spark), files), ["image_set"], "channel", ["a", "b", "c"], "ts")
    got = [r["image_set"] for r in feed.drain_to_table(sets, "sets").collect()]
    assert sorted(got) == sorted(f"set{s}" for s in range(40) if s % 4)


def test_redelivery_after_restart_emits_nothing_new(spark):
    path, target = fresh_path(spark, "feed"), fresh_path(spark, "sets")
    df = arrivals(spark)

    def drain():
        feed_ = feed.image_feed(spark, path, df.schema)
        sets = complete_sets(feed_, ["image_set"], "channel", ["a", "b", "c"], "ts")
        return feed.drain_to_table(sets, "sets", target, f"{target}-progress").count()

    df.where("channel <> 'c'").write.parquet(path)
    assert drain() == 0
    df.where("channel = 'c'").write.mode("append").parquet(path)
    assert drain() == 30
    df.write.mode("append").parquet(path)
    assert drain() == 30


def test_registration_is_idempotent(spark):
    data = [(1, b % 5, START + dt.timedelta(minutes=b)) for b in range(50)]
    requests = spark.createDataFrame(data, "experiment long, batchid long, ts timestamp")
    for files in (1, 4):
        seen = feed.drain_to_table(bt.new_requests(stream(requests, files)), "requests")
        assert sorted(r["batchid"] for r in seen.collect()) == [0, 1, 2, 3, 4]
    stored = spark.createDataFrame([(1, 0, "registered"), (1, 1, "done")], "experiment long, batchid long, status string")
    registered, conflicts = bt.register_batches(requests, stored)
    assert sorted(r["batchid"] for r in registered.collect()) == [2, 3, 4]
    assert [(r["batchid"], r["stored_status"]) for r in conflicts.collect()] == [(1, "done")]


def events(spark):
    t = [START + dt.timedelta(hours=h) for h in range(5)]
    data = [
        (1, 0, "registered", t[0], 1), (1, 0, "processing images", t[1], 2), (1, 0, "uploading results to storage", t[2], 3),
        (1, 0, "done", t[2], 4),  # same time as the event before, later in the log
        (1, 1, "registered", t[0], 5), (1, 1, "processing images", t[2], 6), (1, 1, "failed.OOM(0)", t[3], 7),
        (1, 2, "registered", t[4], 8), (1, 3, "processing images", t[1], 9), (1, 3, "terminated", t[4], 10),
    ]
    return spark.createDataFrame(data, "experiment long, batchid long, status string, ts timestamp, seq long"), t


def test_status_fold_batch_and_stream_agree(spark):
    df, t = events(spark)
    want = {
        0: ("done", t[1], t[2]), 1: ("failed.OOM(0)", t[2], t[3]), 2: ("registered", None, None), 3: ("terminated", t[1], t[4]),
    }
    show = lambda folded: {r["batchid"]: (r["status"], r["start_time"], r["end_time"]) for r in folded.collect()}
    assert show(bt.fold_status(df)) == want
    for files in (1, 5):
        assert show(bt.latest(feed.drain_updates(bt.fold_status(stream(df, files)), "status"))) == want


def test_finished_experiments_fire_once(spark):
    sites = spark.createDataFrame([(e, s) for e in range(4) for s in range(3 if e % 2 else 2)], "experiment long, site int")
    expected = spark.createDataFrame([(e, 3) for e in range(5)], "experiment long, expected_sites int")
    for files in (1, 5):
        counts = bt.finished_experiments(stream(sites, files), expected)
        got = feed.drain_updates(counts, "finished", bt.just_finished)
        assert sorted(r["experiment"] for r in got.collect()) == [1, 3]


def test_epoch_folders_are_replaced_on_retry(spark, tmp_path):
    out = feed.drain_updates(stream(events(spark)[0], 2).groupBy("experiment").agg(F.count("*").alias("n")), "n", path=str(tmp_path / "t"))
    assert out.agg(F.max("n")).first()[0] == 10


def test_shared_root_is_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_root(spark) == configured.rstrip("/")
    else:
        assert shared_root(spark) == shared_root(spark)


def test_a_feed_without_files_gives_no_rows(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    feed_ = feed.image_feed(spark, str(tmp_path / "feed"), "experiment long, site int")
    assert feed.drain_to_table(feed_, "none").collect() == []
    counts = feed_.groupBy("experiment").agg(F.count("*").alias("n"))
    assert feed.drain_updates(counts, "none").collect() == []


def test_late_rows_go_to_a_table_of_their_own(spark, tmp_path):
    """Rows that the watermark drops are found in the reject table, also after a restart."""
    import datetime as dt

    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    schema = "experiment long, batchid long, status string, ts timestamp, seq long"
    source, target = str(tmp_path / "in"), str(tmp_path / "late")
    batches = [
        [(1, 1, "registered", day(0), 1)],
        [(1, 1, "done", day(100), 2), (1, 2, "registered", day(95), 3)],
        [(1, 1, "registered", day(80), 4), (1, 2, "done", day(99), 5)],
        [(1, 3, "registered", day(101), 6), (1, 3, "registered", day(50), 7)],
    ]
    late, n = [], 0
    for i, rows_in in enumerate(batches):
        spark.createDataFrame(rows_in, schema).coalesce(1).write.mode("append").parquet(source)
        stream = feed.image_feed(spark, source, spark.createDataFrame([], schema).schema, max_files=1)
        late = sorted(r["seq"] for r in feed.drain_late(stream, "ts", 10, "late", path=target).collect())
    assert late == [4, 7]


def test_folds_of_periods_merge_to_the_whole_fold(spark, tmp_path):
    import datetime as dt

    schema = "experiment long, batchid long, status string, ts timestamp, seq long"
    states = [bt.REGISTERED, bt.PROCESSING, bt.UPLOADING, bt.DONE, "failed.1"]
    data = [(1, i % 7, states[(i * 3) % 5], dt.datetime(2024, 1, 1) + dt.timedelta(hours=11 * i), i) for i in range(200)]
    events = spark.createDataFrame(data, schema)
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = feed.image_feed(spark, str(tmp_path / "in"), events.schema, max_files=4)
    updates = feed.drain_updates(bt.fold_status_by_period(stream, keep_days=20), "fold", path=str(tmp_path / "out"))
    assert updates.select("period").distinct().count() > 2
    got = sorted(map(tuple, bt.merge_periods(updates).collect()))
    assert got == sorted(map(tuple, bt.fold_status(events).collect()))


def test_redelivered_sites_do_not_lose_an_experiment(spark, tmp_path):
    """Two files with the last missing site twice: the experiment is emitted once."""
    schema = "experiment long, site long"
    expected = spark.createDataFrame([(1, 3), (2, 2)], "experiment long, expected_sites long")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for rows_in in ([(1, 1), (1, 2), (2, 1)], [(1, 2), (1, 3), (1, 3), (2, 1)], [(1, 1), (2, 2)]):
        spark.createDataFrame(rows_in, schema).coalesce(1).write.mode("append").parquet(source)
        stream = feed.image_feed(spark, source, spark.createDataFrame([], schema).schema)
        done = feed.drain_updates(bt.finished_experiments(stream, expected), "done", bt.just_finished, path=target, once=["experiment"])
    assert sorted((r["experiment"], r["n_sites"]) for r in done.collect()) == [(1, 3), (2, 2)]
