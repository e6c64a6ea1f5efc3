"""Timed-out sets, retries, progress, ids and coordinates in running streams, at several layouts and across failures."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallywell import storage
from tallywell.storage import EpochLog, fresh_path, names_in
from tallywell.streaming import feed, outcomes, timed_join, totals

START = dt.datetime(2024, 1, 1)
MINUTE, DAY = dt.timedelta(minutes=1), dt.timedelta(days=1)


class Feed:
    """Files of rows that are added while a stream is down."""

    def __init__(self, spark, schema, per_trigger=1):
        self.spark, self.schema, self.path = spark, schema, fresh_path(spark, "test-feed")
        self.per_trigger = per_trigger
        self.add([])

    def add(self, rows, files=1):
        self.spark.createDataFrame(rows, self.schema).repartition(files).write.mode("append").parquet(self.path)

    @property
    def stream(self):
        return feed.image_feed(self.spark, self.path, self.spark.createDataFrame([], self.schema).schema, self.per_trigger)


IMAGES = "plate string, s int, channel string, ts timestamp"


@pytest.mark.parametrize(("files", "per_trigger"), [(1, 1), (5, 2), (7, 100)])
def test_sets_complete_or_time_out(spark, files, per_trigger):
    own = Feed(spark, IMAGES, per_trigger)
    target = fresh_path(spark, "outcomes")

    def drain():
        told = outcomes.set_outcomes(own.stream, ["plate", "s"], "channel", ["a", "b", "c"], "ts", keep_days=2)
        rows = feed.drain_to_table(told, "outcomes", target, rocks_db=True).collect()
        return sorted((r.s, r.outcome, "".join(r.channels), r["at"]) for r in rows)

    rows = [("p", s, c, START + s * MINUTE) for s in range(30) for c in ("abc" if s % 3 else "ab"[: s % 2 + 1])]
    rows += [("p", 0, "a", START + i * MINUTE) for i in range(200)]  # a set with most of the rows
    rows += [("p", 50, "other", START), ("p", 51, None, START), ("p", 52, "a", None)]
    random.Random(files).shuffle(rows)
    own.add(rows, files)
    complete = [(s, "complete", "abc", START + s * MINUTE) for s in range(30) if s % 3]
    assert drain() == complete
    own.add(rows, files)  # delivered again
    assert drain() == complete
    own.add([("q", 99, "a", START + 10 * DAY)])
    drain()
    own.add([("q", 98, "a", START + 10 * DAY)])
    late = [(s, "incomplete", "ab"[: s % 2 + 1], START + 2 * DAY + (199 if s == 0 else s) * MINUTE) for s in range(0, 30, 3)]
    assert drain() == sorted(complete + late)


ATTEMPTS = "plate string, s int, attempt int, exit_code int, ts timestamp"


def drained(own, target, **options):
    told = outcomes.retries(own.stream, ["plate", "s"], "ts", **options)
    rows = feed.drain_to_table(told, "retries", target, rocks_db=True).collect()
    return sorted((r.s, r.attempt, r.status, r.next_attempt, r["at"]) for r in rows)


def test_retry_waits_and_ends(spark):
    own, target = Feed(spark, ATTEMPTS), fresh_path(spark, "retries")
    options = {"most": 3, "wait_minutes": 60, "keep_days": 0}
    own.add([("p", 1, 0, 137, START), ("p", 2, 0, 0, START), ("p", 3, 0, 9, START), ("p", 4, None, 1, START), ("p", 5, 1, 137, START)])
    ended = [(2, 0, "done", None, START), (3, 0, "failed.9", None, START)]
    assert drained(own, target, **options) == ended  # set 1 waits, the outcome of set 5 is ahead of its turn
    own.add([("p", 9, 0, 0, START + 59 * MINUTE)])
    own.add([("p", 8, 0, 0, START + 59 * MINUTE)])
    assert not [r for r in drained(own, target, **options) if r[0] == 1]
    own.add([("p", 10, 0, 0, START + 61 * MINUTE)])
    own.add([("p", 11, 0, 0, START + 61 * MINUTE)])
    due = (1, 0, "failed.OOM(0)", 1, START + 60 * MINUTE)
    assert [r for r in drained(own, target, **options) if r[0] == 1] == [due]
    own.add([("p", 1, 1, 137, START + 70 * MINUTE), ("p", 1, 1, 0, START + 71 * MINUTE), ("p", 1, 2, 137, START + 80 * MINUTE)])
    told = [r for r in drained(own, target, **options) if r[0] == 1]
    # The third attempt ran before its time and is the last one.
    assert told == [due, (1, 1, "failed.OOM(1)", 2, START + 190 * MINUTE), (1, 2, "failed.OOM(2)", None, START + 80 * MINUTE)]


@pytest.mark.parametrize(("files", "per_trigger"), [(1, 1), (6, 2)])
def test_retries_in_any_order_and_again(spark, files, per_trigger):
    rng = random.Random(files)
    chains = {s: [137] * rng.randint(0, 4) + [rng.choice([0, 1])] for s in range(40)}
    rows = [("p", s, k, code, START + (10 * k + s) * MINUTE) for s, codes in chains.items() for k, code in enumerate(codes)]
    rows += rows
    rng.shuffle(rows)
    own, target = Feed(spark, ATTEMPTS, per_trigger), fresh_path(spark, "retries")
    own.add(rows, files)
    got = drained(own, target, most=4)
    want = []
    for s, codes in chains.items():
        for k, code in enumerate(codes[:4]):
            ran = START + (10 * k + s) * MINUTE
            again = code == 137 and k < 3
            status = f"failed.OOM({k})" if code == 137 else f"failed.{code}" if code else "done"
            want.append((s, k, status, k + 1 if again else None, ran + again * 2**k * 10 * MINUTE))
    assert got == sorted(want)


def test_epoch_log(spark):
    path = fresh_path(spark, "log")
    log = EpochLog(spark, path, "k string, n long", lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), every=3)

    def rows(frame):
        return {r.k: r.n for r in frame.collect()}

    def add(epoch):
        before = rows(log.before(epoch))
        log.write(epoch, spark.createDataFrame([("a", epoch), ("b", 1)], "k string, n long"))
        return before

    assert rows(log.total()) == {}
    for epoch in range(11):
        want = {"a": sum(range(epoch)), "b": epoch} if epoch else {}
        assert add(epoch) == want
        assert add(epoch) == want  # repeated
        assert rows(log.total()) == {"a": sum(range(epoch + 1)), "b": epoch + 1}
    assert sorted(names_in(spark, path)) == ["epoch=10", "epoch=6", "epoch=7", "epoch=8", "epoch=9", "merged=6", "merged=9"]


@pytest.mark.parametrize(("files", "per_trigger"), [(1, 1), (9, 1), (9, 4)])
def test_progress_counts_each_site_once(spark, files, per_trigger):
    own, target = Feed(spark, "e string, site long", per_trigger), fresh_path(spark, "progress")
    rows = [("x", i * 31 % 70_000) for i in range(5000)] + [("y", 0), ("y", 32_767), ("y", 32_768), (None, 5)]
    own.add(rows, files)

    def drain():
        return {r.e: r.n for r in totals.drain_progress(own.stream, ["e"], "site", path=target).collect()}

    want = {"x": len({s for e, s in rows if e == "x"}), "y": 3, None: 1}
    assert drain() == want
    own.add(rows + [("y", None), ("y", -1), ("y", 32_768), ("z", 1)], files)  # delivered again, after a restart
    assert drain() == want | {"z": 1}
    expected = spark.createDataFrame([("y", 6), ("w", 4), ("z", 0)], "e string, want long")
    done = totals.drain_progress(own.stream, ["e"], "site", path=target)
    shares = {r.e: (r.n, r.percent_done) for r in totals.progress_share(done, expected, ["e"], "want").collect()}
    assert shares == {"y": (3, 50), "w": (0, 0), "z": (1, None)}


@pytest.mark.parametrize(("files", "per_trigger"), [(1, 1), (6, 1), (6, 4)])
def test_ids_go_up_without_gaps(spark, files, per_trigger, monkeypatch):
    own, target = Feed(spark, "e string, well string, site int, ts timestamp", per_trigger), fresh_path(spark, "numbered")
    rows = [("x", f"w{i % 50}", i % 4, START + i * MINUTE) for i in range(400)] + [("y", "w", i % 3, START) for i in range(30)]
    first = spark.createDataFrame([("x", 100), ("z", 5)], "e string, next_id long")

    def drain():
        return totals.drain_numbered(own.stream, "e", ["well", "site"], "ts", first, path=target).collect()

    own.add(rows, files)
    # The first epoch with rows fails after it has written its sets, before their counts.
    write, failed = EpochLog.write, []

    def fail_once(log, epoch, frame):
        if epoch == 1 and not failed:
            failed.append(epoch)
            raise RuntimeError("executor lost")
        return write(log, epoch, frame)

    monkeypatch.setattr(storage.EpochLog, "write", fail_once)
    with pytest.raises(StreamingQueryException):
        drain()
    drain()
    own.add([*rows, ("z", "w", 0, START), ("y", "new", 0, START)], files)  # delivered again, with two new sets
    got = drain()
    ids = {}
    for r in got:
        ids.setdefault(r.e, []).append(r.batchid)
    n_x = len({(w, s) for e, w, s, _ in rows if e == "x"})
    assert sorted(ids["x"]) == list(range(100, 100 + n_x))
    assert sorted(ids["y"]) == [0, 1, 2, 3]
    assert ids["z"] == [5]
    assert len({(r.e, r.well, r.site) for r in got}) == len(got)


@pytest.mark.parametrize("per_trigger", [1, 50])
def test_coordinates_of_a_second_stream(spark, per_trigger):
    images = Feed(spark, "e int, s int, seen timestamp", per_trigger)
    stage = Feed(spark, "e int, s int, t timestamp, x double", per_trigger)
    target = fresh_path(spark, "joined")

    def drain():
        joined = totals.join_coordinates(images.stream, stage.stream, ["e", "s"], "seen", "t", within_minutes=30)
        return sorted((r.s, r.x) if r.x is not None else (r.s, -1) for r in feed.drain_to_table(joined, "joined", target).collect())

    images.add([(1, s, START + s * MINUTE) for s in range(20)], 3)
    # Set 3 was recorded too late, 4 twice, 5 never, 6 at another experiment, 7 without a time.
    odd = [(1, 3, START + 60 * MINUTE, 9.0), (1, 4, START, 0.5), (2, 6, START, 1.0), (1, 7, None, 1.0)]
    stage.add([(1, s, START + (s + 30) * MINUTE, float(s)) for s in range(20) if s not in (3, 5, 6, 7)] + odd, 2)
    met = sorted([(s, float(s)) for s in range(20) if s not in (3, 5, 6, 7)] + [(4, 0.5)])
    assert drain() == met
    for n in range(2):
        images.add([(1, 100 + n, START + 9 * DAY)])
        stage.add([(1, 200, START + 9 * DAY, 0.0)])
        got = drain()
    assert got == sorted(met + [(s, -1) for s in (3, 5, 6, 7)])


def test_pairs_within_a_bound(monkeypatch):
    monkeypatch.setattr(timed_join, "PAIRS", 7)
    rng = np.random.default_rng(3)
    for n, m in ((0, 0), (0, 5), (5, 0), (60, 40), (40, 300)):
        code, time = rng.integers(-1, 6, n), rng.integers(-50, 50, n)
        code_other, time_other = rng.integers(0, 8, m), rng.integers(-50, 50, m)
        some, pairs = timed_join._pairs(code, time, code_other, time_other, 10)
        got = [(int(i), int(j)) for part in pairs for i, j in zip(*part)]
        want = [(i, j) for i in range(n) for j in range(m) if code[i] == code_other[j] and abs(time[i] - time_other[j]) <= 10]
        assert sorted(got) == want
        assert some.tolist() == sorted({i for i, _ in want})


@pytest.mark.parametrize(("seed", "keep_days"), [(1, 0), (2, 1)])
def test_join_tells_what_a_state_per_row_tells(spark, monkeypatch, seed, keep_days):
    """Rows in any order, late, repeated and without a key, in several epochs and after restarts: the same as Spark's own join."""
    rng = random.Random(seed)
    images = Feed(spark, "e int, s string, seen timestamp, n int", 1)
    stage = Feed(spark, "e long, s string, t timestamp, x double", 1)
    targets = [fresh_path(spark, "joined") for _ in range(2)]

    def drain():
        told = []
        for packed, target in zip((True, False), targets):
            with monkeypatch.context() as own:
                if not packed:
                    own.setattr(timed_join, "can_pack", lambda *_: False)
                joined = totals.join_coordinates(images.stream, stage.stream, ["e", "s"], "seen", "t", 30, keep_days)
            told.append(sorted(map(repr, feed.drain_to_table(joined, "joined", target).collect())))
        return told

    def key():
        return rng.choice([0, 1, 2, None]), rng.choice(["a", "", None, "b"])

    def when(day):
        return START + day * DAY + rng.randrange(-3000, 3000) * MINUTE + dt.timedelta(microseconds=rng.randrange(3) * 400)

    n = 0
    for day in (0, 2, 40):
        rows = [(*key(), None if rng.random() < 0.1 else when(day), (n := n + 1)) for _ in range(120)]
        far = (dt.datetime(1066, 10, 14), dt.datetime(1969, 12, 31), dt.datetime(9999, 12, 31))
        images.add(rows + [(1, "a", time, (n := n + 1)) for time in far])
        stage.add([(*key(), None if rng.random() < 0.1 else when(day), rng.choice([None, 0.5, -0.0, float("nan")])) for _ in range(120)])
        got, want = drain()
        assert got == want
    assert len(want) > 100


def test_join_keeps_values_of_all_types(spark):
    kinds = {
        "small": "cast(n as tinyint)", "big": "9007199254740993 + n", "yes": "n % 2 = 0", "day": "date'0001-01-01'", "at": "timestamp'9999-12-31 23:59:59.999999'",
        "wall": "timestamp_ntz'1066-10-14 01:02:03.000004'", "single": "cast(0.1 as float)", "part": "cast('nan' as double)", "money": "cast(12345678901234567890.12 as decimal(30, 2))",
        "raw": "X'00ff'", "word": "'\u00e4\U0001f600'", "none": "cast(null as int)",
    }
    rows = spark.range(4).withColumnRenamed("id", "n").selectExpr("n as k", *[f"if(n = 3, null, {how}) as {name}" for name, how in kinds.items()])
    images = rows.withColumn("seen", F.lit(START).cast("timestamp"))
    stage = rows.where("k <> 1").select("k", *[F.col(c).alias(f"o_{c}") for c in kinds], F.lit(START).cast("timestamp").alias("t"))
    paths = [fresh_path(spark, "types") for _ in range(3)]
    images.write.parquet(paths[0])
    stage.write.parquet(paths[1])
    streams = [feed.image_feed(spark, path, frame.schema) for path, frame in zip(paths, (images, stage))]
    assert timed_join.can_pack(*streams, ["k"])
    joined = totals.join_coordinates(*streams, ["k"], "seen", "t", 30)
    want = images.join(stage, "k").select(*images.columns, "t", *[f"o_{c}" for c in kinds])
    assert joined.columns == want.columns
    assert [f.dataType for f in joined.schema] == [f.dataType for f in want.schema]
    got = feed.drain_to_table(joined, "types", paths[2])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("column", ["array(1, 2)", "named_struct('a', 1)"])
def test_join_of_columns_that_cannot_be_packed(spark, column):
    rows = spark.range(3).selectExpr("id as k", f"{column} as list", "timestamp'2024-01-01' as seen")
    stage = spark.range(2).selectExpr("id as k", "timestamp'2024-01-01' as t", "0.5D as x")
    paths = [fresh_path(spark, "lists") for _ in range(3)]
    for path, frame in zip(paths, (rows, stage)):
        frame.write.parquet(path)
    joined = totals.join_coordinates(*[feed.image_feed(spark, p, f.schema) for p, f in zip(paths, (rows, stage))], ["k"], "seen", "t", 30)
    assert sorted((r.k, r.x) for r in feed.drain_to_table(joined, "lists", paths[2]).collect()) == [(0, 0.5), (1, 0.5)]
