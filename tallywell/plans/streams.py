"""Streams over files of driver rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywell.operators import progress
from tallywell.operators.warehouse import next_batch_id, parse_images
from tallywell.plans import standins as st
from tallywell.session import table
from tallywell.schemas import STATUS_EVENT
from tallywell.storage import append_rows, fresh_path, materialize, names_in
from tallywell.streaming import batches as bt
from tallywell.streaming import feed, outcomes, totals
from tallywell.streaming.image_sets import complete_sets

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


FILE_ROWS, LEAST_FILES, EPOCHS = 25_000, 16, 4
STATE_FILES = 64  # a part of a state that grows with the table holds the rows of so many files at most


def _files(spark, path):
    return sum(name.endswith(".parquet") for name in names_in(spark, path))


def _as_stream(rows, label, path=None):
    """Write ``rows`` as files of bounded size and open them as a stream that takes some at a time.

    An epoch has a cost of its own, and some of it grows with the state, so a large table comes in ``EPOCHS`` epochs, as a
    backlog would. Smaller ones come ``LEAST_FILES`` files at a time.
    """
    path = path or fresh_path(rows.sparkSession, label)
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    most = max(LEAST_FILES, -(-_files(rows.sparkSession, path) // EPOCHS))
    return feed.image_feed(rows.sparkSession, path, rows.schema, max_files=most)


def stream_images(spark, sf_dir):
    parsed = parse_images(_as_stream(st.image_files(spark, sf_dir), "image-feed"))
    return feed.drain_to_table(parsed, "images").drop("experiment", "seen")


def stream_complete_sets(spark, sf_dir):
    images = table(spark, sf_dir, "events").select(
        "user_id", F.weekofyear("ts").alias("week"), "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    sets = complete_sets(_as_stream(images, "channel-feed"), ["user_id", "week"], "event_type", EVENT_TYPES, "ts", keep_days=60)
    return feed.drain_to_table(sets, "complete-sets")


def _requests(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("experiment"), (F.col("event_id") % 40).alias("batchid"), F.col("ts").cast("timestamp").alias("ts")
    )


def register_batches(spark, sf_dir):
    requests = bt.new_requests(_as_stream(_requests(spark, sf_dir), "requests"), keep_days=60)
    # Batches of purchases are stored already; one of high value is done.
    bought = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    stored = bought.groupBy(F.col("user_id").alias("experiment"), (F.col("event_id") % 40).alias("batchid")).agg(
        F.when(F.max("value") > 10, bt.DONE).otherwise(bt.REGISTERED).alias("status")
    )
    return feed.drain_to_table(bt.registration_outcomes(requests, stored), "registrations")


STATUS = {"signup": bt.REGISTERED, "view": bt.PROCESSING, "click": bt.UPLOADING, "purchase": bt.DONE, "error": "failed.1"}


def _status_events(spark, sf_dir):
    status = F.col("event_type")
    for event, name in STATUS.items():
        status = F.when(F.col("event_type") == event, name).otherwise(status)
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("experiment"), F.col("user_id").alias("batchid"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
    )


def _shown(folded):
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    times = [F.date_format(c, stamp).alias(c) for c in ("start_time", "end_time")]
    return folded.select("experiment", "batchid", "status", *times)


def status_fold(spark, sf_dir):
    return _shown(bt.fold_status(_status_events(spark, sf_dir)))


def batch_list(spark, sf_dir):
    # Customers as batches; most have no events.
    known = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 10).alias("experiment"), F.col("c_custkey").alias("batchid"))
    return _shown(progress.batch_list(known, bt.fold_status(_status_events(spark, sf_dir))))


def status_marks(spark, sf_dir):
    """Marks written as a table and folded with the events of before: each marked batch has the new status."""
    root = fresh_path(spark, "marks")
    events = _status_events(spark, sf_dir).withColumn("exit_code", F.lit(None).cast("int"))
    columns = [part.split()[0] for part in STATUS_EVENT.split(", ")]
    marked = events.where(F.col("status") == bt.UPLOADING).select("experiment", "batchid").distinct()
    append_rows({"events": events.select(*columns)}, root)
    append_rows({"events": bt.status_marks(marked, bt.DONE).select(*columns)}, root)
    folded = bt.fold_status(spark.read.schema(STATUS_EVENT).parquet(f"{root}/events"))
    recent = F.col("end_time") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return folded.select("experiment", "batchid", "status", F.coalesce(recent, F.lit(False)).alias("marked_now"))


def stream_status_fold(spark, sf_dir):
    folded = bt.fold_status_by_period(_as_stream(_status_events(spark, sf_dir), "status-feed"))
    return _shown(bt.merge_periods(feed.drain_updates(folded, "status")))


def stream_experiment_done(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sites = events.select(F.col("user_id").alias("experiment"), F.hour("ts").alias("site"))  # sites come again and again
    expected = events.select(F.col("user_id").alias("experiment")).distinct().withColumn("expected_sites", F.lit(24))
    counts = bt.finished_experiments(_as_stream(sites, "site-feed"), expected)
    done = feed.drain_updates(counts, "finished", bt.just_finished, once=["experiment"])
    return done.select("experiment", "n_sites")


class _Feed:
    """Rows as a stream, and a last row that belongs to no key long after the others: all timers and bounds have passed then."""

    def __init__(self, rows, label, time, key, none=None):
        self.rows, self.time, self.key, self.none = rows, time, key, none
        self.path, self.last = fresh_path(rows.sparkSession, label), None
        self.stream = _as_stream(rows, label, self.path)
        self.files = _files(rows.sparkSession, self.path)

    def end(self):
        if self.last is None:
            last = self.rows.orderBy(F.desc_nulls_last(self.time)).limit(1)
            last = last.withColumn(self.key, F.lit(self.none).cast(self.rows.schema[self.key].dataType))
            self.last = materialize(last.withColumn(self.time, F.col(self.time) + F.expr("INTERVAL 20000 DAYS")), "last-row")
        self.last.write.mode("append").parquet(self.path)


def _parts(spark, feeds):
    """Parts of a state that grows with the feeds: rounds of one task per core, as a part costs time of its own in each epoch."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(1, -(-sum(own.files for own in feeds) // (STATE_FILES * cores)))


def _to_the_end(stream, feeds, label, rocks_db=False, partitions=None):
    """What the stream gives for all rows: drained, and started again from its checkpoint when the last rows are there.

    The last rows come twice, as the time they bring counts from the next batch on.
    """
    target = fresh_path(stream.sparkSession, label)
    feed.drain_to_table(stream, label, target, rocks_db=rocks_db, partitions=partitions)
    for _ in range(2):
        for own in feeds:
            own.end()
        told = feed.drain_to_table(stream, label, target, rocks_db=rocks_db, partitions=partitions)
    return told


def _weekly(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.weekofyear("ts").alias("week"), "event_type", F.col("ts").cast("timestamp").alias("ts")
    )


def stream_incomplete_sets(spark, sf_dir):
    images = _Feed(_weekly(spark, sf_dir).drop("event_id"), "channel-feed", "ts", "user_id")
    told = outcomes.set_outcomes(images.stream, ["user_id", "week"], "event_type", EVENT_TYPES, "ts", keep_days=60)
    late = _to_the_end(told, [images], "set-outcomes", rocks_db=True).where(F.col("outcome") == "incomplete")
    return late.select(
        "user_id", "week", F.concat_ws(",", "channels").alias("channels"), F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSS").alias("at")
    )


def stream_retries(spark, sf_dir):
    # A user's events of a week are the attempts on one set, those that ran after its end included.
    code = F.when(F.col("event_type").isin("error", "view"), 137).when(F.col("event_type") == "purchase", 1).otherwise(0)
    turn = Window.partitionBy("user_id", "week").orderBy("ts", "event_id")
    attempts = _weekly(spark, sf_dir).select(
        "user_id", "week", (F.row_number().over(turn) - 1).alias("attempt"), code.alias("exit_code"), "ts"
    )
    ran = _Feed(attempts, "attempt-feed", "ts", "user_id")
    told = outcomes.retries(ran.stream, ["user_id", "week"], "ts", most=4, keep_days=60)
    # The last row, whose set has no end, is asked for again as well: it has no user.
    rows = _to_the_end(told, [ran], "retries", rocks_db=True).where("user_id IS NOT NULL")
    return rows.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSS"))


def stream_progress_rollup(spark, sf_dir):
    sites = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("experiment"), (F.col("event_id") * 7 % 100_003).alias("site"))
    done = totals.drain_progress(_as_stream(sites.unionByName(sites), "site-feed"), ["experiment"], "site")  # each site twice
    expected = sites.select("experiment").distinct().withColumn("n_expected", F.col("experiment") * 500)
    return totals.progress_share(done, expected, ["experiment"], "n_expected")


def stream_number_sets(spark, sf_dir):
    images = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("experiment"), (F.col("l_partkey") % 96).alias("well"), (F.col("l_orderkey") % 4).alias("site"),
        F.col("l_shipdate").cast("timestamp").alias("seen"),
    )
    first = next_batch_id(st.experiments(spark, sf_dir).select("experiment"), st.batches(spark, sf_dir))
    numbered = totals.drain_numbered(_as_stream(images, "image-feed"), "experiment", ["well", "site"], "seen", first, keep_days=4000)
    # Which set gets which id follows from the order of the files.
    return numbered.groupBy("experiment").agg(
        F.count("*").alias("n_sets"), F.count_distinct("well", "site").alias("n_different"),
        F.count_distinct("batchid").alias("n_ids"), F.min("batchid").alias("first_id"), F.max("batchid").alias("last_id"),
    )


def stream_coordinates(spark, sf_dir):
    # Items as images, orders as stage positions: an item shipped over 30 days after its order has none.
    images = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("seen")
    )
    stage = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").cast("timestamp").alias("t"), (F.col("o_custkey") * 0.5).alias("x_mm")
    )
    # Rows with a null key never reach the join, nor does their time.
    feeds = _Feed(images, "image-feed", "seen", "orderkey"), _Feed(stage, "stage-feed", "t", "orderkey", -1)
    joined = totals.join_coordinates(feeds[0].stream, feeds[1].stream, ["orderkey"], "seen", "t", 30 * 24 * 60, keep_days=4000)
    met = _to_the_end(joined, feeds, "with-coordinates", rocks_db=True, partitions=_parts(spark, feeds))
    return met.select("orderkey", "l_linenumber", F.col("t").isNotNull().alias("found"), "x_mm")


QUERIES = {
    f.__name__: f
    for f in (
        stream_incomplete_sets, stream_retries, stream_progress_rollup, stream_number_sets, stream_coordinates, stream_images, stream_complete_sets, register_batches, status_fold, batch_list, status_marks, stream_status_fold,
        stream_experiment_done,
    )
}

_FOLD = """WITH e AS (
    SELECT user_id % 10 AS experiment, user_id AS batchid, ts, event_id AS seq,
           CASE event_type WHEN 'signup' THEN 'registered' WHEN 'view' THEN 'processing images'
             WHEN 'click' THEN 'uploading results to storage' WHEN 'purchase' THEN 'done' ELSE 'failed.1' END AS status FROM events),
  r AS (SELECT *, row_number() OVER (PARTITION BY batchid ORDER BY ts DESC, seq DESC) AS rn FROM e)
  SELECT experiment, batchid, max(CASE WHEN rn = 1 THEN status END) AS status,
         strftime(max(CASE WHEN status = 'processing images' THEN ts END), '%Y-%m-%d %H:%M:%S.%f') AS start_time,
         strftime(max(CASE WHEN status IN ('done', 'failed.1') THEN ts END), '%Y-%m-%d %H:%M:%S.%f') AS end_time
  FROM r GROUP BY experiment, batchid"""

ORACLE = {
    "stream_incomplete_sets": """SELECT user_id, weekofyear(ts)::INTEGER AS week, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS channels,
             strftime(max(ts) + INTERVAL 60 DAY, '%Y-%m-%d %H:%M:%S.%g') AS at
      FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) < 5""",
    "stream_retries": """WITH a AS (
        SELECT user_id, weekofyear(ts)::INTEGER AS week, ts,
               (row_number() OVER (PARTITION BY user_id, weekofyear(ts) ORDER BY ts, event_id) - 1)::INTEGER AS attempt,
               CASE WHEN event_type IN ('error', 'view') THEN 137 WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS code FROM events),
      b AS (SELECT *, coalesce(min(CASE WHEN code <> 137 OR attempt = 3 THEN attempt END) OVER (PARTITION BY user_id, week), 99) AS last FROM a)
      SELECT user_id, week, attempt,
             CASE code WHEN 137 THEN 'failed.OOM(' || attempt || ')' WHEN 1 THEN 'failed.1' ELSE 'done' END AS status,
             CASE WHEN attempt < last THEN (attempt + 1)::INTEGER END AS next_attempt,
             strftime(ts + CASE WHEN attempt < last THEN 10 * 2 ** attempt ELSE 0 END * INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S.%g') AS at
      FROM b WHERE attempt <= last""",
    "stream_progress_rollup": """SELECT user_id % 10 AS experiment, user_id % 10 * 500 AS n_expected, count(DISTINCT event_id * 7 % 100003) AS n,
             CASE WHEN user_id % 10 > 0 THEN floor(100.0 * count(DISTINCT event_id * 7 % 100003) / (user_id % 10 * 500) + 0.5)::BIGINT END AS percent_done
      FROM events GROUP BY user_id % 10""",
    "stream_number_sets": f"""WITH {st.SQL_BATCHES}, sets AS (
        SELECT l_suppkey AS experiment, count(DISTINCT (l_partkey % 96) * 4 + l_orderkey % 4) AS n FROM lineitem GROUP BY 1),
      last AS (SELECT experiment, max(batchid) AS b FROM batches GROUP BY 1)
      SELECT experiment, n AS n_sets, n AS n_different, n AS n_ids, b + 1 AS first_id, b + n AS last_id FROM sets JOIN last USING (experiment)""",
    "stream_coordinates": """SELECT l_orderkey AS orderkey, l_linenumber, o_orderkey IS NOT NULL AS found, o_custkey * 0.5::DOUBLE AS x_mm
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
       AND o_orderdate BETWEEN l_shipdate - INTERVAL 30 DAY AND l_shipdate + INTERVAL 30 DAY""",
    "stream_images": f"""WITH {st.SQL_IMAGES}
      SELECT l_orderkey, l_linenumber, path, well, site, site_x, site_y, site_z::INTEGER AS site_z, channel FROM files WHERE ok""",
    "stream_complete_sets": """SELECT user_id, weekofyear(ts)::INTEGER AS week, 5::INTEGER AS n_channels FROM events
      GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 5""",
    "register_batches": """WITH r AS (
        SELECT user_id AS experiment, event_id % 40 AS batchid, max(CASE WHEN event_type = 'purchase' THEN value END) AS spent
        FROM events GROUP BY 1, 2)
      SELECT experiment, batchid, CASE WHEN spent IS NULL THEN 'registered' ELSE 'done' END AS status,
             CASE WHEN spent IS NULL THEN 'new' ELSE 'conflict' END AS outcome
      FROM r WHERE spent IS NULL OR spent > 10""",
    "status_fold": _FOLD,
    "stream_status_fold": _FOLD,
    "batch_list": f"""SELECT c_custkey % 10 AS experiment, c_custkey AS batchid, coalesce(status, 'registered') AS status, start_time, end_time
      FROM customer LEFT JOIN ({_FOLD}) ON c_custkey = batchid AND c_custkey % 10 = experiment""",
    "status_marks": f"""WITH marked AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'click')
      SELECT experiment, batchid, CASE WHEN user_id IS NULL THEN status ELSE 'done' END AS status, user_id IS NOT NULL AS marked_now
      FROM ({_FOLD}) LEFT JOIN marked ON batchid = user_id""",
    "stream_experiment_done": """SELECT user_id AS experiment, count(DISTINCT hour(ts)) AS n_sites FROM events
      GROUP BY user_id HAVING count(DISTINCT hour(ts)) = 24""",
}
