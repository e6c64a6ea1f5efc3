"""Totals kept while a stream runs: progress as bitmaps, and ids given out in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.operators.indexing import index_rows
from tallywell.storage import EpochLog, fresh_path
from tallywell.streaming import timed_join
from tallywell.streaming.feed import drain_epochs, read_or_empty

# --- progress --------------------------------------------------------------------------------------------------


def site_bitmaps(sites: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """(keys, bucket, bits): the different numbers (0 and up) of each key, 32,768 to a bucket of 4 KB."""
    value = F.col(number).cast("bigint")
    valid = sites.where(value >= 0)
    # Positions are those of Spark's bitmap functions: bucket b holds the numbers from (b - 1) * 32768 + 1 on.
    return valid.groupBy(*keys, F.bitmap_bucket_number(value + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value + 1)).alias("bits")
    )


def merge_bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _bitmap_log(spark: SparkSession, path: str, schema: str, keys: Sequence[str]) -> EpochLog:
    return EpochLog(spark, path, schema, lambda rows: merge_bitmaps(rows, keys))


def drain_progress(stream: DataFrame, keys: Sequence[str], number: str, label: str = "progress", path: str | None = None) -> DataFrame:
    """(keys, n): how many different numbers each key has had, after all input that is there; null and negative ones don't count.

    Each epoch adds the bitmaps of its rows; a union of bitmaps takes no notice of rows that come again, in this epoch or a
    later one, and of an epoch that is repeated. No operator keeps state, and no key has more rows than it has buckets.
    """
    spark = stream.sparkSession
    target = path or fresh_path(spark, label)
    types = ", ".join(f"`{k}` {stream.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{types}, bucket bigint, bits binary"
    drain_epochs(
        stream.select(*keys, number), label,
        lambda batch, epoch: _bitmap_log(batch.sparkSession, target, schema, keys).write(epoch, site_bitmaps(batch, keys, number)) and None,
        target,
    )
    total = _bitmap_log(spark, target, schema, keys).total()
    return total.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def progress_share(done: DataFrame, expected: DataFrame, keys: Sequence[str], n_expected: str) -> DataFrame:
    """``expected`` with ``n`` (0 if none) and ``percent_done``, rounded half up; null where nothing is expected."""
    joined = expected.join(done, list(keys), "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    share = F.floor(F.try_divide(100.0 * F.col("n"), F.col(n_expected).cast("double")) + 0.5)
    return joined.withColumn("percent_done", share)


# --- ids -------------------------------------------------------------------------------------------------------


def drain_numbered(
    images: DataFrame, experiment: str, set_key: Sequence[str], time: str, first_ids: DataFrame, keep_days: int = 7,
    label: str = "numbered", path: str | None = None,
) -> DataFrame:
    """(experiment, set key, batchid, epoch): an id for each set that a stream of images brings, after all input that is there.

    Ids of an experiment go up without gaps from ``first_ids`` (experiment, next_id; 0 for others), by epoch and within it in the
    order of the set key. A set is numbered once, when its first image comes; an image up to ``keep_days`` late is known. An
    epoch that is repeated numbers the same sets from the same counts and replaces what it wrote, so no id is
    lost or given twice, whenever the stream fails. Only counts per experiment are carried from epoch to epoch, and the sets
    that are known, in RocksDB.
    """
    spark = images.sparkSession
    target = path or fresh_path(spark, label)
    key = [experiment, *set_key]
    fresh = (
        images.select(*key, F.col(time).cast("timestamp").alias(time)).withWatermark(time, f"{keep_days} days")
        .dropDuplicatesWithinWatermark(key)
    )
    kind = images.schema[experiment].dataType.simpleString()

    def counts(session: SparkSession) -> EpochLog:
        merge = lambda rows: rows.groupBy(experiment).agg(F.sum("n").alias("n"))
        return EpochLog(session, f"{target}/counts", f"`{experiment}` {kind}, n bigint", merge)

    def number(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        log = counts(session)
        used = log.before(epoch).withColumnRenamed("n", "_used")
        start = F.coalesce("next_id", F.lit(0)) + F.coalesce("_used", F.lit(0))
        ranked = index_rows(batch.select(*key), list(set_key), "_rank", within=[experiment])
        told = ranked.join(used, experiment, "left").join(first_ids.select(experiment, "next_id"), experiment, "left")
        own = f"{target}/sets/epoch={epoch}"
        told.select(*key, (start + F.col("_rank")).alias("batchid")).write.mode("overwrite").parquet(own)
        log.write(epoch, session.read.parquet(own).groupBy(experiment).agg(F.count("*").alias("n")))

    drain_epochs(fresh, label, number, target, rocks_db=True)
    schema = images.select(*key).schema.add("batchid", T.LongType()).add("epoch", T.IntegerType())
    return read_or_empty(spark, f"{target}/sets", schema)


# --- coordinates -----------------------------------------------------------------------------------------------


def join_coordinates(
    images: DataFrame, coordinates: DataFrame, on: Sequence[str], seen: str, recorded: str, within_minutes: int, keep_days: int = 1
) -> DataFrame:
    """Stream of images with the coordinates that a second stream brings for their ``on`` columns.

    Coordinates belong to an image if they were recorded at most ``within_minutes`` before or after it. An image without any
    comes with nulls once no more can come: ``within_minutes`` and ``keep_days``, by which either stream may be late, after it.
    State is dropped at the same time. Rows with a null in ``on`` have no partner, those with a null time are dropped.
    Many keys share a state (``timed_join``); Spark's own join, a state per row, is for columns that this can't hold.
    """
    known = coordinates.where(F.col(recorded).isNotNull())
    for c in on:
        known = known.where(F.col(c).isNotNull())
    right = known.withColumn(recorded, F.col(recorded).cast("timestamp")).withWatermark(recorded, f"{keep_days} days")
    left = images.where(F.col(seen).isNotNull()).withColumn(seen, F.col(seen).cast("timestamp")).withWatermark(seen, f"{keep_days} days")
    if timed_join.can_pack(left, right, on):
        return timed_join.join_within(left, right, on, seen, recorded, within_minutes)
    others = [c for c in coordinates.columns if c not in on and c != recorded]
    right = right.select(*[F.col(c).alias(f"_{c}") for c in on], F.col(recorded).alias(f"_{recorded}"), *others)
    bound = F.expr(f"INTERVAL {within_minutes} MINUTES")
    met = [F.col(c) == F.col(f"_{c}") for c in on]
    near = (F.col(f"_{recorded}") >= F.col(seen) - bound) & (F.col(f"_{recorded}") <= F.col(seen) + bound)
    return left.join(right, [*met, near], "leftOuter").select(*images.columns, F.col(f"_{recorded}").alias(recorded), *others)
