"""Starting and draining streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType, TimestampType

from tallywell.storage import fresh_path


def image_feed(spark: SparkSession, path: str, schema: StructType | str, max_files: int = 1_000) -> DataFrame:
    """Stream of rows from Parquet files as they appear below ``path``, each file once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def merge_repeats(rows: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Keep one row per key and Arrow batch, with its latest time.

    Stateless, so it may stand before any stateful step: a hot key then reaches
    that step's single task once per Arrow batch instead of once per row.
    """

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby(list(keys), as_index=False, dropna=False)[time].max()

    kept = rows.select(*keys, F.col(time).cast("timestamp").alias(time))
    return kept.mapInPandas(merge, kept.schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``; without rows when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


_STORE = "spark.sql.streaming.stateStore"
_ROCKS_DB = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All stores of an executor share one bound, and an epoch stores what it changed.
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    # Each put would look up its key to count the rows.
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    # Both sides of a join share one store per partition.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def _state_on_disk(spark: SparkSession, wanted: bool, partitions: int | None = None) -> Iterator[None]:
    """Streams that start meanwhile keep their state in RocksDB, if ``wanted``, and in ``partitions`` parts, if given."""
    own = (_ROCKS_DB if wanted else {}) | ({_PARTITIONS: str(partitions)} if partitions else {})
    before = {key: spark.conf.get(key, None) for key in own}
    try:
        for key in own:
            spark.conf.set(key, own[key])
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def drain_to_table(
    stream: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None, rocks_db: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Process all input that is there, append the result to a Parquet table, return it as a batch frame.

    Progress is kept in the checkpoint, so the next call with the same paths goes on from there. ``rocks_db``: state on
    the executors' disks instead of in their heap, for state that grows with the table. ``partitions``: how many parts it
    has from the first start on, instead of the session's shuffle partitions.
    """
    spark = stream.sparkSession
    target = path or fresh_path(spark, label)
    with _state_on_disk(spark, rocks_db, partitions):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint or f"{target}-progress")
            .trigger(availableNow=True)
            .start(target)
        )
    query.awaitTermination()
    return read_or_empty(spark, target, stream.schema)


def drain_epochs(
    stream: DataFrame, label: str, work: Callable[[DataFrame, int], None], path: str | None = None, mode: str = "append",
    rocks_db: bool = False,
) -> str:
    """Process all input that is there with ``work(batch, epoch)``; returns the folder that its progress belongs to.

    A repeated epoch calls ``work`` again with the same rows and number, so it must replace what it wrote before.
    ``rocks_db``: see ``drain_to_table``.
    """
    target = path or fresh_path(stream.sparkSession, label)
    with _state_on_disk(stream.sparkSession, rocks_db):
        query = (
            stream.writeStream.foreachBatch(work)
            .outputMode(mode)
            .option("checkpointLocation", f"{target}-progress")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return target


def drain_updates(
    stream: DataFrame, label: str, keep: Callable[[DataFrame], DataFrame] | None = None, path: str | None = None,
    once: Sequence[str] = (),
) -> DataFrame:
    """Like ``drain_to_table`` for aggregates in update mode: changed rows go to one folder per epoch.

    A repeated epoch overwrites its own folder, so a retry does not add rows twice. With ``once``, a row whose
    key an earlier epoch has written is left out.
    """
    spark = stream.sparkSession
    target = path or fresh_path(spark, label)
    written = StructType(stream.schema.fields).add("epoch", IntegerType())

    def store(batch: DataFrame, epoch: int) -> None:
        rows = keep(batch) if keep else batch
        if once:
            earlier = read_or_empty(batch.sparkSession, target, written).where(F.col("epoch") < epoch)
            rows = rows.join(earlier.select(*once), list(once), "left_anti")
        rows.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    query = (
        stream.writeStream.foreachBatch(store)
        .outputMode("update")
        .option("checkpointLocation", f"{target}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_or_empty(spark, target, written)


def drain_late(stream: DataFrame, time: str, keep_days: int, label: str, path: str | None = None) -> DataFrame:
    """The table of rows that a watermark of ``keep_days`` on ``time`` drops from the same feed.

    As with Spark's watermark, a row is late if it is older than the newest time of the epochs before less
    ``keep_days``. Those times are one row per epoch, kept beside the table, so a repeated epoch decides alike.
    """
    spark = stream.sparkSession
    target = path or fresh_path(spark, label)
    rows_path, newest_path = f"{target}/rows", f"{target}/newest"
    newest_schema = StructType().add("newest", TimestampType()).add("epoch", IntegerType())

    def store(batch: DataFrame, epoch: int) -> None:
        before = read_or_empty(batch.sparkSession, newest_path, newest_schema).where(F.col("epoch") < epoch)
        bound = before.agg(F.max("newest")).scalar() - F.make_dt_interval(F.lit(keep_days))
        batch.where(F.col(time) < bound).write.mode("overwrite").parquet(f"{rows_path}/epoch={epoch}")
        batch.agg(F.max(time).alias("newest")).write.mode("overwrite").parquet(f"{newest_path}/epoch={epoch}")

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{target}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_or_empty(spark, rows_path, StructType(stream.schema.fields).add("epoch", IntegerType())).drop("epoch")
