"""Shared-folder storage: scratch locations, lineage cuts, partitioned writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; a
    cluster session without it is an error, since a machine-local folder would
    vanish with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tallywell-")
    return _local_roots[context.applicationId]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tallywell/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared root, in the folder of this application."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete all that this application has stored below the shared root.

    Stored tables live until this is called, as any frame made from them may still be read. Call it at the end.
    """
    delete(spark, _own_folder(spark))


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: values that depend on the physical layout (partition ids,
    sort positions) are fixed from here on, even when executors are lost.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, by: list[str | Column], mode: str = "errorifexists", max_records: int = 5_000_000
) -> None:
    """Write ``df`` partitioned by ``by`` with few, evenly sized files.

    The rebalance hint gathers the rows of a partition value, and lets AQE split a
    value that holds too many rows over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*by)
        .parquet(path)
    )


def append_rows(rows: dict[str, DataFrame], root: str) -> None:
    """Append each frame to its table, the folder ``root/<table>``.

    Rows that come from reading the same table are safe: Spark fixes the file list when it plans.
    """
    for name, frame in rows.items():
        frame.write.mode("append").parquet(f"{root}/{name}")


class EpochLog:
    """Totals of a stream: what each epoch adds, and every so often all epochs merged into one table.

    ``merge`` brings rows of several epochs together (a sum, a union of bitmaps); it must give the same for merged rows and for
    those that they were merged from. An epoch is replaced when it is repeated, and reads only epochs before its own, at most
    ``every`` of them and one merged table. So a repeated epoch decides alike, and work doesn't grow with the stream's age.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], every: int = 8):
        self.spark, self.path, self.schema, self.merge, self.every = spark, path, schema, merge, every

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def before(self, epoch: int) -> DataFrame:
        """All that epochs before ``epoch`` have added, merged."""
        base = epoch // self.every * self.every
        paths = [f"{self.path}/merged={base}"] if base else []
        return self.merge(self._read([*paths, *(f"{self.path}/epoch={e}" for e in range(base, epoch))]))

    def write(self, epoch: int, rows: DataFrame) -> DataFrame:
        """Replace what ``epoch`` adds; returns it as stored."""
        own = f"{self.path}/epoch={epoch}"
        rows.write.mode("overwrite").parquet(own)
        if (epoch + 1) % self.every == 0:
            self._merge_before(epoch + 1)
        return self._read([own])

    def _merge_before(self, base: int) -> None:
        """Merge all epochs before ``base``. Those that even a repeated epoch no longer reads are deleted."""
        earlier = base - self.every
        paths = [f"{self.path}/merged={earlier}"] if earlier else []
        paths += [f"{self.path}/epoch={e}" for e in range(earlier, base)]
        self.merge(self._read(paths)).write.mode("overwrite").parquet(f"{self.path}/merged={base}")
        for old in (*(f"epoch={e}" for e in range(earlier - self.every, earlier)), f"merged={earlier - self.every}"):
            delete(self.spark, f"{self.path}/{old}")

    def total(self) -> DataFrame:
        """All that was added so far, merged."""
        epochs = [int(name.partition("=")[2]) for name in names_in(self.spark, self.path) if name.startswith("epoch=")]
        return self.before(max(epochs, default=-1) + 1)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    store, place = _file_system(spark, path)
    store.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    store, place = _file_system(spark, path)
    return [found.getPath().getName() for found in store.listStatus(place)] if store.exists(place) else []
