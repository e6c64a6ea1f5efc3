"""Objects of a store by reference: written and fetched inside tasks, without listing the store."""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.storage import materialize

#: References a task fetches, and how many of them at a time.
OBJECTS_PER_TASK, AT_A_TIME = 1000, 16
#: Largest object, and bytes of objects that go to Spark at once.
MOST_BYTES, BATCH_BYTES = 1 << 28, 64 << 20

_FETCHED = "path string, n_references long, length long, content binary, reason string"
_FETCHED_ARROW = pa.schema([
    ("path", pa.string()), ("n_references", pa.int64()), ("length", pa.int64()), ("content", pa.binary()), ("reason", pa.string()),
])


_store = functools.cache(fs.FileSystem.from_uri)


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path there of a plain path or URI (file:, hdfs:, s3:, gs: and others that Arrow opens).

    As with Hadoop's paths, nothing in a path is escaped.
    """
    scheme, host, place = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        return _store("/")[0], f"{host or ''}{place}"
    store, root = _store(f"{scheme}://{host or ''}/")
    return store, root.rstrip("/") + place


def put_objects(rows: DataFrame, path: str = "path", content: str = "content") -> int:
    """Write each row's content (binary) as the object at its path; returns how many.

    An object gets its name once it is whole, so a task that is repeated replaces it by the same.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = open_store(name)
                store.create_dir(place.rpartition("/")[0])
                own = f"{place}.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(own) as out:
                    out.write(data or b"")
                store.move(own, place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    written = rows.select(path, content).mapInArrow(of, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()
    return int(written[0])


def fetch_objects(references: DataFrame, path: str = "path", most_bytes: int = MOST_BYTES) -> DataFrame:
    """path, n_references, length, content, reason: each different object of ``references``, fetched once.

    The tasks are planned from the references, some for each, whatever lies beside the objects in the store. ``reason``: null,
    or why there is no content (no path, not found, not a file, too large). Other failures, such as a store that cannot be
    reached, fail the task, which Spark repeats.
    """
    counted = materialize(
        references.select(F.col(path).alias("path")).groupBy("path").agg(F.count("*").alias("n_references")), "references"
    )
    spark = references.sparkSession
    tasks = max(-(-counted.count() // OBJECTS_PER_TASK), spark.sparkContext.defaultParallelism)

    def fetch(name: str | None) -> tuple[int | None, bytes | None, str | None]:
        if name is None:
            return None, None, "no path"
        store, place = open_store(name)
        info = store.get_file_info(place)
        if info.type == fs.FileType.NotFound:
            return None, None, "not found"
        if info.type != fs.FileType.File:
            return None, None, "not a file"
        if info.size is not None and info.size > most_bytes:
            return info.size, None, "too large"
        with store.open_input_stream(place) as data:
            content = data.read()
        return len(content), content, None

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FETCHED_ARROW)], schema=_FETCHED_ARROW)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(AT_A_TIME) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, AT_A_TIME):
                    own = batch.slice(at, AT_A_TIME)
                    found = list(pool.map(fetch, own.column(0).to_pylist()))
                    rows, held = [], 0
                    for name, n, (length, content, reason) in zip(own.column(0).to_pylist(), own.column(1).to_pylist(), found):
                        rows.append((name, n, length, content, reason))
                        held += length or 0
                        if held >= BATCH_BYTES:
                            yield as_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield as_batch(rows)

    # A number of partitions of our own: the references are small, and Spark would read them in one task.
    return counted.repartition(tasks, "path").mapInArrow(of, _FETCHED)
