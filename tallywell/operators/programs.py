"""Mapper and reducer programs that read lines and write ``key<tab>value`` lines, run beside Spark's tasks."""

from __future__ import annotations

import subprocess
import threading
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LINES = 4096  # lines that go to a program, and that come from it, at a time


def _run(program: Sequence[str], batches: Iterator[list[str]]) -> Iterator[list[str]]:
    """Lines that ``program`` writes, while the lines of ``batches`` are written to it."""
    process = subprocess.Popen(  # noqa: S603 - the caller's program
        list(program), cwd=SparkFiles.getRootDirectory(), stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE
    )
    said: deque[bytes] = deque(maxlen=20)
    failed: list[BaseException] = []

    def feed() -> None:
        try:
            for lines in batches:
                process.stdin.write("".join(f"{line}\n" for line in lines).encode())
        except BrokenPipeError:
            pass  # it has read all that it wants; its exit code tells whether that is right
        except BaseException as problem:  # noqa: BLE001 - raised below, in the task's own thread
            failed.append(problem)
            process.kill()
        finally:
            try:
                process.stdin.close()
            except BrokenPipeError:
                pass

    threads = [threading.Thread(target=feed, daemon=True), threading.Thread(target=lambda: said.extend(process.stderr), daemon=True)]
    for thread in threads:
        thread.start()
    try:
        held: list[str] = []
        for line in process.stdout:
            held.append(line.decode().removesuffix("\n"))
            if len(held) == _LINES:
                yield held
                held = []
        if held:
            yield held
        for thread in threads:
            thread.join()
        code = process.wait()
    finally:
        process.kill()  # also when the task is stopped early
    if failed:
        raise failed[0]
    if code:
        raise RuntimeError(f"{' '.join(program)} ended with {code}: {b''.join(said).decode(errors='replace')[-2000:]}")


def pipe_lines(lines: DataFrame, program: Sequence[str], column: str = "value") -> DataFrame:
    """(value) lines that ``program`` writes, one run of it per partition; a partition without lines has none.

    A null is an empty line. Any exit code but 0 fails the task with the last lines of what the program said.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (b for b in batches if b.num_rows)
        first = next(filled, None)
        if first is None:
            return

        def texts() -> Iterator[list[str]]:
            yield [line or "" for line in first.column(0).to_pylist()]
            for batch in filled:
                yield [line or "" for line in batch.column(0).to_pylist()]

        for own in _run(program, texts()):
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string())], ["value"])

    return lines.select(F.col(column).cast("string")).mapInArrow(of, "value string")


def _by_key(lines: DataFrame) -> DataFrame:
    """With the part before the first tab as ``key``; a line without a tab is all key."""
    return lines.withColumn("key", F.substring_index("value", "\t", 1))


def map_reduce(
    lines: DataFrame, mapper: Sequence[str], reducer: Sequence[str], combiner: Sequence[str] | None = None,
    files: Sequence[str] = (), reducers: int | None = None, column: str = "value",
) -> DataFrame:
    """(value) lines that the reducers write.

    ``mapper`` reads lines and writes ``key<tab>value`` lines; a reducer reads all lines of its keys, sorted by key and line,
    and so does ``combiner`` with what one mapper has written. The programs are run in a folder that holds ``files``, which
    Spark brings to the executors. A key goes to one reducer, as a reducer may do anything with its lines; give a combiner
    where a key may hold many of them, so that each mapper sends only its few. ``reducers``: how many at most.
    """
    context = lines.sparkSession.sparkContext
    for file in files:
        context.addFile(file)
    mapped = _by_key(pipe_lines(lines, mapper, column))
    if combiner:
        mapped = _by_key(pipe_lines(mapped.sortWithinPartitions("key", "value"), combiner))
    dealt = mapped.repartition(reducers, "key") if reducers else mapped.repartition("key")
    return pipe_lines(dealt.sortWithinPartitions("key", "value"), reducer)
