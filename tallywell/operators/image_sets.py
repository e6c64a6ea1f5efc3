"""Image sets: all images of one (experiment, well, site), and the work done per set."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.operators.indexing import index_rows
from tallywell.storage import materialize

SET_KEY = ("experiment", "well", "site")


def listed_files(files: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """(keys, position, path): the paths of each key in order, numbered from 0.

    One row per path, whatever the size of the key: no row or task holds the paths of a key.
    """
    return index_rows(files.select(*keys, path), [path], "position", within=keys).select(*keys, "position", path)


def image_sets(images: DataFrame, path: str = "path") -> DataFrame:
    """The images of each set; channels and planes share one set."""
    return listed_files(images, SET_KEY, path)


def files_by_name(files: DataFrame, name: str = "filename", path: str = "s3path") -> DataFrame:
    """The result files of each file name."""
    return listed_files(files, [name], path)


def number_image_sets(images: DataFrame, next_ids: DataFrame, first_seen: str) -> DataFrame:
    """(set key, n_images, batchid): a fresh batch id per set, in the order the sets were first seen.

    Ids go up without gaps from the experiment's next free one; all are handed
    out in one step, so two sets cannot get the same id.
    """
    sets = images.groupBy(*SET_KEY).agg(F.min(first_seen).alias("_first"), F.count("*").alias("n_images"))
    ranked = index_rows(sets, ["_first", "well", "site"], "_rank", within=["experiment"])
    return ranked.join(next_ids, "experiment").select(
        *SET_KEY, "n_images", (F.col("next_id") + F.col("_rank")).alias("batchid")
    )


def set_starts(rows: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Where each run of equal keys starts; null equals null."""
    starts = np.zeros(len(rows), bool)
    starts[:1] = True
    for name in keys:
        values, none = rows[name].to_numpy(), rows[name].isna().to_numpy()
        starts[1:] |= (values[1:] != values[:-1]).astype(bool) & ~(none[1:] & none[:-1])
    return np.flatnonzero(starts)


def _run_sets(
    rows: pd.DataFrame, keys: Sequence[str], work: Callable[[pd.DataFrame], pd.DataFrame], names: Sequence[str]
) -> Iterator[pd.DataFrame]:
    """Rows of ``work`` on many sets at once, and one row with the error for each set that it fails on.

    A run of sets that fails is halved until the failing set stands alone. All rows leave in two frames, as each has a
    cost of its own.
    """
    starts = np.append(set_starts(rows, keys), len(rows))
    todo = [(0, len(starts) - 1)] if len(rows) else []
    made, failed, errors = [], [], []
    while todo:
        a, b = todo.pop()
        try:
            made.append(work(rows.iloc[starts[a] : starts[b]].reset_index(drop=True))[[*keys, *names]])
        except Exception as problem:  # noqa: BLE001 - any failure of user code is recorded
            if b - a > 1:
                todo += [((a + b) // 2, b), (a, (a + b) // 2)]
            else:
                failed.append(starts[a])
                errors.append(str(problem))
    # Frames without rows would make objects of the others' numbers.
    made = [frame for frame in made if len(frame)]
    if made:
        yield (made[0] if len(made) == 1 else pd.concat(made, ignore_index=True)).assign(error=None)
    if failed:
        yield rows[[*keys]].iloc[failed].assign(error=errors, **dict.fromkeys(names))


def map_image_sets(
    images: DataFrame,
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    partial_schema: str,
    schema: str,
    keys: Sequence[str] = SET_KEY,
) -> DataFrame:
    """Run work on each image set: ``partial`` on pieces of sets, ``merge`` on what the pieces of a set gave.

    Both get rows of several sets, the rows of a set together, and return rows with the key columns: ``partial`` those
    of ``partial_schema``, ``merge`` those of ``schema``. Rows are spread in ranges of the keys and, within a set, of
    all columns, so no task holds a large set; pieces are merged in the same way whatever the size. A set that work fails
    on gives one row with its error, the others go on. Output: keys, status (done or failed), error, then ``schema``; a set
    whose work gives no row has one row of nulls with status done.
    """
    key_fields = [images.schema[k] for k in keys]
    error = T.StructField("error", T.StringType())
    piece_fields, result_fields = T.StructType.fromDDL(partial_schema).fields, T.StructType.fromDDL(schema).fields
    piece_names, result_names = [f.name for f in piece_fields], [f.name for f in result_fields]

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _run_sets(batch, keys, partial, piece_names)

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending = None
        for batch in batches:
            rows = batch if pending is None else pd.concat([pending, batch], ignore_index=True)
            starts = set_starts(rows, keys)
            last = int(starts[-1]) if len(starts) else 0
            pending = rows.iloc[last:].reset_index(drop=True)
            yield from _run_sets(rows.iloc[:last], keys, merge, result_names)
        if pending is not None:
            yield from _run_sets(pending, keys, merge, result_names)

    spread = images.repartitionByRange(*[F.col(c) for c in images.columns]).sortWithinPartitions(*keys)
    parts = materialize(spread.mapInPandas(first, T.StructType([*key_fields, *piece_fields, error])), "set-pieces")
    # A set has few pieces: one for each Arrow batch that holds rows of it.
    good = parts.where("error IS NULL").drop("error")
    merged = good.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        second, T.StructType([*key_fields, *result_fields, error])
    )
    merged = materialize(merged, "set-results")

    own = [f"_{k}" for k in keys]
    renamed = dict(zip(keys, own))
    errors = parts.select(*keys, "error").unionByName(merged.select(*keys, "error")).where("error IS NOT NULL")
    failed = errors.groupBy(*keys).agg(F.min("error").alias("error")).withColumnsRenamed(renamed)
    state = images.select(*keys).distinct().join(failed, [F.col(k).eqNullSafe(F.col(o)) for k, o in renamed.items()], "left")
    results = merged.where("error IS NULL").drop("error").withColumnsRenamed(renamed)
    told = state.drop(*own).join(
        results, [*[F.col(k).eqNullSafe(F.col(o)) for k, o in renamed.items()], F.col("error").isNull()], "left"
    )
    status = F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status")
    return told.select(*keys, status, "error", *result_names)


def retry_lineage(attempts: DataFrame, set_key: Sequence[str], order_by: Sequence[str], max_attempts: int | None = None) -> DataFrame:
    """Attempts with their 0-based number per set, status text, and whether another attempt follows.

    Only exit code 137 (out of memory) is tried again; ``max_attempts`` bounds the attempts of a set.
    """
    numbered = index_rows(attempts, order_by, "attempt", within=set_key)
    code = F.col("exit_code")
    status = (
        F.when(code == 0, "done")
        .when(code == 137, F.format_string("failed.OOM(%d)", F.col("attempt")))
        .otherwise(F.format_string("failed.%d", code))
    )
    again: Column = code == 137
    if max_attempts is not None:
        again = again & (F.col("attempt") + 1 < max_attempts)
    return numbered.withColumn("status", status).withColumn("retry", again)


def next_attempts(
    lineage: DataFrame, next_ids: DataFrame, set_key: Sequence[str], experiment: str = "experiment"
) -> DataFrame:
    """(experiment, set key, attempt, batchid): the attempt to start for each set whose last one is to be repeated.

    The failed batch keeps its row; the new attempt gets the experiment's next free batch id. All
    ids are given out in one step.
    """
    last = lineage.groupBy(experiment, *set_key).agg(
        F.max("attempt").alias("_last"), F.max(F.when(F.col("retry"), F.col("attempt"))).alias("_retry")
    )
    waiting = last.where(F.col("_last") == F.col("_retry")).select(experiment, *set_key, (F.col("_last") + 1).alias("attempt"))
    ranked = index_rows(waiting, list(set_key), "_rank", within=[experiment])
    return ranked.join(next_ids, experiment).select(
        experiment, *set_key, "attempt", (F.col("next_id") + F.col("_rank")).alias("batchid")
    )
