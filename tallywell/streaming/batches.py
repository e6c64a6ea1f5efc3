"""Batch registration, status and completion from streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.streaming.feed import merge_repeats

# Batch states.
REGISTERED = "registered"
PROCESSING = "processing images"
UPLOADING = "uploading results to storage"
DONE = "done"
TERMINATED = "terminated"

BATCH_KEY = ("experiment", "batchid")


def new_requests(requests: DataFrame, time: str = "ts", keep_days: int = 7) -> DataFrame:
    """Stream of registration requests, each (experiment, batchid) once.

    Repeats within ``keep_days`` of event time are dropped; that also bounds the state.
    """
    merged = merge_repeats(requests.select(*BATCH_KEY, time), BATCH_KEY, time)
    return merged.withWatermark(time, f"{keep_days} days").dropDuplicatesWithinWatermark(list(BATCH_KEY))


def register_batches(requests: DataFrame, stored: DataFrame, initial: str = REGISTERED) -> tuple[DataFrame, DataFrame]:
    """(registered, conflicts) for requests against the stored batches.

    A new batch gives one registered row. A batch stored in the initial state is
    left alone; one stored in any other state is a conflict, with that state.
    """
    known = stored.select(*BATCH_KEY, F.col("status").alias("stored_status"))
    asked = requests.select(*BATCH_KEY).distinct().join(known, list(BATCH_KEY), "left")
    registered = asked.where(F.col("stored_status").isNull()).select(*BATCH_KEY, F.lit(initial).alias("status"))
    return registered, asked.where(F.col("stored_status") != initial)


def registration_outcomes(requests: DataFrame, stored: DataFrame, initial: str = REGISTERED) -> DataFrame:
    """(experiment, batchid, status, outcome) of requests, for batch and streaming frames without repeats.

    ``new``: not stored yet, registered now. ``conflict``: stored in a state other than the initial one. A batch
    stored in the initial state has no row.
    """
    known = stored.select(*BATCH_KEY, F.col("status").alias("stored_status"))
    asked = requests.select(*BATCH_KEY).join(known, list(BATCH_KEY), "left")
    is_new = F.col("stored_status").isNull()
    return asked.where(is_new | (F.col("stored_status") != initial)).select(
        *BATCH_KEY,
        F.coalesce("stored_status", F.lit(initial)).alias("status"),
        F.when(is_new, "new").otherwise("conflict").alias("outcome"),
    )


def status_marks(batches: DataFrame, status: str, exit_code: int | None = None) -> DataFrame:
    """Status events (see ``STATUS_EVENT``) that mark ``batches`` with ``status`` at the current time."""
    return batches.select(
        *BATCH_KEY, F.lit(status).alias("status"), F.lit(exit_code).cast("int").alias("exit_code"),
        F.current_timestamp().alias("ts"), F.lit(0).cast("bigint").alias("seq"),
    )


def fold_status(events: DataFrame, keys: Sequence[str] = BATCH_KEY) -> DataFrame:
    """Latest status, start and end of each batch from its status changes; for batch and streaming frames.

    Events at the same time are ordered by ``seq``. As with an update in place, the
    last processing mark is the start and the last final mark the end. A stream that never ends needs
    ``fold_status_by_period``, whose state is bounded.
    """
    folded = events.groupBy(*keys).agg(*_fold_columns())
    return folded.select(*keys, F.col("last_event.status").alias("status"), "start_time", "end_time")


def _fold_columns() -> list[Column]:
    status = F.col("status")
    final = status.isin(DONE, TERMINATED) | status.startswith("failed")
    return [
        F.max(F.struct("ts", "seq", "status")).alias("last_event"),
        F.max(F.when(status == PROCESSING, F.col("ts"))).alias("start_time"),
        F.max(F.when(final, F.col("ts"))).alias("end_time"),
    ]


def fold_status_by_period(events: DataFrame, keys: Sequence[str] = BATCH_KEY, keep_days: int = 60) -> DataFrame:
    """Stream of the fold of each batch within periods of ``keep_days``; see ``merge_periods``.

    The state of a period is dropped ``keep_days`` after its end, so it does not grow with the age of the stream. Events
    that come later than that are lost to the fold: see ``drain_late`` for a table of them.
    """
    timely = events.withWatermark("ts", f"{keep_days} days")
    period = F.window("ts", f"{keep_days} days")
    folded = timely.groupBy(*keys, period).agg(*_fold_columns())
    return folded.select(*keys, F.col("window.start").alias("period"), "last_event", "start_time", "end_time")


def merge_periods(updates: DataFrame, keys: Sequence[str] = BATCH_KEY) -> DataFrame:
    """The fold of each batch from what a stream of ``fold_status_by_period`` has written."""
    newest = latest(updates, [*keys, "period"])
    merged = newest.groupBy(*keys).agg(
        F.max("last_event").alias("last_event"), F.max("start_time").alias("start_time"), F.max("end_time").alias("end_time")
    )
    return merged.select(*keys, F.col("last_event.status").alias("status"), "start_time", "end_time")


def latest(updates: DataFrame, keys: Sequence[str] = BATCH_KEY, by: str = "epoch") -> DataFrame:
    """Newest version of each row written by an update stream."""
    others = [c for c in updates.columns if c not in (*keys, by)]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*others), by).alias("_r")).select(*keys, "_r.*")


def finished_experiments(
    processed: DataFrame, expected: DataFrame, experiment: str = "experiment", site: str = "site"
) -> DataFrame:
    """Streaming count of the different processed sites per experiment, next to the expected number.

    A site may be delivered again. The state of an experiment is its set of sites, so it is bounded by the
    experiment's grid.
    """
    counts = processed.groupBy(experiment).agg(F.size(F.collect_set(site)).cast("bigint").alias("n_sites"))
    return counts.join(expected, experiment)


def just_finished(batch: DataFrame) -> DataFrame:
    """Experiments with all their sites. Rows of the same experiment may come again: drain with ``once``."""
    return batch.where(F.col("n_sites") >= F.col("expected_sites"))
