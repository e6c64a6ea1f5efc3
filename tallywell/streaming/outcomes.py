"""Image sets that become complete or time out, and attempts on a set that are tried again: state with due times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.streaming.keyed import DAY_MS, fold_keys, merged_bits

OUT_OF_MEMORY = 137


def set_outcomes(
    images: DataFrame, keys: Sequence[str], channel: str, expected: Sequence[str], time: str, keep_days: int = 7
) -> DataFrame:
    """Stream of (keys, channels, outcome, at): each set once, ``complete`` or ``incomplete``.

    A set is complete with an image of each expected channel, at its last one. A set without an image for ``keep_days`` of
    event time before that is incomplete: ``channels`` are those seen, ``at`` is when it timed out. State is one bit per
    channel and the time it is due, in RocksDB (see ``drain_to_table``); it goes ``keep_days`` after the set's last image, complete or
    not, which is also how late an image may come. An image that comes later than that is dropped by the watermark; one
    that is in time for a set that has gone starts it anew. Other channels, null ones too, are ignored; so are null times.
    """
    full, keep_ms = (1 << len(expected)) - 1, keep_days * DAY_MS

    def advance(held: tuple | None, rows: list[tuple], now: int) -> tuple[tuple, list[tuple]]:
        _, mask, last, emitted = held or (0, 0, 0, False)
        for bits, ms in rows:
            mask, last = mask | bits, max(last, ms)
        done = mask == full and not emitted
        # Never at or below the watermark: a set is due once.
        return (max(last + keep_ms, now + 1), mask, last, emitted or done), [(mask, "complete", last)] if done else []

    def expire(held: tuple, now: int) -> tuple[None, list[tuple]]:
        due, mask, _, emitted = held
        return None, [] if emitted else [(mask, "incomplete", due)]

    seen = merged_bits(images.where(F.col(time).isNotNull()), keys, channel, expected, time, keep_days)
    told = fold_keys(seen, keys, ["bits", "ms"], "at", "mask bigint, outcome string, ms bigint", advance, expire)
    channels = [F.when(F.col("mask").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(name)) for i, name in enumerate(expected)]
    return told.select(*keys, F.array_compact(F.array(*channels)).alias("channels"), "outcome", F.timestamp_millis("ms").alias("at"))


def retries(
    outcomes: DataFrame, keys: Sequence[str], time: str, most: int = 5, wait_minutes: int = 10, keep_days: int = 7
) -> DataFrame:
    """Stream of (keys, attempt, status, next_attempt, at) from outcomes (keys, attempt from 0, exit_code, time).

    An attempt that ran out of memory (exit code 137) asks for the next one: ``at`` is when that is due, ``wait_minutes``
    after the outcome, twice as long with each attempt. The row comes at that event time, or before the next attempt's
    outcome if that is faster. Any other exit code, and 137 in attempt ``most`` - 1, ends the set: ``next_attempt`` is null, ``at``
    the time of the outcome. Outcomes may come again and in any order: of each attempt the first to come counts, and one that is ahead
    of its turn waits. A set is remembered for ``keep_days`` after its last outcome; state is in RocksDB.
    """
    wait_ms, keep_ms = wait_minutes * 60_000, keep_days * DAY_MS

    def ask(attempt: int, at: int) -> tuple:
        return attempt - 1, f"failed.OOM({attempt - 1})", attempt, at

    def advance(held: tuple | None, rows: list[tuple], now: int) -> tuple[tuple, list[tuple]]:
        # ``awaited``: attempt whose outcome comes next; ``asked``: when it is due; ``told``: attempts asked for so far.
        _, awaited, told, asked, ended, last, early = held or (0, 0, 0, 0, False, 0, {})
        out = []
        for attempt, code, ms in rows:
            last = max(last, ms)
            # An outcome that is delivered again is left out: the first one of an attempt counts.
            if not ended and awaited <= attempt < most:
                early.setdefault(attempt, (code, ms))
        while not ended and awaited in early:
            code, ms = early.pop(awaited)
            if told < awaited:  # it ran before its time came
                out.append(ask(awaited, asked))
                told = awaited
            if code == OUT_OF_MEMORY and awaited + 1 < most:
                asked = ms + (wait_ms << awaited)
                awaited += 1
            else:
                status = "done" if code == 0 else f"failed.OOM({awaited})" if code == OUT_OF_MEMORY else f"failed.{code}"
                out.append((awaited, status, -1, ms))
                ended, early = True, {}
        waiting = not ended and told < awaited
        due = max(asked if waiting else last + keep_ms, now + 1)
        return (due, awaited, told, asked, ended, last, early), out

    def expire(held: tuple, now: int) -> tuple[tuple | None, list[tuple]]:
        _, awaited, told, asked, ended, last, early = held
        if ended or told >= awaited:
            return None, []
        due = max(last + keep_ms, asked + keep_ms, now + 1)
        return (due, awaited, awaited, asked, ended, last, early), [ask(awaited, asked)]

    ran = outcomes.select(
        *keys, F.col("attempt").cast("int").alias("attempt"), F.col("exit_code").cast("int").alias("exit_code"),
        F.col(time).cast("timestamp").alias("time__"),
    ).where("attempt IS NOT NULL AND exit_code IS NOT NULL AND time__ IS NOT NULL")
    timed = ran.withWatermark("time__", f"{keep_days} days").withColumn("ms__", F.unix_millis("time__"))
    told = fold_keys(
        timed, keys, ["attempt", "exit_code", "ms__"], "time__", "attempt int, status string, next int, ms bigint", advance, expire
    )
    following = F.when(F.col("next") >= 0, F.col("next")).alias("next_attempt")
    return told.select(*keys, "attempt", "status", following, F.timestamp_millis("ms").alias("at"))
