"""Image sets that have become complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallywell.streaming.keyed import DAY_MS, fold_keys, merged_bits


def complete_sets(
    images: DataFrame, keys: Sequence[str], channel: str, expected: Sequence[str], time: str, keep_days: int = 7
) -> DataFrame:
    """Emit each set once, when an image of every expected channel has arrived.

    State per set is one bit per channel and whether it was emitted. It is dropped
    ``keep_days`` of event time after the set's last image, which is also how late
    an image may come. Repeated images are merged per Arrow batch before the
    shuffle, so a hot set does not send all its rows to one task.
    """
    full, keep_ms = (1 << len(expected)) - 1, keep_days * DAY_MS

    def advance(held: tuple | None, rows: list[tuple], now: int) -> tuple[tuple, list[tuple]]:
        _, mask, emitted, last = held or (0, 0, False, 0)
        for bits, ms in rows:
            mask, last = mask | bits, max(last, ms)
        done = mask == full and not emitted
        return (max(last + keep_ms, now + 1), mask, emitted or done, last), [(len(expected),)] if done else []

    def expire(held: tuple, now: int) -> tuple[None, list[tuple]]:
        return None, []

    seen = merged_bits(images, keys, channel, expected, time, keep_days)
    return fold_keys(seen, keys, ["bits", "ms"], "at", "n_channels int", advance, expire)
