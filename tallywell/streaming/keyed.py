"""State per key for many keys in one Python call: a call per key and epoch takes longer than the work on the key's rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BUCKETS = 256
DAY_MS = 24 * 3600 * 1000


def _as_text(name: str, kind: T.DataType) -> Column:
    """A key as text that ``_from_text`` turns back exactly; pandas would make floats of integers beside a null."""
    value = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    if isinstance(kind, T.FloatType | T.DoubleType):
        value = value + F.lit(0.0).cast(kind)  # -0.0 and 0.0 are one key
    return value.cast("string")


def _from_text(name: str, kind: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(value.cast("bigint"))
    return F.unbase64(value) if isinstance(kind, T.BinaryType) else value.cast(kind)


def fold_keys(
    rows: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    time: str,
    told: str,
    advance: Callable[[tuple | None, list[tuple], int], tuple[tuple, list[tuple]]],
    expire: Callable[[tuple, int], tuple[tuple | None, list[tuple]]],
    buckets: int = BUCKETS,
) -> DataFrame:
    """Stream of (keys, ``told``) that ``advance`` and ``expire`` give; ``rows`` has a watermark on ``time``.

    ``advance`` gets what is held of a key (None at first), some of its rows' ``values`` (never null) and the watermark in ms,
    ``expire`` what is held of a key whose time has come. Both return what to hold from now on and the rows to tell. What is
    held is a tuple that starts with the key's due time in ms, which must lie after the watermark; a key that has rows
    is not expired before its rows are taken. Keys are of atomic types; they share ``buckets`` states, by hash.
    """
    kinds = [rows.schema[k].dataType for k in keys]
    texts, given = [f"key{i}" for i in range(len(keys))], [f"value{i}" for i in range(len(values))]
    fields = T.StructType.fromDDL(told).fields
    output = T.StructType([*(T.StructField(t, T.StringType()) for t in texts), *fields])
    dealt = rows.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), F.col(time).alias("time"),
        *[_as_text(k, kind).alias(t) for k, kind, t in zip(keys, kinds, texts)],
        *[F.col(v).alias(g) for v, g in zip(values, given)],
    )

    def call(_: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pickle.loads(state.get[0]) if state.exists else {}
        now, out = state.getCurrentWatermarkMs(), []
        if not state.hasTimedOut:
            for frame in frames:
                found: dict[tuple, list[tuple]] = {}
                for key, value in zip(zip(*(frame[c].tolist() for c in texts)), zip(*(frame[c].tolist() for c in given))):
                    found.setdefault(key, []).append(value)
                for key, some in found.items():
                    held[key], new = advance(held.get(key), some, now)
                    out += [(*key, *row) for row in new]
        for key in [key for key, kept in held.items() if kept[0] < now]:
            kept, new = expire(held[key], now)
            out += [(*key, *row) for row in new]
            if kept is None:
                del held[key]
            else:
                held[key] = kept
        if held:
            state.update((pickle.dumps(held, pickle.HIGHEST_PROTOCOL),))
            state.setTimeoutTimestamp(max(now, min(kept[0] for kept in held.values())))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=output.names)

    folded = dealt.groupBy("bucket").applyInPandasWithState(call, output, "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return folded.select(*[_from_text(t, kind).alias(k) for k, kind, t in zip(keys, kinds, texts)], *[f.name for f in fields])


def merged_bits(
    images: DataFrame, keys: Sequence[str], channel: str, expected: Sequence[str], time: str, keep_days: int
) -> DataFrame:
    """(keys, bits, at, ms) with a watermark on ``at``: the expected channels of images, a bit each, and their last time.

    Other channels are ignored; ``ms`` is 0 without a time. Images of a set are merged in each Arrow batch before the shuffle, so a hot
    set does not send all its rows to one task.
    """
    bit = F.lit(0).cast("bigint")
    for i, name in enumerate(expected):
        bit = F.when(F.col(channel) == name, F.lit(1 << i).cast("bigint")).otherwise(bit)
    kinds = [images.schema[k].dataType for k in keys]
    texts = [f"key{i}" for i in range(len(keys))]
    seen = images.select(
        *[_as_text(k, kind).alias(t) for k, kind, t in zip(keys, kinds, texts)], bit.alias("bits"), F.col(time).cast("timestamp").alias("at")
    ).where("bits > 0")

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            single = batch.groupby([*texts, "bits"], as_index=False, dropna=False, sort=False)["at"].max()
            # Each bit is there once now, so adding them up is their union.
            yield single.groupby(texts, as_index=False, dropna=False, sort=False).agg({"bits": "sum", "at": "max"})

    combined = seen.mapInPandas(combine, seen.schema).withWatermark("at", f"{keep_days} days")
    own = [_from_text(t, kind).alias(k) for k, kind, t in zip(keys, kinds, texts)]
    return combined.select(*own, "bits", "at", F.coalesce(F.unix_millis("at"), F.lit(0)).alias("ms"))
