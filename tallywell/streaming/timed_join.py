"""Two streams joined within a bound of event time, a state for many keys: a state row per input row takes longer than the join."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallywell.streaming.keyed import _as_text, _from_text

BUCKETS = 512
PAIRS, TOLD = 51_200, 50  # rows of the result that are put together, and sent, at once
FIRST, LAST = "1700-01-01", "2262-01-01"
_MOST_COLUMNS = 62  # a bit each for nulls

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType)
_TEXT = (T.DecimalType, T.BinaryType, T.TimestampNTZType)


def _plain(kind: T.DataType) -> str | None:
    """The type that a column travels in; None if there is none that keeps its values."""
    if isinstance(kind, _WHOLE):
        return "bigint"
    if isinstance(kind, T.FloatType | T.DoubleType):
        return "double"
    return "string" if isinstance(kind, _TEXT) or kind == T.StringType() else None


def _packed(name: str, kind: T.DataType) -> Column:
    """A column as its plain type and without nulls, which pandas would make floats of integers for."""
    value, plain = F.col(name), _plain(kind)
    if plain == "string":
        return F.coalesce(_as_text(name, kind), F.lit(""))
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return F.coalesce(value.cast(plain), F.lit(0).cast(plain))


def _unpacked(name: str, kind: T.DataType) -> Column:
    value, plain = F.col(name), _plain(kind)
    if plain == "string":
        return _from_text(name, kind)
    if plain == "double":  # pandas has no null beside NaN
        return F.coalesce(value, F.lit(float("nan"))).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(value.cast("int"))
    return F.timestamp_micros(value) if isinstance(kind, T.TimestampType) else value.cast(kind)


def _nulls(names: Sequence[str]) -> Column:
    bits = F.lit(0).cast("bigint")
    for i, name in enumerate(names):
        bits = bits.bitwiseOR(F.when(F.col(name).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def _late(rows: DataFrame, time: str) -> Column:
    """The time that late rows are told by, within what pandas can hold: before it all are late, after it none."""
    held = F.when(F.col(time) < F.lit(LAST).cast("timestamp"), F.greatest(F.col(time), F.lit(FIRST).cast("timestamp")))
    return held.alias("time", metadata=rows.schema[time].metadata)


class _Side(NamedTuple):
    """One stream: its key and other columns, and the names under which those travel."""

    keys: list[str]
    others: list[str]
    kinds: dict[str, T.DataType]
    prefix: str

    @property
    def sent(self) -> dict[str, str]:
        return {name: f"{self.prefix}{i}" for i, name in enumerate(self.others)}

    def told(self, nulls: str, wanted: Sequence[str], there: Column) -> list[Column]:
        """The columns ``wanted`` as they were; null where the bit in ``nulls`` says so, and if the row isn't ``there``."""
        own = self.sent | {k: f"k{i}" for i, k in enumerate(self.keys)}
        bit = {name: F.col(nulls).bitwiseAND(F.lit(1 << i)) == 0 for i, name in enumerate([*self.keys, *self.others])}
        return [F.when(there & bit[c], _unpacked(own[c], self.kinds[c])).alias(c) for c in wanted]


def can_pack(images: DataFrame, coordinates: DataFrame, on: Sequence[str]) -> bool:
    """Whether all columns have a plain type, and the keys the same one on both sides that tells equal ones by its value."""
    kinds = [{f.name: f.dataType for f in frame.schema.fields} for frame in (images, coordinates)]
    if any(len(k) > _MOST_COLUMNS or None in map(_plain, k.values()) for k in kinds):
        return False
    pairs = [[k[c] for k in kinds] for c in on]
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return all(
        _plain(a) != "double" and (a == b or isinstance(a, whole) and isinstance(b, whole)) for a, b in pairs
    )


def _codes(keys: Sequence[str], tables: Sequence[pa.Table]) -> list[np.ndarray]:
    """A number per row that is the same for the same keys, in all tables."""
    code = None
    for key in keys:
        column = pa.chunked_array([chunk for t in tables for chunk in t[key].chunks], tables[0].schema.field(key).type)
        own = column.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if code is not None:
            own = np.unique(code * (own.max(initial=0) + 1) + own, return_inverse=True)[1].astype(np.int64)
        code = own
    return np.split(code, np.cumsum([t.num_rows for t in tables])[:-1])


def _pairs(
    image_code: np.ndarray, image_time: np.ndarray, code: np.ndarray, time: np.ndarray, bound: int
) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Positions of the images that have coordinates, and all pairs of positions, some at a time.

    Images whose code is negative have none. Coordinates are sorted by code and rank of time, so those of an image are
    one run, and no pair is looked at that isn't told.
    """
    there = np.zeros(max(image_code.max(initial=-1), code.max(initial=-1)) + 2, dtype=bool)
    there[code] = True  # the last place is that of negative codes
    some = np.flatnonzero(there[image_code])
    image_code, image_time = image_code[some], image_time[some]
    times, rank = np.unique(time, return_inverse=True)
    width = len(times) + 1
    place = code * width + rank
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.searchsorted(place, image_code * width + np.searchsorted(times, image_time - bound, "left"), "left")
    end = np.searchsorted(place, image_code * width + np.searchsorted(times, image_time + bound, "right"), "left")
    met = end > first
    some, first, count = some[met], first[met], (end - first)[met]

    def told() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        last = np.cumsum(count)
        for at in range(0, int(last[-1]) if len(some) else 0, PAIRS):
            nth = np.arange(at, min(at + PAIRS, int(last[-1])))
            i = np.searchsorted(last, nth, "right")
            yield some[i], order[first[i] + nth - (last[i] - count[i])]

    return some, told()


def _read(held: bytes | None, schema: pa.Schema) -> pa.Table:
    return pa.ipc.open_stream(held, options=pa.ipc.IpcReadOptions(use_threads=False)).read_all() if held else schema.empty_table()


def _written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


_ARROW = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}
IMAGE, KEYLESS, COORDINATE = 0, 1, 2


def join_within(
    images: DataFrame, coordinates: DataFrame, on: Sequence[str], seen: str, recorded: str, minutes: int, buckets: int = BUCKETS
) -> DataFrame:
    """Stream of the columns of ``images``, ``recorded`` and the others of ``coordinates``; see ``totals.join_coordinates``.

    Both streams have a watermark on their time. Rows are dealt by the hash of their keys over ``buckets`` states, those of
    images without a key by their time. A state is what is held of its rows as compressed columns; a call joins an epoch's
    rows of a state at once, and holds only those in memory.
    """
    on, bound = list(on), minutes * 60_000_000
    kinds = [{f.name: f.dataType for f in frame.schema.fields} for frame in (images, coordinates)]
    left = _Side(on, [c for c in images.columns if c not in on and c != seen], kinds[0], "i")
    right = _Side(on, [c for c in coordinates.columns if c not in on and c != recorded], kinds[1], "c")
    names = [f"k{i}" for i in range(len(on))]
    plain = {n: _plain(kinds[0][c]) for n, c in zip(names, on)}
    own = [{new: _plain(side.kinds[old]) for old, new in side.sent.items()} for side in (left, right)]

    def dealt(frame: DataFrame, side: _Side, time: str, kind: Column) -> DataFrame:
        packed = [_packed(c, side.kinds[c]).alias(n) for n, c in zip(names, on)]
        mine = {new: _packed(old, side.kinds[old]) for old, new in side.sent.items()}
        rest = [mine.get(n, F.lit("" if p == "string" else 0).cast(p)).alias(n) for n, p in (own[0] | own[1]).items()]
        rows = frame.select(
            _late(frame, time), F.unix_micros(time).alias("us"), kind.cast("bigint").alias("kind"), _nulls([*on, *side.others]).alias("nulls"),
            *packed, *rest,
        )
        spread = F.when(F.col("kind") == KEYLESS, F.xxhash64("us")).otherwise(F.xxhash64(*names))
        return rows.withColumn("bucket", F.pmod(spread, F.lit(buckets)).cast("int"))

    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    given = dealt(images, left, seen, F.when(missing, KEYLESS).otherwise(IMAGE)).union(
        dealt(coordinates, right, recorded, F.lit(COORDINATE))
    )

    stored = {"us": "bigint", "nulls": "bigint", **plain}
    schemas = [
        pa.schema([(n, _ARROW[p]) for n, p in {**some, **stored, **mine}.items()])
        for some, mine in (({"kind": "bigint", "met": "bigint"}, own[0]), ({}, own[1]))
    ]
    told = {**stored, **own[0], "met": "bigint", "at": "bigint", "lacks": "bigint", **own[1]}
    result = pa.schema([(n, _ARROW[p]) for n, p in told.items()])

    def sent(image: pa.Table, other: pa.Table | None) -> pd.DataFrame:
        """Rows of the result as bytes, ``TOLD`` at a time: Spark sends a row of state beside each row, empty or not."""
        n = image.num_rows
        there = {"met": pa.array(np.full(n, other is not None), pa.int64())}
        if other is None:
            there |= {c: pa.repeat(pa.scalar("" if told[c] == "string" else 0, _ARROW[told[c]]), n) for c in ("at", "lacks", *own[1])}
        else:
            there |= {"at": other["us"], "lacks": other["nulls"]} | {c: other[c] for c in own[1]}
        rows = pa.table([there.get(c, image[c] if c in image.column_names else None) for c in told], schema=result)
        return pd.DataFrame({"rows": [b.serialize().to_pybytes() for b in rows.combine_chunks().to_batches(max_chunksize=TOLD)]})

    def call(_: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [_read(kept, schema) for kept, schema in zip(state.get if state.exists else (None, None), schemas)]
        came = [] if state.hasTimedOut else list(frames)
        tables = held
        if came:
            kind = np.concatenate([frame["kind"].to_numpy() for frame in came])
            tables = []
            for kept, side, schema in zip(held, (kind != COORDINATE, kind == COORDINATE), schemas):
                new = {n: np.concatenate([f[n].to_numpy() for f in came])[side] for n in schema.names if n != "met"}
                new["met"] = np.zeros(side.sum(), dtype=np.int64)
                own_rows = pa.table([pa.array(new[n], schema.field(n).type) for n in schema.names], schema=schema)
                tables.append(pa.concat_tables([kept, own_rows]).combine_chunks())
        image, other = tables
        met = image["met"].to_numpy().copy()
        if came and image.num_rows and other.num_rows:
            code, code_other = _codes(names, tables)
            code = np.where(image["kind"].to_numpy() == KEYLESS, -1, code)
            times, times_other = image["us"].to_numpy(), other["us"].to_numpy()
            old, old_other = (kept.num_rows for kept in held)
            # Held images meet what is new, new images meet all.
            for start, end, part in ((0, old, slice(old_other, None)), (old, None, slice(0, None))):
                own_some, pairs = _pairs(code[start:end], times[start:end], code_other[part], times_other[part], bound)
                met[own_some + start] = 1
                for i, j in pairs:
                    yield sent(image.take(pa.array(i + start)), other.take(pa.array(j + part.start)))
        image = image.set_column(image.schema.get_field_index("met"), "met", pa.array(met))
        now = state.getCurrentWatermarkMs()
        due = [(t["us"].to_numpy() + bound) // 1000 for t in (image, other)]
        gone = image.filter(pa.array((due[0] < now) & (met == 0)))
        for at in range(0, gone.num_rows, PAIRS):
            yield sent(gone.slice(at, PAIRS), None)
        kept = [t.filter(pa.array(d >= now)) for t, d in zip((image, other), due)]
        if any(t.num_rows for t in kept):
            state.update(tuple(map(_written, kept)))
            state.setTimeoutTimestamp(max(now, int(min(d[d >= now].min(initial=np.iinfo(np.int64).max) for d in due))))
        elif state.exists:
            state.remove()

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS // TOLD):
                some = [pa.ipc.read_record_batch(rows.as_buffer(), result) for rows in batch.column(0).slice(at, PAIRS // TOLD)]
                yield from pa.Table.from_batches(some).combine_chunks().to_batches()

    joined = given.groupBy("bucket").applyInPandasWithState(
        call, "rows binary", "images binary, coordinates binary", "append", GroupStateTimeout.EventTimeTimeout
    )
    rows = joined.mapInArrow(unpack, ", ".join(f"{n} {p}" for n, p in told.items()))
    there = F.col("met") == 1
    mine = left.told("nulls", [c for c in images.columns if c != seen], F.lit(True))
    mine.insert(images.columns.index(seen), F.timestamp_micros("us").alias(seen))
    return rows.select(*mine, F.when(there, F.timestamp_micros("at")).alias(recorded), *right.told("lacks", right.others, there))
