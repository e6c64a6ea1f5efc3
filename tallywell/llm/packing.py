"""Best-fit packing with large-item matching.

Documents are encoded, closed by an end id and cut into pieces of at most ``capacity`` ids; only the last piece of a document
may be shorter. There are at most ``capacity`` different lengths, so packing is done on counts of lengths and its size
doesn't grow with the documents:

1. Pieces above a third of the capacity fit at most twice into a sequence. Greedy matching from the longest one pairs each
   with the longest that still fits beside it, which leaves the fewest sequences for them.
2. The other lengths, longest first, go to the least gap that holds them, and open a sequence where none does.

Sequences with the same content so far are one class, a run of sequence ids; a placement gives a run of pieces of one length
to a class. The rank of a piece among those of its length then tells its sequence and offset: ranks need no sort, as each
task numbers its pieces per length, and only the counts per task and length are summed up.
"""

from __future__ import annotations

import bisect
import functools
import os
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.token_store import KnownWords
from tallywell.llm.words import blocks, words_of
from tallywell.storage import materialize

CAPACITY, END_ID = 2048, 0

Encode = Callable[[list[bytes]], list[np.ndarray]]


# --- tokenizer -------------------------------------------------------------------------------------------------

_MARK = "\x01"


@functools.cache  # one per Python worker: its tasks share what has been learnt
def word_bpe(path: str, remember: int = 2_000_000) -> Encode:
    """Encoder for a vocabulary of the tokenizers library that drops white space: UTF-8 texts to arrays of ids.

    Such a vocabulary encodes each run without white space by itself, so each different one is given to the library once
    and its ids are remembered (``remember`` runs, then all are forgotten). Runs are encoded many at a time with a mark
    between them that is always one id; runs that hold the mark go alone. Strings of special tokens are ordinary text.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    wide = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def ids_of(text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, wide)

    mark = ids_of(_MARK)
    if len(mark) != 1 or ids_of(f"a {_MARK} \n{_MARK} b").tolist() != [*ids_of("a"), mark[0], mark[0], *ids_of("b")]:
        raise ValueError("the vocabulary does not keep words apart")
    known = KnownWords(wide)

    def learn(keys: np.ndarray, runs: list[str]) -> None:
        ids, sizes = [np.zeros(0, wide)], []
        plain = [i for i, run in enumerate(runs) if _MARK not in run]
        for k in range(0, len(plain), 5000):
            own = [runs[i] for i in plain[k : k + 5000]]
            found = ids_of(f" {_MARK} ".join(own))
            cuts = np.flatnonzero(found == mark[0])
            if len(cuts) != len(own) - 1:
                raise ValueError("the vocabulary does not keep words apart")
            ids.append(np.delete(found, cuts))
            sizes.extend(np.diff(cuts, prepend=-1, append=len(found)) - 1)
        other = [i for i, run in enumerate(runs) if _MARK in run]
        for i in other:
            ids.append(ids_of(runs[i]))
            sizes.append(len(ids[-1]))
        known.add(keys[np.array(plain + other, np.int64)], np.array(sizes, np.int64), np.concatenate(ids))

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        data = b"\n".join(texts) + b"\n"
        words = words_of(texts)
        unique, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        place, found = known.find(unique)
        if not found.all():
            if len(known.hash) + len(unique) > remember:
                known.__init__(wide)
                found[:] = False
            new = first[~found]
            spans = zip(words.start[new].tolist(), words.end[new].tolist())
            learn(unique[~found], [data[a:b].decode("utf-8", "replace") for a, b in spans])
            place, _ = known.find(unique)
        place = place[back]
        size, at = known.size[place], known.at[place]
        ends = np.cumsum(size)
        within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
        out = known.pool[np.repeat(at, size) + within]
        total = np.bincount(words.text, size, minlength=len(texts)).astype(np.int64)
        return np.split(out, np.cumsum(total)[:-1])

    return encode


# --- packing of counts -----------------------------------------------------------------------------------------


class Placement(NamedTuple):
    """``n`` pieces of ``length``, from rank ``first``, go to the sequences from ``sequence`` on: ``each`` to a sequence, the
    first of them at ``offset``."""

    length: int
    first: int
    n: int
    each: int
    sequence: int
    offset: int


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Placement], int]:
    """Placements of all pieces, given how many there are of each length, and the number of sequences."""
    out: list[Placement] = []
    placed = dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: classes (first sequence, number)
    open_gaps: list[int] = []
    total = 0

    def put(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        if n:
            out.append(Placement(length, placed[length], n, each, sequence, offset))
            placed[length] += n

    def leave(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                bisect.insort(open_gaps, gap)
                gaps[gap] = []
            gaps[gap].append((sequence, n))

    large = sorted(s for s, n in counts.items() if 3 * s > capacity and n)
    while large:
        s = large[-1]
        left = counts[s] - placed[s]
        k = bisect.bisect_right(large, capacity - s) - 1
        k -= k == len(large) - 1 and left < 2  # the last one of its length has no mate there
        mate = large[k] if k >= 0 else None
        pairs = 0
        if mate is not None:
            pairs = left // 2 if mate == s else min(left, counts[mate] - placed[mate])
        n = pairs or left
        put(s, n, 1, total, 0)
        if pairs:
            put(mate, n, 1, total, s)
        leave(capacity - s - (mate if pairs else 0), total, n)
        total += n
        large = [x for x in large if placed[x] < counts[x]] if pairs else large[:-1]

    for s in sorted((s for s, n in counts.items() if 3 * s <= capacity and n), reverse=True):
        left = counts[s]
        while left:
            k = bisect.bisect_left(open_gaps, s)
            if k < len(open_gaps):
                gap = open_gaps[k]
                sequence, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[k]
            else:
                gap, sequence = capacity, total
                n = -(-left // (capacity // s))
                total += n
            each = gap // s
            full = min(n, left // each)
            rest = min(left - full * each, each) if full < n else 0
            put(s, full * each, each, sequence, capacity - gap)
            put(s, rest, max(rest, 1), sequence + full, capacity - gap)
            leave(gap - each * s, sequence, full)
            if rest:
                leave(gap - rest * s, sequence + full, 1)
            leave(gap, sequence + full + (rest > 0), n - full - (rest > 0))
            left -= full * each + rest
    return out, total


# --- pieces and sequences --------------------------------------------------------------------------------------

_PIECE_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()),
])
_PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, part int, nth long"


def cut_documents(docs: DataFrame, encoder: Callable[[], Encode], capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text), with the task that made them (``part``) and their number among its pieces of that
    length (``nth``). ``ids`` are little-endian unsigned 32-bit integers."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64).tolist()
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            for a, b in blocks([len(t) for t in texts], 4 << 20):
                rows: list[tuple] = []
                for name, found in zip(names[a:b], encode(texts[a:b])):
                    ids = np.append(found, np.array([end_id], found.dtype)).astype("<u4").tobytes()
                    for piece, at in enumerate(range(0, len(ids) // 4, capacity)):
                        own = ids[4 * at : 4 * (at + capacity)]
                        n = len(own) // 4
                        rows.append((name, piece, at, n, own, zlib.crc32(own), part, seen[n]))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE_ARROW)], schema=_PIECE_ARROW)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(of, _PIECE_SCHEMA)


def pack_documents(docs: DataFrame, encoder: Callable[[], Encode], capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all ``docs`` with ids, sequence_id (from 0) and offset there.

    Null texts are empty: their one piece is the end id alone. Each row is a document, repeated rows and null doc_ids too;
    no rows give no pieces; other columns are ignored. Pieces of one length are interchangeable, so ties need no rule.
    """
    spark = docs.sparkSession
    pieces = materialize(cut_documents(docs, encoder, capacity, end_id), "pieces")
    counted = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity
    placements, _ = pack_counts(counts, capacity)
    plan = spark.createDataFrame(
        placements or [(0, 0, 0, 1, 0, 0)], "_length long, _first long, _n long, _each long, _sequence long, _offset long"
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("_rank", F.col("_before") + F.col("nth"))
    # Its size follows from the capacity alone: a length meets a class of sequences at most once.
    met = ranked.join(
        F.broadcast(plan),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_n")),
    )
    nth = F.col("_rank") - F.col("_first")
    return met.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids",
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_pieces, ids: the ids of each sequence in a row. A sequence holds at most ``capacity`` pieces."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("own"))
    joined = F.aggregate("own", F.lit(b""), lambda all_ids, x: F.concat(all_ids, x["ids"]))
    return held.select("sequence_id", F.size("own").alias("n_pieces"), joined.alias("ids"))
