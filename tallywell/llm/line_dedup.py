"""Line deduplication that can be undone: sharded cuckoo filters over exact reference counts.

The index of a corpus has three tables in the shared folder:

- ``postings`` (doc_id, a, b): the keys that each document refers to, once each;
- ``counts`` (shard, a, b, refs, first, last): per key the references, the smallest and the largest document;
- ``filters`` (shard, cells): per shard a cuckoo filter of the keys that two documents or more refer to.

A key is a 128-bit hash (a, b) of the normal form of a line. Inserting documents adds postings and merges counts;
deleting takes both back and removes keys from the filters that are no longer shared. A document looks its lines
up in the filters first: most lines are in one document only, and need no lookup in ``counts``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm.words import WHITE, mix
from tallywell.storage import materialize

MIN_CHARS = 10
#: Shared keys per filter, and the sum of filter bytes up to which each task gets all filters. Beyond it the
#: lookup goes to ``counts`` alone, with the same result.
KEYS_PER_SHARD = 1 << 16
FILTER_BYTES = 64 << 20
_SLOTS = 4
_KICKS = 500


def line_key(line: bytes) -> tuple[int, int] | None:
    """Key of a line, None if its normal form has under ``MIN_CHARS`` code points."""
    normal = line.strip(WHITE).lower()  # bytes.lower() touches A-Z only
    if len(normal) < MIN_CHARS or (len(normal) < 4 * MIN_CHARS and sum(b & 0xC0 != 0x80 for b in normal) < MIN_CHARS):
        return None
    digest = xxhash.xxh3_128_intdigest(normal)
    return _signed(digest >> 64), _signed(digest & (1 << 64) - 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# --- cuckoo filter: rows of 4 cells of 16 bits, 0 is empty ----------------------------------------------------


def _places(keys: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and both rows of each key (uint64); each row follows from the other and the fingerprint."""
    h = mix(keys)
    mark = ((h >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
    one = (h & np.uint64(rows - 1)).astype(np.int64)
    return mark, one, _other(one, mark, rows)


def _other(row: np.ndarray, mark: np.ndarray, rows: int) -> np.ndarray:
    return row ^ (mix(mark.astype(np.uint64)) & np.uint64(rows - 1)).astype(np.int64)


def empty_cells(n_keys: int) -> np.ndarray:
    """Cells for ``n_keys`` at a load of 80 % or less."""
    rows = 1 << max(2, int(np.ceil(np.log2(max(n_keys, 1) / _SLOTS / 0.8))))
    return np.zeros((rows, _SLOTS), np.uint16)


def insert_keys(cells: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Put ``keys`` in; returns the cells, of twice the rows if they no longer fit (then all keys must be given)."""
    rows = len(cells)
    mark, here, there = _places(keys, rows)
    for kick in range(_KICKS):
        if not len(mark):
            return cells
        # One key per row and pass: the first that asks for it.
        _, first = np.unique(here, return_index=True)
        chosen = np.zeros(len(mark), bool)
        chosen[first] = True
        row, new = here[first], mark[first]
        free = cells[row] == 0
        slot = np.where(free.any(1), free.argmax(1), (new.astype(np.int64) + kick) % _SLOTS)
        out = cells[row, slot]
        cells[row, slot] = new
        kicked = out > 0
        moved = _other(row[kicked], out[kicked], rows)
        waiting = ~chosen
        # A key that must wait tries its other row next.
        mark = np.concatenate([mark[waiting], out[kicked]])
        here, there = (
            np.concatenate([there[waiting], moved]),
            np.concatenate([here[waiting], row[kicked]]),
        )
    raise OverflowError("cuckoo filter is full")


def build_filter(keys: np.ndarray) -> np.ndarray:
    """Cells with all ``keys``; the number of rows doubles until they fit."""
    size = len(keys)
    while True:
        try:
            return insert_keys(empty_cells(size), keys)
        except OverflowError:
            size *= 2


def remove_keys(cells: np.ndarray, keys: np.ndarray) -> None:
    """Take out one fingerprint for each key; the keys must have been inserted."""
    for mark, one, two in zip(*_places(keys, len(cells))):
        for row in (one, two):
            slots = np.flatnonzero(cells[row] == mark)
            if len(slots):
                cells[row, slots[0]] = 0
                break
        else:
            raise KeyError("key is not in the filter")


def has_keys(cells: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may have been inserted (no false negatives)."""
    mark, one, two = _places(keys, len(cells))
    return (cells[one] == mark[:, None]).any(1) | (cells[two] == mark[:, None]).any(1)


def shard_of(a: np.ndarray, shards: int) -> np.ndarray:
    return ((a.view(np.uint64) >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)


def _shard_column(shards: int):
    return F.pmod(F.shiftrightunsigned("a", 32), F.lit(shards)).cast("int")


# --- the index -----------------------------------------------------------------------------------------------


@dataclass
class LineIndex:
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


def _postings(docs: DataFrame) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {line_key(line) for line in (text or b"").split(b"\n")} - {None}
                ids.extend([doc_id] * len(own))
                keys.extend(own)
            a, b = zip(*keys) if keys else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["doc_id", "a", "b"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(of, "doc_id long, a long, b long")


def _count(postings: DataFrame) -> DataFrame:
    """Null ids are one document, the last one. Rows of one id are one document: ``first < last`` means shared."""
    doc = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    return postings.groupBy("a", "b").agg(F.count("*").alias("refs"), F.min(doc).alias("first"), F.max(doc).alias("last"))


def _filters(counts: DataFrame, shards: int) -> DataFrame:
    def build(shard: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cells = build_filter(rows["b"].to_numpy().view(np.uint64))
        return pd.DataFrame({"shard": [shard[0]], "cells": [cells.tobytes()]})

    shared = counts.where("first < last").select(_shard_column(shards).alias("shard"), "b")
    return shared.groupBy("shard").applyInPandas(build, "shard int, cells binary")


def build_index(docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> LineIndex:
    """Insert ``docs`` (doc_id, text) into an empty index."""
    postings = materialize(_postings(docs), "line-postings")
    return _index(postings, materialize(_count(postings), "line-counts"), keys_per_shard)


def _index(postings: DataFrame, counts: DataFrame, keys_per_shard: int) -> LineIndex:
    shared = counts.where("first < last").count()
    shards = max(1, -(-shared // keys_per_shard))
    return LineIndex(postings, counts, materialize(_filters(counts, shards), "line-filters"), shards)


def insert_documents(index: LineIndex, docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> LineIndex:
    """The index with ``docs`` as well. Only the new documents are read; their counts are merged into the old ones."""
    new = materialize(_postings(docs), "line-postings")
    both = index.counts.unionByName(_count(new))
    counts = both.groupBy("a", "b").agg(
        F.sum("refs").alias("refs"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    return _index(index.postings.unionByName(new), materialize(counts, "line-counts"), keys_per_shard)


def delete_documents(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents in ``ids`` (doc_id). Their texts aren't needed.

    Only keys of deleted documents are counted again, from the postings that stay. Keys that are no longer
    shared leave their cuckoo filter; the other cells stay as they are.
    """
    gone = ids.select(F.col("doc_id").alias("_gone")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_gone"))
    postings = materialize(index.postings.join(gone, same, "left_anti"), "line-postings")
    touched = index.postings.join(gone, same, "left_semi").select("a", "b").distinct()
    again = _count(postings.join(touched, ["a", "b"], "left_semi"))
    untouched = index.counts.join(touched, ["a", "b"], "left_anti")
    counts = materialize(untouched.unionByName(again), "line-counts")

    was = index.counts.where("first < last").join(touched, ["a", "b"], "left_semi")
    unshared = was.join(counts.where("first < last").select("a", "b"), ["a", "b"], "left_anti")

    def remove(shard: tuple, filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        for i, raw in enumerate(filters["cells"]):
            cells = np.frombuffer(raw, np.uint16).reshape(-1, _SLOTS).copy()
            remove_keys(cells, keys["b"].to_numpy().view(np.uint64))
            filters.loc[filters.index[i], "cells"] = cells.tobytes()
        return filters[["shard", "cells"]]

    keys = unshared.select(_shard_column(index.shards).alias("shard"), "b")
    filters = index.filters.groupBy("shard").cogroup(keys.groupBy("shard")).applyInPandas(remove, "shard int, cells binary")
    return LineIndex(postings, counts, materialize(filters, "line-filters"), index.shards)


def _load_filters(spark: SparkSession, index: LineIndex, limit: int):
    """All filters for the tasks if they are within ``limit`` bytes, else None."""
    total = index.filters.agg(F.sum(F.octet_length("cells"))).first()[0] or 0
    if total > limit:
        return None
    rows = index.filters.collect()
    return spark.sparkContext.broadcast({r["shard"]: bytes(r["cells"]) for r in rows})


def dedup_lines(
    docs: DataFrame, index: LineIndex | None = None, filter_bytes: int = FILTER_BYTES, keep_text: bool = False
) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 and, if asked for, ``kept`` (the text that stays).

    A text is split at ``\\n``; null or empty is one empty line. A line's key is the line stripped of
    ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; keys under 10 code points are ignored. A key that two documents
    or more hold loses all its lines except in the document of the smallest id. Null ids are one document, the
    largest; rows that repeat an id are one document too. Other columns of ``docs`` are left out; no rows give none.

    First pass: look all keys up in the filters, keep the text only where one may be shared. Hits are checked
    in ``counts``, then joined to their documents.
    """
    spark = docs.sparkSession
    index = index or build_index(docs)
    filters = _load_filters(spark, index, filter_bytes)
    shards = index.shards

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = None
        if filters is not None:
            cells = {k: np.frombuffer(v, np.uint16).reshape(-1, _SLOTS) for k, v in filters.value.items()}
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or b"" for t in batch.column(1).to_pylist()]
            owner, a, b = [], [], []
            for i, text in enumerate(texts):
                own = {line_key(line) for line in text.split(b"\n")} - {None}
                owner.extend([i] * len(own))
                a.extend(k[0] for k in own)
                b.extend(k[1] for k in own)
            owner, a, b = (np.array(x, np.int64) for x in (owner, a, b))
            hit = np.ones(len(a), bool)
            if cells is not None:
                hit[:] = False
                shard = shard_of(a, shards)
                for s, table in cells.items():
                    own = np.flatnonzero(shard == s)
                    hit[own] = has_keys(table, b[own].view(np.uint64))
            hits = [[] for _ in texts]
            for i, x, y in zip(owner[hit].tolist(), a[hit].tolist(), b[hit].tolist()):
                hits[i].append({"a": x, "b": y})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([t if h or keep_text else None for t, h in zip(texts, hits)], pa.binary()),
                    pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()),
                    pa.array([None if h else hashlib.sha256(t).hexdigest() for t, h in zip(texts, hits)], pa.string()),
                    pa.array(hits, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                ],
                ["doc_id", "text", "n_lines", "sha", "hits"],
            )

    seen = materialize(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
            look_up, "doc_id long, text binary, n_lines long, sha string, hits array<struct<a:long,b:long>>"
        ),
        "line-hits",
    )
    shared = index.counts.where("first < last").select("a", "b", "first")
    doc = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    links = seen.where(F.size("hits") > 0).select(doc.alias("_doc"), F.explode("hits").alias("h")).distinct()
    lost = links.select("_doc", "h.a", "h.b").join(shared, ["a", "b"]).where("_doc > first")
    drops = lost.groupBy("_doc").agg(F.collect_list(F.struct("a", "b")).alias("drops"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {name: batch.column(name).to_pylist() for name in ("doc_id", "text", "n_lines", "sha", "drops")}
            dropped, sha, kept = [], [], []
            for text, n, whole, drop in zip(rows["text"], rows["n_lines"], rows["sha"], rows["drops"]):
                if drop:
                    gone = {(d["a"], d["b"]) for d in drop}
                    lines = [line for line in text.split(b"\n") if line_key(line) not in gone]
                    text = b"\n".join(lines)
                    dropped.append(n - len(lines))
                else:
                    dropped.append(0)
                sha.append(whole if whole and not drop else hashlib.sha256(text).hexdigest())
                kept.append(text if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["doc_id"], pa.int64()),
                    pa.array(rows["n_lines"], pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"],
            )

    light = seen.where(F.size("hits") == 0).select("doc_id", "text", "n_lines", "sha", F.lit(None).alias("drops"))
    heavy = (
        seen.where(F.size("hits") > 0)
        .withColumn("_doc", doc)
        .join(drops, "_doc", "left")
        .select("doc_id", "text", "n_lines", "sha", "drops")
    )
    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept binary"
    out = light.withColumn("drops", F.col("drops").cast("array<struct<a:long,b:long>>")).unionByName(heavy)
    result = out.mapInArrow(cut, schema)
    text = [F.col("kept").cast("string").alias("kept")] if keep_text else []
    return result.select("doc_id", "n_lines", "n_dropped", "kept_sha256", *text)
