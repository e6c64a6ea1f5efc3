"""Shards of near equal bytes for indivisible groups, by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.operators.indexing import index_rows
from tallywell.storage import materialize

#: Groups that one task differences; the number of tasks follows from it.
GROUPS_PER_TASK = 100_000
#: Tasks at least, so that small tables are spread too.
LEAST_TASKS = 64


def text_key(text: Column) -> Column:
    """128 bits of the text; null counts as the empty text."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit(1), whole).alias("b"))


def difference(parts: list[list[tuple[int, object]]], shards: int) -> list[tuple[int, object]]:
    """Combine partial partitions until one is left.

    A partial partition is a list of ``shards`` (load, content) pairs. The two with the largest
    spread are combined again and again, the heaviest shard of one with the lightest of the other.
    Contents are pairs (nested), ``None`` is empty. Ties go to the earlier part.
    """
    heap = []
    for serial, part in enumerate(parts):
        part = sorted(part, key=lambda x: -x[0])
        heap.append((part[-1][0] - part[0][0], serial, part))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        both = [
            (a + b, (x, y) if x is not None and y is not None else x if y is None else y)
            for (a, x), (b, y) in zip(one, reversed(two))
        ]
        both.sort(key=lambda x: -x[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], serial, both))
        serial += 1
    return heap[0][2] if heap else [(0, None)] * shards


def leaves(content: object) -> Iterator[object]:
    """The contents that were combined, without recursion."""
    todo = [content]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo.extend(x)
        elif x is not None:
            yield x


def shard_groups(groups: DataFrame, shards: int, groups_per_task: int = GROUPS_PER_TASK) -> DataFrame:
    """Give each row of ``groups`` (key, bytes) a ``shard`` below ``shards``.

    ``key`` is unique. Groups are dealt to tasks by the hash of the key; each task differences its
    groups to one partial partition of ``shards`` loads. Then those, one row per task, are
    differenced in the same way. The second step takes ``shards`` numbers for every
    ``groups_per_task`` groups, never the groups.
    """
    fixed = materialize(groups.select("key", "bytes"), "shard-groups")
    tasks = max(LEAST_TASKS, -(-fixed.count() // groups_per_task))
    dealt = fixed.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int"))

    def within(task: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "a", "b"], ignore_index=True)
        parts = [[(int(n), i)] + [(0, None)] * (shards - 1) for i, n in enumerate(rows["bytes"])]
        label, load = [0] * len(rows), [0] * len(rows)
        for j, (total, content) in enumerate(difference(parts, shards)):
            for i in leaves(content):
                label[i], load[i] = j, total
        return pd.DataFrame({"a": rows["a"], "b": rows["b"], "task": task[0], "label": label, "load": load})

    flat = dealt.select("key.a", "key.b", "bytes", "task")
    labelled = materialize(
        flat.groupBy("task").applyInPandas(within, "a long, b long, task int, label int, load long"), "shard-labels"
    )
    partial = labelled.groupBy("task", "label").agg(F.max("load").alias("load"))

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for task, own in rows.sort_values(["task", "label"]).groupby("task"):
            loads = [(int(n), (int(task), int(j))) for j, n in zip(own["label"], own["load"])]
            parts.append([(n, [x]) for n, x in loads] + [(0, None)] * (shards - len(loads)))
        found = [
            (x[0][0], x[0][1], j) for j, (_, content) in enumerate(difference(parts, shards)) for x in leaves(content)
        ]
        return pd.DataFrame(found, columns=["task", "label", "shard"])

    combined = partial.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(across, "task int, label int, shard int")
    return labelled.join(combined, ["task", "label"]).select(
        F.struct("a", "b").alias("key"), "shard"
    )


def shard_documents(
    docs: DataFrame, shards: int = 8, text: str = "text", order_by: str = "doc_id", keep: list[str] | None = None
) -> DataFrame:
    """Add ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` to ``docs``.

    Law ``bytes``: the sizes of the shards are near equal; rows with equal texts are one indivisible
    group. ``size``: UTF-8 bytes plus 1, so null and empty texts (one group) count 1. ``slot``:
    gapless from 0 within the shard, in ascending order (null first; ties by text).
    ``grown_shard`` is null under this law. Columns of ``docs`` of these names are replaced; of the
    others those in ``keep`` stay (all by default; leave out the text to move less). No rows give no rows. One group of a third of all bytes fills a shard of its
    own; the rest stays balanced.
    """
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    others = [c for c in (docs.columns if keep is None else keep) if c not in added]
    whole = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        *others,
        F.col(order_by).alias("_order"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"),
        text_key(F.col(text)).alias("_key"),
    )
    groups = sized.groupBy(F.col("_key").alias("key")).agg(F.sum("size").alias("bytes"))
    placed = sized.join(shard_groups(groups, shards).withColumnRenamed("key", "_key"), "_key")
    ranked = index_rows(
        placed.withColumn("law", F.lit("bytes")), [F.col("_order").asc_nulls_first(), F.col("_key")], "slot", ["shard"]
    )
    return ranked.select(*others, *added[:4], "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
