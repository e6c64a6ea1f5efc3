"""Ranked lexical search: branch and bound on FP-trees of documents.

Terms are the runs of digits, letters and non-ASCII characters, with A-Z in lower case. Two steps over all documents:

1. Each text is counted once and restricted to the terms that some item asks for. Up to ``BLOCK_DOCS`` documents make a
   block of postings, stored with the documents that hold each term. The block's counts add up to df, N and L.
2. Each block becomes a tree: a document's terms stand in ascending order of df, so documents that share rare terms share a
   path from the root. A node knows the greatest tf of each term below it and the least m, so no document below scores more
   than the node's bound. An item goes depth first to the child of the highest bound; a node whose bound is below the
   item's tenth score is left with all that is below it. Small subtrees are leaves, whose documents are scored exactly.

The best ten of a task's blocks leave the task, and a ranking per item merges them. Items go to the tasks in blocks of
``ITEM_BYTES`` of terms, one at a time: each block of items is a pass of its own over all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywell.storage import materialize

BEST = 10
#: Documents and postings of a block, documents of a leaf, bytes of terms of the items that one pass takes.
BLOCK_DOCS, BLOCK_POSTINGS, LEAF_DOCS, ITEM_BYTES = 8192, 1 << 20, 16, 8 << 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a text to bytes of its terms; all others become spaces.
_TERM_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())

_BLOCK_SCHEMA = (
    "doc_id array<long>, n binary, bounds binary, terms binary, tf binary, n_docs long, n_terms long, "
    "df_terms array<int>, df array<long>"
)


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a UTF-8 text in order."""
    return text.translate(_TERM_BYTES).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    """m: 10 for an empty document, 100 for one of mean length."""
    return 100 - 90 + (90 * n * n_docs) // n_terms


# --- items ---------------------------------------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, its different terms. Rows of one item_id (null is one, too) are one item."""
    lower = F.translate(F.col("text"), _UPPER, _LOWER)
    each = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")
    ).distinct()
    return each.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


# --- first step: restricted postings --------------------------------------------------------------------------


def _postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Blocks of documents: their postings of the terms in ``numbers``, and what they add to N, L and df."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        sizes: list[int] = []
        bounds, terms, counts = [0], [], []
        seen = [0, 0]

        def flush() -> pa.RecordBatch:
            own = np.array(terms, np.int32)
            held, df = np.unique(own, return_counts=True)
            row = {
                "doc_id": list(ids), "n": np.array(sizes, np.int64).tobytes(), "bounds": np.array(bounds, np.int64).tobytes(),
                "terms": own.tobytes(), "tf": np.array(counts, np.int64).tobytes(), "n_docs": seen[0], "n_terms": seen[1],
                "df_terms": held.tolist(), "df": df.tolist(),
            }
            ids.clear(), sizes.clear(), terms.clear(), counts.clear()
            bounds[:], seen[:] = [0], [0, 0]
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py() or b"")
                seen[0] += bool(words)
                seen[1] += len(words)
                tf = Counter(words)
                before = len(terms)
                for term in tf.keys() & numbers.keys():
                    terms.append(numbers[term])
                    counts.append(tf[term])
                if len(terms) > before:
                    ids.append(doc_id)
                    sizes.append(len(words))
                    bounds.append(len(terms))
                if len(ids) >= BLOCK_DOCS or len(terms) >= BLOCK_POSTINGS:
                    yield flush()
        if seen[0]:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(of, _BLOCK_SCHEMA)


_BLOCK_ARROW = pa.schema([
    ("doc_id", pa.list_(pa.int64())), ("n", pa.binary()), ("bounds", pa.binary()), ("terms", pa.binary()), ("tf", pa.binary()),
    ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("df_terms", pa.list_(pa.int32())), ("df", pa.list_(pa.int64())),
])


# --- second step: tree and search ------------------------------------------------------------------------------


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of runs of ``sizes`` from ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _greatest(terms: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different terms in order, and the greatest tf of each."""
    order = np.argsort(terms, kind="stable")
    terms, tf = terms[order], tf[order]
    first = np.flatnonzero(np.diff(terms, prepend=-1))
    return terms[first], np.maximum.reduceat(tf, first)


class DocumentTree:
    """FP-tree of a block. Terms are numbered in ascending order of df.

    Documents stand in the order of their term lists, so each node holds a run of them. A node without a branch is
    one with the branch below it; adjacent small children of a node are one leaf.
    """

    def __init__(self, doc_ids: list, m: np.ndarray, bounds: np.ndarray, terms: np.ndarray, tf: np.ndarray, leaf: int = LEAF_DOCS):
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((terms, owner))
        terms, tf = terms[order], tf[order]
        raw = terms.astype(">u4")
        paths = [raw[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
        place = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        moved = _gather(bounds[:-1][place], sizes[place])
        self.terms, self.tf = terms[moved], tf[moved]
        self.doc_ids = [doc_ids[i] for i in place.tolist()]
        self.m = m[place]
        self.bounds = np.concatenate([[0], np.cumsum(sizes[place])])
        self.gain = (1_000_000_000 * self.tf) // (1000 * self.tf + 8 * np.repeat(self.m, sizes[place]))
        self._branch(leaf)

    def _shared(self) -> np.ndarray:
        """Terms that each document's path shares with the one before it."""
        n = len(self.doc_ids)
        sizes = np.diff(self.bounds)
        least = np.minimum(sizes[1:], sizes[:-1])
        same = self.terms[_gather(self.bounds[:-2], least)] == self.terms[_gather(self.bounds[1:-1], least)]
        # The first place that differs in each run; a run without one is shared whole.
        ends = np.cumsum(least)
        breaks = np.concatenate([np.flatnonzero(~same), [int(ends[-1]) if n > 1 else 0]])
        starts = ends - least
        found = breaks[np.searchsorted(breaks, starts)] - starts
        return np.concatenate([[0], np.minimum(found, least)])

    def _branch(self, leaf: int) -> None:
        shared = self._shared()
        self.first, self.last, self.children = [0], [len(self.doc_ids)], [[]]
        work = [0]
        while work:
            node = work.pop()
            a, b = self.first[node], self.last[node]
            if b - a <= leaf:
                continue
            inner = shared[a + 1 : b]
            cuts = (a + 1 + np.flatnonzero(inner == inner.min())).tolist()
            start = a
            for k, cut in enumerate([*cuts, b]):
                after = cuts[k + 1] if k + 1 < len(cuts) else b
                if cut == b or after - start > leaf:
                    self.children[node].append(len(self.first))
                    work.append(len(self.first))
                    self.first.append(start)
                    self.last.append(cut)
                    self.children.append([])
                    start = cut
        # Children have higher numbers than their parents.
        n = len(self.first)
        self.most: list = [None] * n
        self.least_m = np.zeros(n, np.int64)
        for node in range(n - 1, -1, -1):
            below = self.children[node]
            if below:
                self.most[node] = _greatest(*(np.concatenate(x) for x in zip(*(self.most[c] for c in below))))
                self.least_m[node] = min(self.least_m[c] for c in below)
            else:
                a, b = self.bounds[self.first[node]], self.bounds[self.last[node]]
                self.most[node] = _greatest(self.terms[a:b], self.tf[a:b])
                self.least_m[node] = self.m[self.first[node] : self.last[node]].min()

    def node_bounds(self, weights: np.ndarray, asked: np.ndarray, askers: np.ndarray, n_items: int) -> np.ndarray:
        """Bound of each (item, node). ``askers[asked[t]:asked[t + 1]]`` are the items that hold term t."""
        out = np.zeros((len(self.first), n_items))
        for node, (terms, tf) in enumerate(self.most):
            gain = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.least_m[node]))
            sizes = asked[terms + 1] - asked[terms]
            out[node] = np.bincount(askers[_gather(asked[terms], sizes)], np.repeat(gain, sizes), n_items)
        return out.T * (1 + 1e-9)

    def search(self, bounds: np.ndarray, wanted: np.ndarray, best: list, most: int) -> None:
        """Merge this block's documents into ``best``, a heap of at most ``most`` (score, order, doc_id).

        ``bounds``: the item's bound of each node; ``wanted``: weight of each term, 0 if the item doesn't hold it.
        """
        work = [0]
        while work:
            node = work.pop()
            if bounds[node] <= 0 or (len(best) == most and bounds[node] < best[0][0]):
                continue
            below = self.children[node]
            if below:
                own = bounds[below]
                work.extend(below[i] for i in np.argsort(own, kind="stable").tolist())
                continue
            first, last = self.first[node], self.last[node]
            a, b = self.bounds[first], self.bounds[last]
            scores = np.add.reduceat(wanted[self.terms[a:b]] * self.gain[a:b], self.bounds[first:last] - a)
            least = best[0][0] if len(best) == most else 1
            for i in np.flatnonzero(scores >= max(least, 1)).tolist():
                doc_id = self.doc_ids[first + i]
                entry = (int(scores[i]), (doc_id is not None, -(doc_id or 0)), doc_id)
                if len(best) < most:
                    heapq.heappush(best, entry)
                elif entry[:2] > best[0][:2]:
                    heapq.heapreplace(best, entry)


def _searched(blocks: DataFrame, items: list[tuple[int | None, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, most: int) -> DataFrame:
    """Best documents of each task's blocks. ``items`` hold term numbers as given; ``weights`` is theirs."""
    df_order = np.argsort(-weights, kind="stable")  # ascending df
    rank = np.empty(len(weights), np.int64)
    rank[df_order] = np.arange(len(weights))
    ranked_weights = weights[df_order]
    own_terms = [rank[terms] for _, terms in items]
    item_ids = [item_id for item_id, _ in items]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in item_ids]
        wanted = np.zeros(len(ranked_weights), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                if not row["doc_id"]:
                    continue
                m = np.array([length_factor(n, n_docs, n_terms) for n in np.frombuffer(row["n"], np.int64).tolist()], np.int64)
                tree = DocumentTree(
                    row["doc_id"], m, np.frombuffer(row["bounds"], np.int64), rank[np.frombuffer(row["terms"], np.int32)],
                    np.frombuffer(row["tf"], np.int64),
                )
                step = max(1, (1 << 22) // len(tree.first))
                for k in range(0, len(item_ids), step):
                    some = own_terms[k : k + step]
                    term = np.concatenate(some)
                    asker = np.repeat(np.arange(len(some)), [len(x) for x in some])
                    order = np.argsort(term, kind="stable")
                    asked = np.searchsorted(term[order], np.arange(len(ranked_weights) + 1))
                    bounds = tree.node_bounds(ranked_weights, asked, asker[order], len(some))
                    for i, terms in enumerate(some):
                        if bounds[i, 0] > 0:
                            wanted[terms] = ranked_weights[terms]
                            tree.search(bounds[i], wanted, best[k + i], most)
                            wanted[terms] = 0
        rows = [(item_ids[i], doc_id, score) for i, own in enumerate(best) for score, _, doc_id in own]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    chosen = blocks.select("doc_id", "n", "bounds", "terms", "tf")
    return chosen.mapInArrow(of, "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, most: int = BEST, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``most`` documents with the highest scores above 0.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are ignored. A null text has no terms. Rows of one
    item_id are one item; each row of ``docs`` is a document, repeated ones too. Equal scores go by doc_id, null last. Items
    or documents without rows or terms give no rows.
    """
    spark = docs.sparkSession
    asked = materialize(item_terms(items), "lexical-items")
    size = asked.agg(F.sum(F.octet_length(F.concat_ws(" ", "terms")))).first()[0] or 0
    n_blocks = -(-size // item_bytes)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    within = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for k in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == k).collect()  # about item_bytes
        terms = sorted({t for row in rows for t in row.terms})
        numbers = {t.encode(): i for i, t in enumerate(terms)}
        if not rows:
            continue
        blocks = materialize(_postings(docs, numbers), "lexical-blocks")
        n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            break
        held = blocks.select(F.explode(F.arrays_zip("df_terms", "df")).alias("h")).groupBy("h.df_terms").agg(F.sum("h.df").alias("df"))
        df = np.zeros(len(terms), np.int64)
        for term, n in held.collect():  # at most one row per term of the block of items
            df[term] = n
        weights = np.array([term_weight(n_docs, n) for n in df.tolist()], np.int64)
        own = [(row.item_id, np.array([numbers[t.encode()] for t in row.terms], np.int64)) for row in rows]
        found = _searched(blocks, own, weights, n_docs, n_terms, most)
        ranked = found.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= most)
        out = out.unionByName(materialize(ranked.select("item_id", "rank", "doc_id", "score"), "lexical-found"))
    return out
