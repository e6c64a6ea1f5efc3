"""Hard negatives by LEMP-style coordinate pruning.

A row is a vector of whole numbers; its score with an anchor is their inner product. Rows are sorted by length (Euclidean
norm) and cut into buckets of bounded size. An anchor meets buckets with the longest rows first:

- An anchor of length a needs a score of at least t (the tenth best so far, or the least that is allowed). A bucket whose
  longest row is shorter than t / a can't reach it and is left.
- Otherwise the cosine must be at least c = t / (a * longest). For a coordinate f, on which the anchor's direction is q, a
  row's direction then lies within q * c - sqrt((1 - c^2)(1 - q^2)) and q * c + sqrt((1 - c^2)(1 - q^2)). A bucket has each
  coordinate's values in order, so the range is a run found by bisection. The runs of the anchor's ``FOCUS`` largest
  coordinates are intersected, and the rows left are verified with exact whole-number scores.

Two rounds: positives (best rows of the anchor's label), then negatives (rows of other labels), for each positive the best
whose scores its range allows. Anchors are a stated part of the rows: blocks of them meet slices of buckets, dealt out by
(block, slice), so neither a label that holds most rows nor the number of anchors makes a large task. A task keeps running
bests, and only bests leave it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.storage import materialize

#: Rows and bytes of a bucket, coordinates an anchor looks at.
BUCKET_ROWS, BUCKET_BYTES, FOCUS = 1024, 1 << 20, 4
#: Blocks of anchors are of this size at least and at most; in between there are ``BLOCKS`` of them.
LEAST_BLOCK, MOST_BLOCK, BLOCKS = 256, 16384, 512
#: Buckets of a slice at least, slices at most.
SLICE_BUCKETS, SLICES = 4, 512
_SLACK = 1e-5  # by which ranges are wider than computed; far above rounding


def whole_vector(vector: Column, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down, as long; null for a vector with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


# --- packed rows -----------------------------------------------------------------------------------------------

_PACKED = "part long, n long, dim int, width int, longest double, ids binary, labels binary, vectors binary, extra binary"
_PACKED_ARROW = pa.schema([
    ("part", pa.int64()), ("n", pa.int64()), ("dim", pa.int32()), ("width", pa.int32()), ("longest", pa.float64()),
    ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("extra", pa.binary()),
])


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(1))


def _packed(rows: DataFrame, part: Column, most: int) -> DataFrame:
    """Rows (vec_id, label, v, extra) of one part as runs of at most ``most``, the longest first, each with a number.

    Vectors are of the least type that holds them; shorter ones are filled up with 0. ``extra``: whole numbers of any number.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, list[int], list[int]]] = []
        state = {"part": None, "bytes": 0}

        def flush() -> pa.RecordBatch:
            ids, labels, own, extra = zip(*held)
            dim = max(map(len, own))
            vectors = np.zeros((len(own), dim), np.int64)
            for i, v in enumerate(own):
                vectors[i, : len(v)] = v
            reach = int(max(vectors.max(initial=0), -vectors.min(initial=0) - 1))
            width = next(w for w in (2, 4, 8) if reach < 1 << (8 * w - 1))
            row = {
                "part": state["part"], "n": len(own), "dim": dim, "width": width,
                "longest": float(_lengths(vectors).max()), "ids": np.array(ids, np.int64).tobytes(),
                "labels": np.array(labels, np.int64).tobytes(), "vectors": vectors.astype(f"<i{width}").tobytes(),
                "extra": np.array([x for own in extra for x in (len(own), *own)], np.int64).tobytes(),
            }
            held.clear()
            state["bytes"] = 0
            return pa.RecordBatch.from_pylist([row], schema=_PACKED_ARROW)

        for batch in batches:
            for own_part, *row in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if held and (own_part != state["part"] or len(held) >= most or state["bytes"] >= BUCKET_BYTES):
                    yield flush()
                state["part"] = own_part
                state["bytes"] += 2 * len(row[2])
                held.append(row)
        if held:
            yield flush()

    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    order = ["_part", F.desc("_length"), "vec_id"]
    ordered = (
        rows.select(part.alias("_part"), "vec_id", "label", "v", "extra", length.alias("_length"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
    )
    return materialize(ordered.mapInArrow(of, _PACKED).withColumn("number", F.monotonically_increasing_id()), "lemp-packed")


def _vectors(row: dict) -> np.ndarray:
    return np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(row["n"], row["dim"]).astype(np.int64)


class Bucket:
    """Rows of a bucket; coordinates are sorted once they are asked for."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        lengths = _lengths(vectors)
        self.longest = float(lengths.max())
        self.directions = np.ascontiguousarray((vectors / np.where(lengths, lengths, 1)[:, None]).T)
        self._as_float = vectors.astype(np.float64)
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._sorted:
            order = np.argsort(self.directions[f], kind="stable")
            self._sorted[f] = order, self.directions[f][order]
        return self._sorted[f]

    def candidates(self, direction: np.ndarray, focus: list[int], cosine: float) -> np.ndarray:
        """Rows whose cosine with ``direction`` may be ``cosine`` (above 0) or more, as far as the coordinates ``focus`` tell."""
        if cosine > 1:
            return np.zeros(0, np.int64)
        runs = []
        for f in focus:
            q = float(direction[f])
            width = np.sqrt(max(0.0, (1 - cosine**2) * (1 - q * q)))
            # Directions beyond the axis itself: all up to the axis are near enough.
            low = (q * cosine - width if q >= -cosine else -1.0) - _SLACK
            high = (q * cosine + width if q <= cosine else 1.0) + _SLACK
            if f < len(self.directions):
                values = self._coordinate(f)[1]
                a, b = (int(x) for x in (np.searchsorted(values, low), np.searchsorted(values, high, "right")))
                runs.append((b - a, f, a, low, high))
            elif not low <= 0 <= high:  # these rows have no such coordinate
                return np.zeros(0, np.int64)
        if not runs:
            return np.arange(len(self.ids))
        runs.sort()
        n, f, a, _, _ = runs[0]
        own = self._coordinate(f)[0][a : a + n]
        for n, f, _, low, high in runs[1:]:
            if n < len(self.ids):
                values = self.directions[f][own]
                own = own[(values >= low) & (values <= high)]
        return own

    def scores(self, rows: np.ndarray, vector: np.ndarray, length: float) -> np.ndarray:
        """Exact scores of ``rows`` with a vector of that length."""
        dim = min(len(vector), self.vectors.shape[1])
        if self.longest * length < 1 << 52:  # products and their sums are whole numbers that float64 holds
            own = self._as_float if len(rows) == len(self.ids) else self._as_float[rows]
            found = own[:, :dim] @ vector[:dim].astype(np.float64)
            return (found[rows] if len(rows) == len(self.ids) else found).astype(np.int64)
        exact = [sum(x * y for x, y in zip(self.vectors[i, :dim].tolist(), vector[:dim].tolist())) for i in rows]
        if any(not -(1 << 63) <= x < 1 << 63 for x in exact):
            raise OverflowError("a score does not fit into 64 bits")
        return np.array(exact, np.int64)


class Anchor:
    """An anchor, and the ``most`` best (score, -vec_id) in each of its ranges (least, greatest score; None: any)."""

    def __init__(self, vec_id: int, label: int, vector: np.ndarray, ranges: list[tuple[int | None, int | None]], most: int):
        self.vec_id, self.label, self.vector, self.ranges, self.most = vec_id, label, vector, ranges, most
        self.length = float(_lengths(vector[None])[0])
        self.direction = vector / (self.length or 1.0)
        self.focus = np.argsort(-np.abs(self.direction), kind="stable")[:FOCUS].tolist()
        self.best: list[list[tuple[int, int]]] = [[] for _ in ranges]

    def needed(self) -> int | None:
        """Least score that still matters; None if any does."""
        least = []
        for (low, _), best in zip(self.ranges, self.best):
            bounds = [x for x in (low, best[0][0] if len(best) == self.most else None) if x is not None]
            if not bounds:
                return None
            least.append(max(bounds))
        return min(least)

    def visit(self, bucket: Bucket, same_label: bool) -> None:
        needed = self.needed()
        reach = self.length * bucket.longest
        if needed is None or needed <= 0:
            rows = np.arange(len(bucket.ids))
        elif needed > reach * (1 + 1e-9):
            return
        else:
            rows = bucket.candidates(self.direction, self.focus, needed / reach * (1 - 1e-9))
        if not len(rows):
            return
        scores = bucket.scores(rows, self.vector, self.length)
        fits = ((bucket.labels[rows] == self.label) == same_label) & (bucket.ids[rows] != self.vec_id)
        if needed is not None:
            fits &= scores >= needed
        rows, scores = rows[fits], scores[fits]
        ids = bucket.ids[rows]
        for (low, high), best in zip(self.ranges, self.best):
            fits = np.ones(len(scores), bool)
            if high is not None:
                fits &= scores <= high
            if low is not None:
                fits &= scores >= low
            if len(best) == self.most:
                fits &= scores >= best[0][0]
            own = np.flatnonzero(fits)
            if len(own) > self.most:
                own = own[np.lexsort((ids[own], -scores[own]))[: self.most]]
            for entry in zip(scores[own].tolist(), (-ids[own]).tolist()):
                if len(best) < self.most:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def _anchors(row: dict, most: int) -> Iterator[Anchor]:
    """Anchors of a packed block; ``extra`` holds their ranges (low, high, ...), none for one range of all scores."""
    vectors = _vectors(row)
    labels = np.frombuffer(row["labels"], np.int64).tolist()
    extra = np.frombuffer(row["extra"], np.int64).tolist()
    at = 0
    for i, vec_id in enumerate(np.frombuffer(row["ids"], np.int64).tolist()):
        n = extra[at]
        own = extra[at + 1 : at + 1 + n]
        at += 1 + n
        yield Anchor(vec_id, labels[i], vectors[i], list(zip(own[::2], own[1::2])) or [(None, None)], most)


def _bests(blocks: DataFrame, buckets: DataFrame, same_label: bool, most: int) -> DataFrame:
    """anchor_id, range (its number), vec_id, score, rank: the ``most`` best rows of each anchor's ranges."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors = None, []

        def found() -> pa.RecordBatch:
            rows = [
                (anchor.vec_id, k, -negated, score)
                for anchor in anchors for k, best in enumerate(anchor.best) for score, negated in best
            ]
            columns = zip(*rows) if rows else ([], [], [], [])
            types = pa.int64(), pa.int32(), pa.int64(), pa.int64()
            names = ["anchor_id", "range", "vec_id", "score"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                now = row["part"], row["_g"], row["_s"]
                if now != key:
                    if anchors:
                        yield found()
                    key, anchors = now, []
                if not row["_kind"]:
                    anchors.extend(_anchors(row, most))
                    continue
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                bucket = Bucket(ids, labels, _vectors(row))
                for anchor in anchors:
                    anchor.visit(bucket, same_label)
        if anchors:
            yield found()

    sizes = buckets.groupBy("part").agg(F.least(F.ceil(F.count("*") / SLICE_BUCKETS), F.lit(SLICES)).cast("long").alias("_slices"))
    sizes = blocks.groupBy("part").agg(F.count("*").alias("_blocks")).join(sizes, "part")
    place = lambda n: F.pmod(F.xxhash64("number"), F.col(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = ["part", "n", "dim", "width", "longest", "ids", "labels", "vectors", "extra", "number"]
    ours = blocks.join(sizes, "part").select(*columns, F.lit(0).alias("_kind"), place("_blocks").alias("_g"), spread("_slices").alias("_s"))
    theirs = buckets.join(sizes, "part").select(*columns, F.lit(1).alias("_kind"), place("_slices").alias("_s"), spread("_blocks").alias("_g"))
    met = (
        ours.unionByName(theirs).repartition("part", "_g", "_s")
        .sortWithinPartitions("part", "_g", "_s", "_kind", F.desc("longest"), "number")
    )
    bests = met.mapInArrow(of, "anchor_id long, range int, vec_id long, score long")
    within = Window.partitionBy("anchor_id", "range").orderBy(F.desc("score"), "vec_id")
    return bests.withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= most)


def mine_negatives(
    rows: DataFrame, is_anchor: str | Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, label, embedding (whole numbers); other columns are ignored. An anchor's positives are the ``positives``
    other rows of its label with the highest scores. For each, the ``negatives`` rows of other labels with the highest
    scores among those between ``low`` and ``high`` percent of the positive's score; ties go to the smaller vec_id.

    Rows with a null vec_id, label, vector or component take no part. A vec_id names one row: of several, that of the least
    label, then vector. Missing components count as 0. A positive's score below 0 leaves no range, one of 0 only scores
    of 0. Anchors without positives or negatives give no rows, nor do empty tables. A score beyond 64 bits fails the job.
    """
    whole = F.col("embedding").cast("array<long>")
    taken = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))
    taken = taken.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")
    one = taken.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    stored = materialize(one, "lemp-rows")
    chosen = stored.where(is_anchor)
    n_rows, n_labels = stored.agg(F.count("*"), F.approx_count_distinct("label")).first()
    block_rows = min(MOST_BLOCK, max(LEAST_BLOCK, chosen.count() // BLOCKS))
    nothing = F.array().cast("array<long>").alias("extra")

    # Small labels share a part, so that buckets are full; a large one fills many buckets of its part.
    parts = max(1, min(4 * n_labels, n_rows // BUCKET_ROWS))
    part = F.pmod(F.xxhash64("label"), F.lit(parts))
    blocks = _packed(chosen.select("*", nothing), part, block_rows)
    best = _bests(blocks, _packed(stored.select("*", nothing), part, BUCKET_ROWS), True, positives)
    found = materialize(best.select("anchor_id", F.col("vec_id").alias("positive_id"), "score", "rank"), "lemp-positives")

    bounds = F.array(F.expr(f"({low} * score + 99) div 100"), F.expr(f"({high} * score) div 100"))
    ranges = (
        found.where("score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", bounds.alias("b")))).alias("r"))
        .select(F.col("anchor_id").alias("vec_id"), F.flatten(F.transform("r", lambda x: x["b"])).alias("extra"))
    )
    whole_table = F.lit(0).cast("long")
    blocks = _packed(chosen.join(ranges, "vec_id"), whole_table, block_rows)
    best = _bests(blocks, _packed(stored.select("*", nothing), whole_table, BUCKET_ROWS), False, negatives)
    told = best.select(
        "anchor_id", (F.col("range") + 1).alias("_rank"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = found.select("anchor_id", F.col("rank").alias("_rank"), "positive_id", F.col("score").alias("positive_score"))
    return told.join(named, ["anchor_id", "_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
