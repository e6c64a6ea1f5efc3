"""Exact nearest references for vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.storage import materialize


def vector_matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), dtype=np.float64)


def squared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances, summed element by element so that equal vectors give exactly 0."""
    out = np.zeros((len(left), len(right)))
    for j in range(left.shape[1]):
        step = left[:, j, None] - right[None, :, j]
        out += step * step
    return out


def nearest_references(
    queries: DataFrame,
    references: DataFrame,
    k: int = 1,
    query_id: str = "query_id",
    ref_id: str = "ref_id",
    vector: str = "vector",
    max_pivots: int = 64,
    block_rows: int = 2_000,
    parts_per_task: int = 32,
) -> DataFrame:
    """(query_id, ref_id, distance2, rank): the ``k`` nearest references of each query, ties to the smaller id.

    Exact for any size of either side. References are grouped around a bounded
    number of pivots; each cell knows its row count and radius. By the triangle
    inequality a query only visits cells that can hold one of its ``k`` nearest.
    A cell is dealt out over blocks of about ``block_rows`` references and the
    queries that visit it over blocks of the same size, so every task compares two
    bounded blocks as matrices and returns at most ``k`` rows per query. Pairs are
    never emitted, and a hot cell only means more blocks.
    """
    spark = references.sparkSession
    refs = references.select(F.col(ref_id).alias("rid"), F.col(vector).alias("rv"))
    asked = queries.select(F.col(query_id).alias("qid"), F.col(vector).alias("qv"))

    # At most max_pivots vectors reach the driver.
    pivot_rows = refs.orderBy(F.xxhash64("rid"), "rid").limit(max_pivots).select("rv").collect()
    if not pivot_rows:
        return asked.limit(0).select(
            F.col("qid").alias(query_id), F.lit(None).cast(refs.schema["rid"].dataType).alias(ref_id),
            F.lit(0.0).alias("distance2"), F.lit(0).alias("rank"),
        )
    pivots = np.array([row[0] for row in pivot_rows], dtype=np.float64)

    @F.pandas_udf("cell int, far double")
    def assign(vectors: pd.Series) -> pd.DataFrame:
        d = squared_distances(vector_matrix(vectors), pivots)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "far": np.sqrt(d[np.arange(len(d)), cell])})

    placed = materialize(refs.withColumn("_a", assign("rv")).select("rid", "rv", "_a.cell", "_a.far"), "references")
    # One row per cell, hence at most max_pivots rows.
    cells = placed.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).orderBy("cell").collect()
    ids = np.array([c["cell"] for c in cells])
    radius = np.array([c["radius"] for c in cells])
    sizes = np.array([c["n"] for c in cells])
    blocks = {int(c["cell"]): math.ceil(c["n"] / block_rows) for c in cells}
    block_count = F.element_at(F.create_map(*[F.lit(v) for pair in blocks.items() for v in pair]), F.col("cell"))

    @F.pandas_udf("array<int>")
    def visit(vectors: pd.Series) -> pd.Series:
        centre = np.sqrt(squared_distances(vector_matrix(vectors), pivots[ids]))
        upper = centre + radius
        order = upper.argsort(axis=1)
        held = sizes[order].cumsum(axis=1)
        last = np.minimum((held < k).sum(axis=1), len(ids) - 1)
        bound = upper[np.arange(len(upper)), order[np.arange(len(upper)), last]]
        # The slack keeps rounding from closing a cell whose distance equals the bound.
        near = centre - radius <= bound[:, None] * (1 + 1e-9) + 1e-9
        return pd.Series([ids[row].tolist() for row in near])

    block = F.pmod(F.xxhash64("rid"), block_count).cast("int")
    routed = asked.select("qid", "qv", F.explode(visit("qv")).alias("cell"))
    routed = materialize(routed, "visits")
    visits = routed.groupBy("cell").agg(F.count("*").alias("n")).collect()  # at most max_pivots rows
    parts = {int(v["cell"]): math.ceil(v["n"] / block_rows) for v in visits} or {-1: 1}
    part_count = F.try_element_at(F.create_map(*[F.lit(v) for pair in parts.items() for v in pair]), F.col("cell"))
    # A reference block meets the query blocks of its cell in groups of parts_per_task, each its own join key.
    query_blocks = (
        routed.withColumn("part", F.pmod(F.xxhash64("qid"), part_count).cast("int"))
        .groupBy("cell", "part")
        .agg(F.collect_list("qid").alias("qids"), F.collect_list("qv").alias("qvs"))
        .withColumn("turn", F.floor(F.col("part") / parts_per_task).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), block_count - 1)))
    )
    turns = F.ceil(part_count / parts_per_task).cast("int")
    ref_blocks = (
        placed.withColumn("block", block)
        .groupBy("cell", "block")
        .agg(F.collect_list("rid").alias("rids"), F.collect_list("rv").alias("rvs"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1)))
    )

    id_types = [asked.schema["qid"].dataType, refs.schema["rid"].dataType]
    schema = T.StructType().add("qid", id_types[0]).add("rid", id_types[1]).add("distance2", "double")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tile in batch.itertuples():
                rids = np.asarray(tile.rids)
                order = rids.argsort(kind="stable")
                rids, rvs = rids[order], np.array(tile.rvs.tolist(), dtype=np.float64)[order]
                qids, qvs = np.asarray(tile.qids), np.array(tile.qvs.tolist(), dtype=np.float64)
                for start in range(0, len(qids), 256):
                    d = squared_distances(qvs[start : start + 256], rvs)
                    best = d.argsort(axis=1, kind="stable")[:, :k]
                    rows = np.arange(len(d))[:, None]
                    yield pd.DataFrame({
                        "qid": np.repeat(qids[start : start + 256], best.shape[1]),
                        "rid": rids[best].ravel(),
                        "distance2": d[rows, best].ravel(),
                    })

    tiles = query_blocks.join(ref_blocks, ["cell", "block", "turn"]).select("qids", "qvs", "rids", "rvs")
    found = tiles.mapInPandas(compare, schema)
    # Row number up to k plans as a group limit before the shuffle.
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("distance2", "rid"))
    return (
        found.withColumn("rank", rank).where(F.col("rank") <= k)
        .select(F.col("qid").alias(query_id), F.col("rid").alias(ref_id), "distance2", "rank")
    )
