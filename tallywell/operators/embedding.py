"""Embedding of cells by their neighbour graph: cells that are alike come to lie together, however far apart others are."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.operators.nearest_lsh import kept_vector, nearest_references_lsh
from tallywell.storage import materialize

#: Edges of a cell that make a list.
LIST_EDGES = 64


def _distance2(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(F.col(a).cast("array<double>"), F.col(b).cast("array<double>"), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, d: total + d)


def neighbour_graph(
    cells: DataFrame, k: int = 10, cell_id: str = "cell_id", vector: str = "vector", rounds: int = 1, tables: int = 8, probes: int = 1,
    bucket_rows: int = 512,
) -> DataFrame:
    """(i, j, distance2): up to ``k`` near neighbours j of each cell i.

    A first graph from random projections is improved by neighbour descent: in each of ``rounds`` rounds the neighbours of a
    cell's neighbours stand for election too. A cell brings at most k + k * k candidates, so work grows with the cells. They are
    measured where they meet, at the neighbour between them, so a vector moves 2 * k times, not k * k times, and only those
    leave that are no farther than the ``k`` known ones. Cells with a null vector have no neighbours.
    """
    own = materialize(
        cells.where(F.col(vector).isNotNull()).select(F.col(cell_id).alias("i"), kept_vector(cells, vector).alias("v")), "cells"
    )
    asked, known = own.withColumnsRenamed({"i": "query_id", "v": "vector"}), own.withColumnsRenamed({"i": "ref_id", "v": "vector"})
    found = nearest_references_lsh(asked, known, k=k + 1, tables=tables, probes=probes, bucket_rows=bucket_rows)
    best = F.row_number().over(Window.partitionBy("i").orderBy("distance2", "j"))
    graph = found.where("query_id <> ref_id").select(F.col("query_id").alias("i"), F.col("ref_id").alias("j"), "distance2")
    graph = materialize(graph.withColumn("_r", best).where(F.col("_r") <= k).drop("_r"), "neighbours")
    for _ in range(rounds):
        held = graph.groupBy("i").agg(
            F.collect_list("j").alias("known"), F.when(F.count("*") >= k, F.max("distance2")).alias("least")
        )
        asked = own.join(held, "i").select("i", F.col("v").alias("_a"), "known", "least", F.explode("known").alias("via"))
        near = graph.select(F.col("i").alias("via"), "j").join(own.select(F.col("i").alias("j"), F.col("v").alias("_b")), "j")
        near = near.groupBy("via").agg(F.collect_list(F.struct("j", "_b")).alias("near"))
        met = asked.join(near, "via").select("i", "_a", "known", "least", F.explode("near").alias("_n"))
        met = met.where((F.col("_n.j") != F.col("i")) & ~F.array_contains("known", F.col("_n.j")))
        measured = met.select("i", "least", F.col("_n.j").alias("j"), _distance2("_a", "_n._b").alias("distance2"))
        measured = measured.where(F.col("least").isNull() | (F.col("distance2") <= F.col("least"))).select("i", "j", "distance2")
        graph = materialize(
            graph.unionByName(measured).repartition("i").distinct().withColumn("_r", best).where(F.col("_r") <= k).drop("_r"), "neighbours"
        )
    return graph


def _edges(graph: DataFrame) -> DataFrame:
    """(i, j, w) in both directions, weighted by 1 / sqrt(degree of i * degree of j)."""
    both = graph.select("i", "j").unionByName(graph.select(F.col("j").alias("i"), F.col("i").alias("j"))).distinct()
    degrees = both.groupBy("i").agg(F.count("*").cast("double").alias("d"))
    ends = both.join(degrees, "i").join(degrees.select(F.col("i").alias("j"), F.col("d").alias("e")), "j")
    return ends.select("i", "j", "d", (1 / F.sqrt(F.col("d") * F.col("e"))).alias("w"))


def embed_graph(graph: DataFrame, dims: int = 2, rounds: int = 30, spare: int = 3, seed: int = 0) -> tuple[DataFrame, np.ndarray]:
    """((i, degree, component_1, ...), eigenvalues): the leading vectors of a neighbour graph's normalised Laplacian.

    The vectors x belong to the largest eigenvalues of (1 + W) / 2, W the normalised weights, next to the one that is the square
    root of the degrees; a component is x / sqrt(degree). All are found at once by power iteration on ``dims`` + ``spare``
    columns: a round is a join of the edges with the columns and a sum per cell, and only sums of products of columns
    reach the driver. Each component is orthogonal to the others and has mean 0, weighted by degrees; the largest value is positive.
    """
    edges = materialize(_edges(graph), "edges")
    # The edges of a cell in lists of bounded length.
    part = F.pmod(F.xxhash64("i"), F.ceil(1 / (F.col("w") * F.col("w") * F.col("d") * LIST_EDGES)))
    lists = edges.groupBy("j", part.alias("part")).agg(F.collect_list(F.struct("i", "w")).alias("e"))
    lists = materialize(lists.select("j", F.col("e.i").alias("i"), F.col("e.w").alias("w")), "edge-lists")
    degrees = edges.groupBy("i").agg(F.max("d").alias("d"))
    whole = degrees.agg(F.sum("d")).first()[0]
    columns = [f"x{c}" for c in range(dims + spare)]
    noise = [((F.xxhash64("i", F.lit(seed), F.lit(c)) / F.lit(2.0**63)) * F.sqrt("d")).alias(x) for c, x in enumerate(columns)]
    if whole is None:
        none = degrees.select("i", F.col("d").alias("degree"), *[F.lit(0.0).alias(f"component_{c + 1}") for c in range(dims)])
        return none, np.zeros(0)
    held = materialize(degrees.select("i", "d", *noise), "columns")

    def step(x: DataFrame) -> DataFrame:
        values = x.select(F.col("i").alias("j"), *columns)
        met = lists.join(values, "j").select(F.explode(F.arrays_zip("i", "w")).alias("e"), *columns).select("e.i", "e.w", *columns)
        sums = met.groupBy("i").agg(*[F.sum(F.col("w") * F.col(c)).alias(f"s_{c}") for c in columns])
        return x.join(sums, "i").select("i", "d", *[((F.col(c) + F.col(f"s_{c}")) / 2).alias(c) for c in columns])

    def products(x: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
        row = x.agg(*[F.sum(F.col(a) * F.col(b)) for a in left for b in right]).first()
        return np.array(row, float).reshape(len(left), len(right))

    def turned(x: DataFrame, by: np.ndarray) -> DataFrame:
        mixed = [sum((F.col(a) * float(by[r, c]) for r, a in enumerate(columns)), F.lit(0.0)).alias(b) for c, b in enumerate(columns)]
        return x.select("i", "d", *mixed)

    def orthonormal(x: DataFrame) -> DataFrame:
        root = x.withColumn("t", F.sqrt(F.col("d") / whole))
        share = products(root, ["t"], columns)[0]
        flat = root.select("i", "d", *[(F.col(c) - F.col("t") * float(s)).alias(c) for c, s in zip(columns, share)])
        gram = products(flat, columns, columns)
        values, vectors = np.linalg.eigh(gram)
        # Columns that have run together are left out.
        scale = np.where(values > values[-1] * 1e-13, 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
        return materialize(turned(flat, vectors * scale), "columns")

    held = orthonormal(held)
    for number in range(rounds):
        held = materialize(step(held), "columns")
        if number % 3 == 2 or number == rounds - 1:
            held = orthonormal(orthonormal(held))
    after = materialize(step(held).select("i", *[F.col(c).alias(f"y{c}") for c in columns]), "columns")
    small = products(held.join(after, "i"), columns, [f"y{c}" for c in columns])
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)
    held = materialize(turned(held, vectors[:, order]), "columns")
    out = [(F.col(c) / F.sqrt("d")).alias(f"component_{n + 1}") for n, c in enumerate(columns[:dims])]
    placed = materialize(held.select("i", F.col("d").alias("degree"), *out), "embedding")
    names = [f"component_{n + 1}" for n in range(dims)]
    most = placed.agg(*[F.max_by(c, F.abs(c)) for c in names]).first()
    signed = [(F.col(c) * (-1.0 if m is not None and m < 0 else 1.0)).alias(c) for c, m in zip(names, most)]
    return placed.select("i", "degree", *signed), values[order][:dims]


def residuals(graph: DataFrame, embedding: DataFrame, values: np.ndarray) -> list[float]:
    """Per component, how far x is from an eigenvector of its value: |(1 + W) x / 2 - value * x| / |x|."""
    edges, out = _edges(graph), []
    for n, value in enumerate(values):
        x = embedding.select("i", (F.col(f"component_{n + 1}") * F.sqrt("degree")).alias("x"))
        sums = edges.join(x.select(F.col("i").alias("j"), F.col("x").alias("y")), "j").groupBy("i").agg(F.sum(F.col("w") * F.col("y")).alias("s"))
        off = x.join(sums, "i").select("x", ((F.col("x") + F.col("s")) / 2 - F.col("x") * float(value)).alias("r"))
        row = off.agg(F.sum(F.col("r") * F.col("r")), F.sum(F.col("x") * F.col("x"))).first()
        out.append(float(np.sqrt(row[0] / row[1])))
    return out


def embed_cells(
    cells: DataFrame, k: int = 10, dims: int = 2, cell_id: str = "cell_id", vector: str = "vector", rounds: int = 30, prefix: str = "component"
) -> DataFrame:
    """``cells`` with ``dims`` components of their neighbour graph; null for cells without a vector or without neighbours."""
    graph = neighbour_graph(cells, k, cell_id, vector)
    placed, _ = embed_graph(graph, dims, rounds)
    named = placed.select(F.col("i").alias("_i"), *[F.col(f"component_{n + 1}").alias(f"{prefix}_{n + 1}") for n in range(dims)])
    return cells.join(named, F.col(cell_id) == F.col("_i"), "left").drop("_i")
