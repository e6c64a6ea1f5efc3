"""Cell features and nearest references."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywell.functions import names
from tallywell.operators import features as ft
from tallywell.operators import embedding, nearest, nearest_lsh, tabular
from tallywell.plans.standins import sql_well
from tallywell.session import table
from tallywell.storage import fresh_path, materialize

VECTOR_SIZE = 64
PART_SIZE = VECTOR_SIZE // 2  # features of a nucleus, and of its cytoplasm


def _cells(spark, sf_dir):
    well = names.well_name(F.col("label") * 8 + F.col("vec_id") % 8, 12)
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", "label", well.alias("Metadata_Well"), (F.col("vec_id") % 4 + 1).cast("int").alias("Metadata_Site")
    )


def _nucleus(cells):
    values = [F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}") for i in range(PART_SIZE)]
    return cells.select("Metadata_Well", "Metadata_Site", F.col("vec_id").alias("ObjectNumber"), *values)


def _cytoplasm(cells):
    values = [F.get("embedding", F.lit(i + PART_SIZE)).cast("double").alias(f"f{i}") for i in range(PART_SIZE)]
    found = cells.where(F.get("embedding", F.lit(0)) > 0)  # not every nucleus has a cytoplasm
    return found.select(
        "Metadata_Well", "Metadata_Site", (F.col("vec_id") + 1_000_000).alias("ObjectNumber"),
        F.col("vec_id").alias("Parent_nucleus"), *values,
    )


def _layout(spark, sf_dir):
    wells = _cells(spark, sf_dir).where(F.col("label") != 9).select(F.col("Metadata_Well").alias("well"), "label").distinct()
    return wells.select("well", F.concat(F.lit("c"), "label").alias("compound"), (F.col("label") % 2 == 0).alias("is_reference"))


def _joined(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return ft.join_cell_parts({"nucleus": _nucleus(cells), "cytoplasm": _cytoplasm(cells)})


def prefix_columns(spark, sf_dir):
    return tabular.prefix_columns(_nucleus(_cells(spark, sf_dir)), "nucleus", ["Metadata_Well", "ObjectNumber"])


def join_cell_parts(spark, sf_dir):
    return _joined(spark, sf_dir)


def attach_compounds(spark, sf_dir):
    cells = ft.attach_compounds(_joined(spark, sf_dir), _layout(spark, sf_dir))
    return cells.select("ObjectNumber", "Metadata_Well", "compound", "is_reference", "nucleus_f0")


def _store_results(spark, sf_dir):
    """Three batches of result files, the last as CSV."""
    root = fresh_path(spark, "results")
    cells = _cells(spark, sf_dir)
    batch = F.col("vec_id") % 3
    for number, suffix in enumerate((".parquet", ".parquet", ".csv")):
        rows = cells.where(batch == number)
        for stem, frame in (("nucleus", _nucleus(rows)), ("cytoplasm", _cytoplasm(rows))):
            kind = suffix.removeprefix(".")
            frame.write.format(kind).options(**({"header": "true"} if kind == "csv" else {})).save(
                f"{root}/screen one/plate+1/{number}/{stem}{suffix}"
            )
    batches = cells.select(batch.alias("batch")).distinct()
    suffix = F.when(F.col("batch") == 2, ".csv").otherwise(".parquet")
    stems = F.array(*[F.lit(s) for s in ("nucleus", "cytoplasm", "Image", "Experiment")])
    files = batches.select("batch", F.explode(stems).alias("stem")).select(
        F.concat("stem", suffix).alias("filename"), F.concat(F.lit("screen one/plate+1/"), "batch", F.lit("/"), "stem", suffix).alias("s3path")
    )
    return root, files


_CSV_FEATURES = ", ".join(f"f{i} double" for i in range(PART_SIZE))
_CSV = {
    "nucleus": f"Metadata_Well string, Metadata_Site int, ObjectNumber bigint, {_CSV_FEATURES}",
    "cytoplasm": f"Metadata_Well string, Metadata_Site int, ObjectNumber bigint, Parent_nucleus bigint, {_CSV_FEATURES}",
}
_FOLDERS = "screen one/plate+1/*"


def merge_frames(spark, sf_dir):
    root, files = _store_results(spark, sf_dir)
    frames = ft.merge_frames(spark, root, _FOLDERS, files, _CSV)
    features = [f"f{i}" for i in range(PART_SIZE)]
    named = [frame.select(F.lit(stem).alias("stem"), "ObjectNumber", "Metadata_Site", *features) for stem, frame in frames.items()]
    return named[0].unionByName(named[1])


def reduce_experiment(spark, sf_dir):
    root, files = _store_results(spark, sf_dir)
    reduced = ft.reduce_experiment(spark, root, _FOLDERS, files, _layout(spark, sf_dir))
    placed = F.col("component_1").isNotNull() & F.col("component_2").isNotNull()
    return reduced.select("ObjectNumber", "Metadata_Well", "compound", placed.alias("placed"))


def reduce_features(spark, sf_dir):
    columns = [f"e{i}" for i in range(VECTOR_SIZE)]
    wide = table(spark, sf_dir, "embeddings").select(
        "vec_id", *[F.get("embedding", F.lit(i)).alias(c) for i, c in enumerate(columns)]
    )
    one, two = F.col("component_1"), F.col("component_2")
    # What holds for principal components whatever the solver: centred, uncorrelated, of falling variance.
    return ft.reduce_features(wide, columns).agg(
        F.count("*").alias("n"), F.count(one + two).alias("placed"),
        ((F.abs(F.avg(one)) < 1e-6) & (F.abs(F.avg(two)) < 1e-6)).alias("centred"),
        (F.abs(F.corr(one, two)) < 1e-6).alias("uncorrelated"),
        ((F.var_samp(one) >= F.var_samp(two)) & (F.var_samp(two) > 0)).alias("falling"),
    )


def nearest_reference(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))
    # The known compounds are the profiles of the labels: as many as the library has, however many cells are asked for.
    profiles = ft.group_profiles(vectors, "label", "embedding", VECTOR_SIZE)
    known = profiles.groupBy(F.col("label").cast("bigint").alias("ref_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "mean"))), lambda x: x["mean"]).alias("vector")
    )
    found = nearest.nearest_references(asked, known, k=3)
    return found.withColumn("distance2", F.round("distance2", 6))


def embed_cells(spark, sf_dir):
    cells = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    graph = embedding.neighbour_graph(cells, 10, "vec_id")
    placed, values = embedding.embed_graph(graph, rounds=18)
    off = embedding.residuals(graph, placed, values)
    one, two, weight = F.col("component_1"), F.col("component_2"), F.col("degree")
    # What holds for the graph's leading vectors whatever the way to them.
    return cells.join(placed, F.col("vec_id") == F.col("i"), "left").agg(
        F.count("*").alias("n"), F.count(one + two).alias("placed"),
        ((F.abs(F.sum(one * weight)) < 1e-6) & (F.abs(F.sum(two * weight)) < 1e-6)).alias("centred"),
        (F.abs(F.sum(one * two * weight)) < 1e-6).alias("orthogonal"),
        ((F.abs(F.sum(one * one * weight) - 1) < 1e-6) & (F.abs(F.sum(two * two * weight) - 1) < 1e-6)).alias("of_length_one"),
        F.lit(max(off) < 0.1).alias("near_eigenvectors"), F.lit(bool(values[0] >= values[1] > 0.5)).alias("leading"),
    )


def group_profiles(spark, sf_dir):
    profiles = ft.group_profiles(table(spark, sf_dir, "embeddings"), "label", "embedding", VECTOR_SIZE)
    return profiles.withColumn("mean", F.round("mean", 7))


def nearest_reference_lsh(spark, sf_dir):
    """Every twentieth cell looks for its three nearest among all; how many it finds is measured by the exact search."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    asked = vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    known = vectors.withColumnRenamed("vec_id", "ref_id")
    # Small buckets, so that a small table has many of them as well.
    found = materialize(nearest_lsh.nearest_references_lsh(asked, known, k=3, bucket_rows=128), "found")
    exact = nearest.nearest_references(asked, known, k=3).select("query_id", "rank", F.col("distance2").alias("least"))
    # Equal distances are equally near.
    met = exact.join(found, ["query_id", "rank"], "left").withColumn("hit", F.coalesce(F.col("distance2") <= F.col("least") * (1 + 1e-9), F.lit(False)))
    return met.agg(
        F.count_distinct("query_id").alias("n_queries"), F.count("*").alias("n_nearest"),
        (F.avg(F.col("hit").cast("int")) >= 0.9).alias("recalled"),
        F.every(F.coalesce(F.col("distance2") >= F.col("least") * (1 - 1e-9), F.lit(True))).alias("none_nearer"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        prefix_columns, join_cell_parts, attach_compounds, merge_frames, reduce_experiment, reduce_features,
        nearest_reference, nearest_reference_lsh, embed_cells, group_profiles,
    )
}

_SQL_CELLS = f"""cells AS (
  SELECT vec_id, embedding, label, {sql_well('label * 8 + vec_id % 8')} AS "Metadata_Well", (vec_id % 4 + 1)::INTEGER AS "Metadata_Site"
  FROM embeddings)"""


def _values(offset: int, prefix: str) -> str:
    return ", ".join(f'embedding[{offset + i + 1}]::DOUBLE AS "{prefix}f{i}"' for i in range(PART_SIZE))


ORACLE = {
    "prefix_columns": f"""WITH {_SQL_CELLS}
      SELECT "Metadata_Well", "Metadata_Site" AS "nucleus_Metadata_Site", vec_id AS "ObjectNumber", {_values(0, 'nucleus_')} FROM cells""",
    "join_cell_parts": f"""WITH {_SQL_CELLS}
      SELECT "Metadata_Well", "Metadata_Site", vec_id AS "ObjectNumber", {_values(0, 'nucleus_')},
             vec_id + 1000000 AS "cytoplasm_ObjectNumber", {_values(PART_SIZE, 'cytoplasm_')} FROM cells WHERE embedding[1] > 0""",
    "attach_compounds": f"""WITH {_SQL_CELLS}
      SELECT vec_id AS "ObjectNumber", "Metadata_Well", CASE WHEN label <> 9 THEN 'c' || label END AS compound,
             CASE WHEN label <> 9 THEN label % 2 = 0 END AS is_reference, embedding[1]::DOUBLE AS nucleus_f0
      FROM cells WHERE embedding[1] > 0""",
    "merge_frames": f"""WITH {_SQL_CELLS}
      SELECT 'nucleus' AS stem, vec_id AS "ObjectNumber", "Metadata_Site", {_values(0, '')} FROM cells
      UNION ALL SELECT 'cytoplasm', vec_id + 1000000, "Metadata_Site", {_values(PART_SIZE, '')} FROM cells WHERE embedding[1] > 0""",
    "reduce_features": """SELECT count(*) AS n, count(*) AS placed, true AS centred, true AS uncorrelated, true AS falling
      FROM embeddings""",
    "reduce_experiment": f"""WITH {_SQL_CELLS}
      SELECT vec_id AS "ObjectNumber", "Metadata_Well", CASE WHEN label <> 9 THEN 'c' || label END AS compound, true AS placed
      FROM cells WHERE embedding[1] > 0""",
    "nearest_reference": """WITH values AS (
        SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
      profiles AS (SELECT label, list(m ORDER BY i) AS profile FROM (SELECT label, i, avg(v) AS m FROM values GROUP BY ALL) GROUP BY label),
      d AS (
        SELECT vec_id AS query_id, p.label::BIGINT AS ref_id,
               list_sum(list_transform(range(1, 65), lambda i: pow(embedding[i]::DOUBLE - profile[i], 2))) AS distance2
        FROM embeddings, profiles p),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance2, ref_id) AS rank FROM d)
      SELECT query_id, ref_id, round(distance2, 6) AS distance2, rank::INTEGER AS rank FROM ranked WHERE rank <= 3""",
    "nearest_reference_lsh": """SELECT count(*) AS n_queries, 3 * count(*) AS n_nearest, true AS recalled, true AS none_nearer
      FROM embeddings WHERE vec_id % 20 = 0""",
    "embed_cells": """SELECT count(*) AS n, count(*) AS placed, true AS centred, true AS orthogonal, true AS of_length_one,
        true AS near_eigenvectors, true AS leading FROM embeddings""",
    "group_profiles": """SELECT label, pos, round(avg(v), 7) AS mean FROM (
        SELECT label, (generate_subscripts(embedding, 1) - 1)::INTEGER AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings)
      GROUP BY label, pos""",
}
