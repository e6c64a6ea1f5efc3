"""Per-cell feature tables: merge, join, reduce, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import names
from tallywell.functions.checks import keep_checked, require
from tallywell.operators.tabular import prefix_columns
from tallywell.sources.tables import scan_by_suffix, union_frames
from tallywell.storage import materialize

METADATA = ("Metadata_Well", "Metadata_Site")
ROOT = "nucleus"
ROOT_KEY = "ObjectNumber"
PARENT = "Parent_nucleus"


def _unexpected(name: str) -> Column:
    return F.concat(F.lit("unexpected file name "), F.col(name))


def route_result_files(files: DataFrame, name: str = "filename", strict: bool = True) -> DataFrame:
    """Add ``route`` (merge or skip); any other file is an error, or ``unexpected`` when not strict."""
    routed = files.withColumn("route", names.result_route(F.col(name)))
    if strict:
        routed = require(routed, F.col("route") != "unexpected", _unexpected(name))
    return routed


def stored_key(file_path: Column) -> Column:
    """``project/plate/batch/file`` of a scanned file's URI; a file written as a folder counts as one."""
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(decoded, r"((?:[^/]+/){3}[^/]+\.(?:csv|parquet))(?:/[^/]*)?$", 1)


def merge_frames(
    spark: SparkSession, root: str, folders: str, files: DataFrame, schemas: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """One frame per file stem, from the recorded result files below ``root/folders``.

    ``folders`` is a glob over ``project/plate/batch`` that keeps the listing to one
    experiment; the record of files stays a DataFrame and is applied as a
    semi-join on the file's key, so neither file list nor content passes the driver. A recorded file
    that is not there, or outside ``folders``, is an error.
    """
    route = F.col("route")
    routed = route_result_files(files, strict=False)
    routed = keep_checked(routed, route == "merge", route == "skip", _unexpected("filename"))
    routed = routed.select(F.col("s3path").alias("_key")).distinct()
    frames = {}
    missing = routed
    for stem in names.MERGED_STEMS:
        found = []
        for suffix in names.RESULT_SUFFIXES:
            path = f"{root}/{folders}/{stem}{suffix}"
            try:
                frame = scan_by_suffix(spark, [path], (schemas or {}).get(stem))
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            columns = frame.columns
            listed = spark.read.format("binaryFile").load(path)  # the content is not read
            stored = listed.select(stored_key(F.col("_metadata.file_path")).alias("_key")).distinct()
            missing = missing.join(stored, "_key", "left_anti")
            keyed = frame.withColumn("_key", stored_key(F.col("_metadata.file_path")))
            found.append(keyed.join(routed, "_key", "left_semi").select(*columns))
        if found:
            frames[stem] = union_frames(found)
    gone = [r["_key"] for r in missing.orderBy("_key").limit(5).collect()]
    if gone:
        raise FileNotFoundError(f"recorded result files are missing: {', '.join(gone)}")
    return frames


def cell_part_columns(frame: DataFrame, part: str) -> DataFrame:
    """Prefix the columns with the part's name; metadata and the root's object number keep theirs."""
    keep = [*METADATA, ROOT_KEY] if part == ROOT else list(METADATA)
    return prefix_columns(frame, part, keep)


def join_cell_parts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per cell: every other part joined to its nucleus."""
    cells = cell_part_columns(frames[ROOT], ROOT)
    for part, frame in frames.items():
        if part == ROOT:
            continue
        other = cell_part_columns(frame, part).withColumnRenamed(f"{part}_{PARENT}", ROOT_KEY)
        cells = cells.join(other, [*METADATA, ROOT_KEY])
    return cells


def attach_compounds(cells: DataFrame, layout: DataFrame, well: str = "Metadata_Well") -> DataFrame:
    """Cells with the compound of their well; null for wells the layout lacks."""
    return cells.join(layout.withColumnRenamed("well", well), well, "left")


def feature_columns(cells: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Floating-point columns; keys and labels are not features."""
    return [f.name for f in cells.schema if f.dataType.typeName() in ("double", "float") and f.name not in exclude]


def reduce_features(cells: DataFrame, features: Sequence[str], k: int = 2, prefix: str = "component") -> DataFrame:
    """Principal components of the standardised features.

    Fitting aggregates a features x features matrix. The features are one array column, so the plan does not
    grow with their number. A component's sign is set so that its largest loading is positive. Rows with a missing
    feature are kept, with null components.
    """
    with_values = cells.withColumn("_values", F.array(*[F.col(f"`{c}`").cast("double") for c in features]))
    usable = ~F.exists("_values", lambda x: x.isNull() | F.isnan(x))
    vectors = with_values.where(usable).select(array_to_vector("_values").alias("v"))
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vectors)
    loadings = PCA(k=k, inputCol="s", outputCol="p").fit(scaler.transform(vectors)).pc.toArray()

    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    centred = F.zip_with("_values", F.lit(mean.tolist()), lambda x, m: x - m)
    out = []
    for j in range(k):
        weights = loadings[:, j]
        if weights[abs(weights).argmax()] < 0:
            weights = -weights
        scale = [float(w / d) if d > 0 else 0.0 for w, d in zip(weights, std)]
        component = F.aggregate(F.zip_with(centred, F.lit(scale), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
        out.append(F.when(usable, component).alias(f"{prefix}_{j + 1}"))
    return with_values.select(*[F.col(f"`{c}`") for c in cells.columns], *out)


def group_profiles(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """(key, pos, mean): the mean vector of each group; a vector of another size fails the job.

    Averaged by position, in part before the shuffle: the plan is the same for vectors of any size.
    """
    other = F.concat(F.lit(f"expected a vector of {size}, got "), F.size(vector).cast("string"))
    checked = require(df, F.size(vector) == size, other)
    elements = checked.select(key, F.posexplode(vector).alias("pos", "value"))
    return elements.groupBy(key, "pos").agg(F.avg(F.col("value").cast("double")).alias("mean"))


def reduce_experiment(
    spark: SparkSession, root: str, folders: str, files: DataFrame, layout: DataFrame, k: int = 2
) -> DataFrame | None:
    """All cells of an experiment's recorded files with compound and ``k`` components; None without files."""
    frames = merge_frames(spark, root, folders, files)
    if ROOT not in frames:
        return None
    # Fitting reads the cells twice and projecting once more, so the joins are done once and stored.
    cells = materialize(attach_compounds(join_cell_parts(frames), layout), "cells")
    return reduce_features(cells, feature_columns(cells), k)
