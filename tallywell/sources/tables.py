"""CSV, Parquet and SQL sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv_header(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header row, every column a string.

    Naming the columns spares the extra read of the header line.
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false" if columns else "true")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    return reader.csv(path)


def scan_csv_typed(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with typed columns; without a schema the types are inferred, which reads the data twice."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema).option("mode", "FAILFAST") if schema else reader.option("inferSchema", "true")
    return reader.csv(path if isinstance(path, str) else list(path))


def scan_parquet(spark: SparkSession, path: str | Sequence[str], merge: bool = False) -> DataFrame:
    """Parquet files; ``merge`` unites the columns of files written with different ones."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths)


def scan_by_suffix(spark: SparkSession, paths: Sequence[str], schema: str | T.StructType | None = None) -> DataFrame:
    """One frame from ``.csv`` and ``.parquet`` paths, each kind read in one go; other suffixes are an error."""
    by_kind: dict[str, list[str]] = {".csv": [], ".parquet": []}
    for path in paths:
        kind = next((known for known in by_kind if path.rstrip("/").endswith(known)), None)
        if kind is None:
            raise ValueError(f"unknown file suffix: {path}")
        by_kind[kind].append(path)
    frames = []
    if by_kind[".csv"]:
        frames.append(scan_csv_typed(spark, by_kind[".csv"], schema))
    if by_kind[".parquet"]:
        frames.append(scan_parquet(spark, by_kind[".parquet"], merge=True))
    if not frames:
        raise ValueError("no paths given")
    return union_frames(frames)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-wise union by column name; a column a frame lacks is null in its rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def sql_query(spark: SparkSession, text: str, views: Mapping[str, DataFrame], **parameters: object) -> DataFrame:
    """Run ``text`` with named parameters (``:name``) and frames (``{name}``); nothing is pasted into the SQL."""
    return spark.sql(text, args=parameters or None, **views)


def preview_tables(tables: Mapping[str, DataFrame], n: int = 5) -> dict[str, DataFrame]:
    """First ``n`` rows of each table, in no particular order."""
    return {name: frame.limit(n) for name, frame in tables.items()}


def random_columns(df: DataFrame, names: Sequence[str] = ("a", "b", "c", "d"), seed: int = 0) -> DataFrame:
    """``df`` with one uniform [0, 1) column per name."""
    return df.select("*", *[F.rand(seed + i).alias(name) for i, name in enumerate(names)])
