"""Column-wise and group-wise reports on plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions.numbers import integer_text
from tallywell.functions.text import strip


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name, in any case; unknown names are ignored."""
    return df.drop(*names)


def cast_column(df: DataFrame, name: str, to: str = "float") -> DataFrame:
    """Replace a column by its cast; values that do not convert become null."""
    return df.withColumn(name, F.col(name).try_cast(to))


def schema_rows(df: DataFrame) -> DataFrame:
    """(position, name, type, non_null) of every column, with the filled cells counted in one pass."""
    counted = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("name"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, field in enumerate(df.schema)
    ]
    return counted.select(F.inline(F.array(*rows)))


def partition_rows(df: DataFrame) -> DataFrame:
    """(partition, n): rows in each input partition."""
    return df.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(F.count("*").alias("n"))


def count_at_max(df: DataFrame, column: str) -> DataFrame:
    """One row: the largest value and how many rows have it.

    Two column-pruned passes; grouping by a nearly unique value would shuffle it all.
    """
    top = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == top).agg(F.max(column).alias("max_value"), F.count("*").alias("n"))


def group_share(df: DataFrame, key: str) -> DataFrame:
    """(key, n, share) with the share taken of all rows; nulls form a group of their own."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    # The total adds up the groups, so it shares their aggregation instead of reading the rows again.
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.try_divide(F.col("n").cast("double"), total.cast("double")))


def top_groups_share(df: DataFrame, key: str, k: int = 20) -> DataFrame:
    """(key, share) of the ``k`` largest groups."""
    return group_share(df, key).orderBy(F.desc("n"), F.asc(key)).limit(k).drop("n")


def mode_where(df: DataFrame, condition: Column, key: str) -> DataFrame:
    """(key, n): the most frequent value among the rows that satisfy ``condition``; ties go to the smaller value."""
    counts = df.where(condition).groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(1)


def id_difference(left: DataFrame, right: DataFrame, column: str = "value") -> DataFrame:
    """Distinct integer ids of ``left`` that ``right`` lacks, as canonical digits of any length; other lines are ignored."""

    def ids(frame: DataFrame) -> DataFrame:
        return frame.select(integer_text(strip(F.col(column))).alias("id")).where(F.col("id").isNotNull()).distinct()

    # Repeats go before the join, so an id that fills a third of the lines is one row in it.
    return ids(left).join(ids(right), "id", "left_anti")


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Rename every column but ``keep`` to ``<prefix>_<name>``."""
    return df.select([F.col(c) if c in keep else F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares (slope, intercept) of y on x, over all rows or per group."""
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
