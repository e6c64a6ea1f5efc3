"""Line-oriented text sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions.numbers import integer_or_null
from tallywell.functions.text import strip


def scan_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line (``value``); a path may be a file, a folder or a glob."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def scan_glob(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Lines of every file below ``root`` whose name matches ``pattern``, as one data set."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root)


def scan_lines_with_position(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with (file, block, seq): a key that sorts in file-name, then line order.

    A text split never spans files, and inside a task rows come in file order, so
    no shuffle is needed to fix the order.
    """
    return scan_lines(spark, path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def scan_key_counts(lines: DataFrame) -> DataFrame:
    """(key, count) from ``key<TAB>count[<TAB>...]`` lines; rows without an integer count are dropped."""
    fields = F.split(strip(F.col("value")), "\t", -1)
    return lines.select(
        F.get(fields, F.lit(0)).alias("key"), integer_or_null(strip(F.get(fields, F.lit(1)))).alias("count")
    ).where(F.col("count").isNotNull())


def parse_share_lines(lines: DataFrame) -> DataFrame:
    """(word, count, pct) from ``word count (pct% of total)`` lines."""
    pattern = r"^(\S+)\s+(\d+)\s+\(\s*([0-9.]+)% of total\)$"
    line = strip(F.col("value"))
    return lines.where(line.rlike(pattern)).select(
        F.regexp_extract(line, pattern, 1).alias("word"),
        F.regexp_extract(line, pattern, 2).cast("bigint").alias("count"),
        F.regexp_extract(line, pattern, 3).cast("double").alias("pct"),
    )
