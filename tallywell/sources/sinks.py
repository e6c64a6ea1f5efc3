"""Report and table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.sources.tables import scan_csv_typed
from tallywell.storage import write_partitioned


def report_lines(counts: DataFrame, key: str = "key", count: str = "count", pct: str = "pct") -> DataFrame:
    """``key<TAB>count<TAB>(pct% of total)`` lines, sorted by key."""
    line = F.format_string("%s\t%d\t(%6.2f%% of total)", F.col(key), F.col(count), F.col(pct))
    return counts.orderBy(key).select(line.alias("value"))


def write_report(counts: DataFrame, path: str, mode: str = "errorifexists", **columns: str) -> None:
    """Write the report as text; by default the folder must not exist yet."""
    report_lines(counts, **columns).write.mode(mode).text(path)


def csv_to_parquet(
    spark: SparkSession, csv_path: str, schema: str, target: str, by: Sequence[str], mode: str = "errorifexists"
) -> None:
    """Convert typed CSV files to Parquet below ``target``, one folder level per column in ``by``."""
    write_partitioned(scan_csv_typed(spark, csv_path, schema), target, list(by), mode)
