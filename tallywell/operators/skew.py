"""Bounding the rows of a group that must be handled together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.storage import materialize


def split_hot_groups(
    df: DataFrame, keys: Sequence[str], spread_by: Sequence[str], max_rows: int, name: str = "part"
) -> DataFrame:
    """Add ``part``: 0 for groups of up to ``max_rows`` rows, a hash part for larger ones.

    No row is dropped: a larger group is dealt out over ceil(n / max_rows) parts by
    the hash of ``spread_by``. Group sizes are counted first. Usually no group is
    too large and the rows need no join at all; otherwise the large keys are a
    stored table, which Spark broadcasts only if its files are small enough.
    """
    key_names = [f"_h{i}" for i in range(len(keys))]
    hot = materialize(
        df.groupBy(*[F.col(c).alias(k) for c, k in zip(keys, key_names)])
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > max_rows)
        .select(*key_names, F.ceil(F.col("_n") / max_rows).alias("_parts")),
        "hot-groups",
    )
    if hot.isEmpty():
        return df.withColumn(name, F.lit(0))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(keys, key_names)]
    part = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_parts")), F.lit(0)).cast("int")
    return df.join(hot, same, "left").select(*df.columns, part.alias(name))
