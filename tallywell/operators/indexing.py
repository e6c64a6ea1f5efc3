"""Gap-free row numbers without gathering rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.storage import materialize

_BLOCK_BITS = 33  # monotonically_increasing_id: partition number above, row number within below


def index_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "idx", within: Sequence[str] = (), spread_ties: bool = True
) -> DataFrame:
    """Add a 0-based rank in ``order_by``, over all rows or restarting for each value of ``within``.

    The rows are range-sorted and stamped with (partition, position) in one pass and
    written once. Partition sizes then give each partition its offset: that table
    has one row per partition, so it is the only thing ranked in a single task and
    the only thing broadcast. A hot ``within`` key spans several partitions like
    any other run of rows; its rank is the global rank minus the key's first one, found from one row per key and partition. Ties are
    ordered by a hash of the row, so that many of them are spread as well; a frame with a map
    column needs ``spread_ties=False``.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in (*within, *order_by)]
    if spread_ties:
        order.append(F.xxhash64(*df.columns))
    stamped = df.orderBy(*order).withColumn("_stamp", F.monotonically_increasing_id())
    fixed = materialize(stamped, "index").withColumn("_block", F.shiftright("_stamp", _BLOCK_BITS))

    sizes = fixed.groupBy("_block").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))

    position = F.col("_stamp").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1))
    if not within:
        indexed = fixed.join(F.broadcast(offsets), "_block").withColumn(name, F.col("_offset") + position)
        return indexed.select(*df.columns, name)

    # A key's rows in one partition are a run; rows meet their own run, so a hot key is spread like the partitions it fills.
    keys = [f"_k{i}" for i in range(len(within))]
    runs = fixed.groupBy("_block", *[F.col(c).alias(k) for c, k in zip(within, keys)]).agg(F.min(position).alias("_first"))
    placed = runs.join(F.broadcast(offsets), "_block")
    first = F.min(F.col("_offset") + F.col("_first")).over(Window.partitionBy(*keys))
    shifts = placed.select(F.col("_block").alias("_run"), *keys, (F.col("_offset") - first).alias("_shift"))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(within, keys)]
    ranked = fixed.join(shifts, [F.col("_block") == F.col("_run"), *same])
    return ranked.select(*df.columns, (position + F.col("_shift")).alias(name))


def sum_before(df: DataFrame, order_by: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before each one in ``order_by`` (unique), 0 for the first.

    Rows are range-sorted and stored, summed within their partition, and the sums of the partitions before are added:
    those are the only thing that one task orders.
    """
    stamped = df.orderBy(*order_by).withColumn("_stamp", F.monotonically_increasing_id())
    fixed = materialize(stamped, "sums").withColumn("_block", F.shiftright("_stamp", _BLOCK_BITS))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = fixed.groupBy("_block").agg(F.sum(value).alias("_sum"))
    offsets = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_block").orderBy("_stamp").rowsBetween(Window.unboundedPreceding, -1)
    own = fixed.withColumn("_own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = own.join(F.broadcast(offsets), "_block")
    return joined.select(*df.columns, (F.col("_offset") + F.col("_own")).alias(name))


def index_file_lines(lines: DataFrame, name: str = "idx") -> DataFrame:
    """Global line number for lines with (file, block, seq), see ``scan_lines_with_position``.

    Only the sizes of the file blocks are ordered; the lines themselves are not moved.
    """
    fixed = materialize(lines, "lines")
    blocks = fixed.groupBy("file", "block").agg(F.count("*").alias("_size"), F.min("seq").alias("_first"))
    offsets = sum_before(blocks, ["file", "block"], "_size", "_offset").drop("_size")
    indexed = fixed.join(offsets, ["file", "block"])
    return indexed.select(*lines.columns, (F.col("_offset") + F.col("seq") - F.col("_first")).alias(name))


def zip_columns(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Put two frames side by side by position; the longer one's surplus rows get nulls.

    Columns of ``right`` whose name is taken get the suffix ``_2``.
    """
    renamed = {c: f"{c}_2" if c in left.columns else c for c in right.columns}
    a = index_rows(left, left_order, "_pos")
    b = index_rows(right, right_order, "_pos").withColumnsRenamed(renamed)
    return a.join(b, "_pos", "full").drop("_pos")
