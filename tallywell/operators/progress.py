"""Progress of experiments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions.checks import require
from tallywell.functions.numbers import minutes_between, percent

_SITE = ["experiment", "well_name", "site_id"]


def expected_sites() -> F.Column:
    """Sites per well the report expects; unlike the stored sites it counts time points."""
    return F.col("num_images_x") * F.col("num_images_y") * F.col("num_images_z") * F.col("num_images_t")


def processed_sites(batch_sites: DataFrame, sites: DataFrame, batches: DataFrame, files: DataFrame) -> DataFrame:
    """(experiment, batchid, well_name, site_id) of processed sites, for all batches at once.

    Repeats are removed before the joins. A batch counts when it exists and has at least one result file. Both are existence tests, so
    sites are not multiplied by files.
    """
    key = ["experiment", "batchid"]
    stored = sites.select(F.col("id").alias("siteid"), "well_name", "site_id")
    return (
        batch_sites.select(*key, "siteid")
        .distinct()
        .join(batches.select(*key), key, "left_semi")
        .join(files.select(*key), key, "left_semi")
        .join(stored, "siteid")
        .select(*key, "well_name", "site_id")
    )


def site_scaffold(experiments: DataFrame, wells: DataFrame, processed: DataFrame) -> DataFrame:
    """(experiment, well_name, site_id, processed): every expected site with 0 or 1."""
    expected = (
        wells.select("experiment", "well_name").distinct()
        .join(experiments.select("experiment", expected_sites().alias("_n")), "experiment")
        .where(F.col("_n") > 0)
        .select("experiment", "well_name", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("site_id"))
    )
    flags = processed.select(*_SITE).distinct().withColumn("processed", F.lit(1))
    return expected.join(flags, _SITE, "left").withColumn("processed", F.coalesce("processed", F.lit(0)))


def experiment_progress(experiments: DataFrame, wells: DataFrame, processed: DataFrame) -> DataFrame:
    """Totals per experiment.

    The scaffold is not built for this: the total is wells times expected sites,
    and the processed sites are counted after removing repeats.
    ``num_registered_sites`` counts distinct site numbers, ``registered_well_sites``
    distinct (well, site).
    """
    wells_used = wells.select("experiment", "well_name").distinct()
    totals = wells_used.groupBy("experiment").agg(F.count("*").alias("_wells"))
    numbers = processed.select(*_SITE).distinct().groupBy("experiment", "site_id").agg(F.count("*").alias("_w"))
    done = numbers.groupBy("experiment").agg(F.sum("_w").alias("_done"), F.count("*").alias("_numbers"))
    zero = F.lit(0)
    joined = experiments.select("experiment", expected_sites().alias("_n")).join(totals, "experiment").join(
        done, "experiment", "left"
    )
    counted = joined.select(
        "experiment",
        (F.col("_wells") * F.col("_n")).alias("total_sites"),
        F.coalesce("_numbers", zero).alias("num_registered_sites"),
        F.coalesce("_done", zero).alias("registered_well_sites"),
        F.coalesce("_done", zero).alias("num_processed_sites"),
    )
    share = percent(F.col("num_processed_sites"), F.col("total_sites"))
    return counted.withColumn("percent_done", F.floor(share + 0.5))


def progress_matrix(scaffold: DataFrame, wells: Sequence[str]) -> DataFrame:
    """One row per (experiment, site), one 0/1 column per well in ``wells``; a well outside them fails the job."""
    outside = F.concat(F.lit("not a well of the plate: "), F.col("well_name"))
    scaffold = require(scaffold, F.col("well_name").isin(*wells), outside)
    return scaffold.groupBy("experiment", "site_id").pivot("well_name", list(wells)).agg(F.max("processed"))


def batch_list(batches: DataFrame, marks: DataFrame, initial: str = "registered") -> DataFrame:
    """(experiment, batchid, status, start_time, end_time) of all batches; ``marks`` as from ``fold_status``.

    A batch without marks has the initial status and no times.
    """
    key = ["experiment", "batchid"]
    told = marks.select(*key, "status", "start_time", "end_time")
    listed = batches.select(*key).distinct().join(told, key, "left")
    return listed.withColumn("status", F.coalesce("status", F.lit(initial)))


def throughput_report(batches: DataFrame, units: str, workers: str, start: str = "start", end: str = "end") -> DataFrame:
    """Duration in minutes, units per minute, and the same per worker."""
    minutes = minutes_between(F.col(start), F.col(end))
    rated = batches.withColumn("minutes", minutes)
    rated = rated.withColumn("units_per_minute", F.try_divide(F.col(units).cast("double"), F.col("minutes")))
    return rated.withColumn(
        "units_per_minute_per_worker", F.try_divide(F.col("units_per_minute"), F.col(workers).cast("double"))
    )
