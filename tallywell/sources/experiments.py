"""Experiment metadata, image objects and the fixed dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import names, numbers
from tallywell.functions.checks import require
from tallywell.schemas import EXPERIMENT

# Imaging channels (name, is_fluorescence, wavelength in nm, is_brightfield, brightfield type).
CHANNELS = (
    ("BF full", False, None, True, "full"),
    ("BF right half", False, None, True, "right half"),
    ("BF left half", False, None, True, "left half"),
    ("Fluorescence 405 nm Ex", True, 405, False, None),
    ("Fluorescence 488 nm Ex", True, 488, False, None),
    ("Fluorescence 560 nm Ex", True, 560, False, None),
    ("Fluorescence 638 nm Ex", True, 638, False, None),
    ("Fluorescence 730 nm Ex", True, 730, False, None),
)

# Plate types (model, manufacturer, brand, wells, remark).
PLATE_TYPES = (("96-CO-3603", "Corning", "Costar", 96, "96 well plate with a flat bottom"),)

# Plate size -> wells per row.
PLATE_COLUMNS = {96: 12, 384: 24}

PLATE_SIZES = {model: wells for model, _, _, wells, _ in PLATE_TYPES}

# Required unit of each grid axis.
GRID_UNITS = {"x": "mm", "y": "mm", "z": "mm", "t": "s"}


def dim_channels(spark: SparkSession) -> DataFrame:
    """The eight imaging channels; small enough to broadcast by construction."""
    return spark.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(CHANNELS)],
        "id bigint, name string, is_fluorescence boolean, fluorescence_wavelength_nm int, "
        "is_brightfield boolean, brightfield_type string",
    )


def dim_plate_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(PLATE_TYPES)],
        "id bigint, model_name string, manufacturer string, brand string, num_wells int, other_info string",
    )


def well_grid(plates: DataFrame, num_wells: str = "num_wells") -> DataFrame:
    """One row per well of every plate in ``plates``; a plate size without a known layout is an error."""
    size = F.col(num_wells)
    columns = F.when(size.isNull(), F.raise_error(F.lit("unknown number of wells: null")))
    for wells, width in PLATE_COLUMNS.items():
        columns = columns.when(size == wells, width)
    columns = columns.otherwise(F.raise_error(F.concat(F.lit("unknown number of wells: "), size.cast("string"))))
    return (
        plates.withColumn("_columns", columns)
        .withColumn("_index", F.explode(F.sequence(F.lit(0), size - 1)))
        .withColumn("well_name", names.well_name(F.col("_index"), F.col("_columns")))
        .drop("_columns", "_index")
    )


def well_names(num_wells: int) -> list[str]:
    """Names of the wells of a plate of that size, row by row."""
    width = PLATE_COLUMNS[num_wells]
    return [f"{chr(65 + i // width)}{i % width + 1:02d}" for i in range(num_wells)]


def scan_experiments(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Experiment documents, one nested JSON object per file; the name is the last part of the output path."""
    documents = spark.read.schema(EXPERIMENT).option("multiLine", "true").option("mode", "FAILFAST").json(
        path if isinstance(path, str) else list(path)
    )
    return with_experiment_name(documents)


def with_experiment_name(documents: DataFrame) -> DataFrame:
    trimmed = F.regexp_replace("output_path", "/+$", "")
    return documents.withColumn("experiment_name", names.base_name(trimmed))


def unit_errors() -> Column:
    """Messages for the grid axes whose unit is not the required one."""
    checks = [
        F.when(
            ~F.col(f"grid_config.{axis}.unit").eqNullSafe(F.lit(unit)),
            F.concat(F.lit(f"{axis}: "), F.coalesce(F.col(f"grid_config.{axis}.unit"), F.lit("null"))),
        )
        for axis, unit in GRID_UNITS.items()
    ]
    return F.array_compact(F.array(*checks))


def validate_units(documents: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) documents; rejected ones carry ``unit_errors``. ``strict`` fails on the first one."""
    checked = documents.withColumn("unit_errors", unit_errors())
    bad = F.size("unit_errors") > 0
    if strict:
        message = F.concat(F.lit("wrong grid unit "), F.concat_ws(", ", "unit_errors"))
        return require(checked, ~bad, message).drop("unit_errors"), checked.limit(0)
    return checked.where(~bad).drop("unit_errors"), checked.where(bad)


def grid_columns() -> list[Column]:
    """Grid sizes and steps, with steps in the units of the experiment table."""
    grid = [F.col(f"grid_config.{axis}.N").alias(f"num_images_{axis}") for axis in GRID_UNITS]
    return [
        *grid,
        F.col("grid_config.x.d").alias("delta_x_mm"),
        F.col("grid_config.y.d").alias("delta_y_mm"),
        numbers.mm_to_um(F.col("grid_config.z.d")).alias("delta_z_um"),
        numbers.seconds_to_hours(F.col("grid_config.t.d")).alias("delta_t_h"),
    ]


def start_time(text: Column) -> Column:
    """Timestamp of ``2024-03-05_13.07.09``-style text."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd_HH.mm.ss"))


def scan_images(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Image objects: path, modification time, length and content, one row per file."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        path if isinstance(path, str) else list(path)
    )
