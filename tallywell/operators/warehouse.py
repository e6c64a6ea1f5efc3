"""Lookups and loads of the experiment model, all set-based."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions import names, numbers
from tallywell.functions.checks import require
from tallywell.operators.indexing import index_rows
from tallywell.sources.experiments import grid_columns, start_time


def list_projects(projects: DataFrame) -> DataFrame:
    return projects.select("name")


def project_id(projects: DataFrame, project: str) -> Column:
    """Id of the project as a scalar subquery, which fails unless there is exactly one of that name."""
    return only_value(projects.where(F.col("name") == project), "id", f"project {project}").scalar()


def list_experiments(projects: DataFrame, experiments: DataFrame, project: str) -> DataFrame:
    """Experiment names of one project; an unknown project is an error."""
    return experiments.where(F.col("projectid") == project_id(projects, project)).select("name")


def only_value(rows: DataFrame, column: str, label: str) -> DataFrame:
    """One row with the single value of ``column``; none or several are an error."""
    return rows.agg(F.count("*").alias("_n"), F.max(column).alias("_v")).select(
        F.when(F.col("_n") == 1, F.col("_v"))
        .otherwise(F.raise_error(F.concat(F.lit(f"expected one {label}, got "), F.col("_n").cast("string"))))
        .alias(column)
    )


def find_experiment(projects: DataFrame, experiments: DataFrame, project: str, experiment: str) -> DataFrame:
    """The experiment rows with that name in that project."""
    return experiments.where((F.col("name") == experiment) & (F.col("projectid") == project_id(projects, project)))


def lookup_layout(projects: DataFrame, experiments: DataFrame, project: str, experiment: str) -> DataFrame:
    """One row: the compound layout path of the experiment."""
    found = find_experiment(projects, experiments, project, experiment)
    return only_value(found, "compound_layout_path", f"experiment {project}/{experiment}")


def lookup_with_reason(df: DataFrame, dimension: DataFrame, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    """``df`` with the columns ``take`` of a many-to-one lookup, and ``reason``: null, or why there is no match.

    One frame, so the join runs once. A key that the dimension holds more than once fails the job instead of
    multiplying rows.
    """
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in on])
    single = dimension.groupBy(*on).agg(*[F.first(c).alias(c) for c in take], F.count("*").alias("_n"))
    single = require(single, F.col("_n") == 1, F.concat(F.lit("more than one row for "), name))
    joined = df.join(single, list(on), "left")
    reason = F.when(F.col("_n").isNull(), F.concat(F.lit("not found: "), name))
    return joined.withColumn("reason", reason).drop("_n")


def lookup_or_reject(
    df: DataFrame, dimension: DataFrame, on: Sequence[str], take: Sequence[str], strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(matched, rejected) rows of a many-to-one lookup; ``strict`` fails on the first reject."""
    joined = lookup_with_reason(df, dimension, on, take)
    found = F.col("reason").isNull()
    if strict:
        return require(joined, found, F.col("reason")).drop("reason"), df.limit(0)
    return joined.where(found).drop("reason"), joined.where(~found).select(*df.columns)


def upsert_dimension(dimension: DataFrame, incoming: DataFrame, key: str, extra: Sequence[str] = ()) -> DataFrame:
    """Rows to append to ``dimension`` for the keys it lacks, each key once, with the next free ids."""
    columns = [F.min(c).alias(c) for c in extra]
    grouped = incoming.where(F.col(key).isNotNull()).groupBy(key)
    distinct = grouped.agg(*columns) if columns else incoming.where(F.col(key).isNotNull()).select(key).distinct()
    new = distinct.join(dimension.select(key), key, "left_anti")
    last = F.coalesce(dimension.agg(F.max("id")).scalar(), F.lit(0))
    return index_rows(new, [key]).select((F.col("idx") + 1 + last).alias("id"), key, *extra)


def next_batch_id(experiments: DataFrame, batches: DataFrame, experiment: str = "experiment") -> DataFrame:
    """(experiment, next_id): one above the largest batch id, 0 for an experiment without batches."""
    largest = batches.groupBy(experiment).agg(F.max("batchid").alias("_max"))
    return experiments.join(largest, experiment, "left").select(
        experiment, F.coalesce(F.col("_max") + 1, F.lit(0)).alias("next_id")
    )


def first_per_experiment(documents: DataFrame) -> DataFrame:
    """One document per (project, experiment): the earliest by its time stamp."""
    order = F.struct("timestamp", F.to_json(F.struct("*")))
    first = documents.groupBy("project_name", "experiment_name").agg(F.min_by(F.struct("*"), order).alias("_d"))
    return first.select("_d.*")


def new_experiments(documents: DataFrame, existing: DataFrame) -> DataFrame:
    """Documents of experiments not stored yet; ``existing`` has (project_name, experiment_name)."""
    return first_per_experiment(documents).join(existing, ["project_name", "experiment_name"], "left_anti")


def ingest_experiments(
    documents: DataFrame, existing: DataFrame, plate_types: DataFrame, layout_file: str = "layout.csv"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): experiment rows with natural keys, converted units and the layout path.

    A document with an unknown plate type is rejected. Experiments stored before are left alone.
    """
    types = plate_types.select(F.col("model_name").alias("plate_type"), F.col("id").alias("platetypeid"))
    matched, rejected = lookup_or_reject(new_experiments(documents, existing), types, ["plate_type"], ["platetypeid"])
    rows = matched.select(
        "project_name",
        F.col("experiment_name").alias("name"),
        names.join_path(F.col("project_name"), F.col("experiment_name"), F.lit(layout_file)).alias("compound_layout_path"),
        F.col("plate_name").alias("barcode"),
        "platetypeid",
        F.col("microscope_name").alias("microscope"),
        "objective",
        *grid_columns(),
        start_time(F.col("timestamp")).alias("start_time"),
    )
    return rows, rejected


def with_surrogate_ids(rows: DataFrame, dimensions: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Swap natural keys for ids: ``column -> (dimension, its key column, id column to add)``."""
    for column, (dimension, key, id_name) in dimensions.items():
        ids = dimension.select(F.col(key).alias(column), F.col("id").alias(id_name))
        rows = rows.join(ids, column, "left").drop(column)
    return rows


def ingest_sites(
    documents: DataFrame, existing: DataFrame, wells: DataFrame, zero_based: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(sites, rejected): every listed well times its sites, with grid positions, for new experiments.

    ``wells`` has (plate_type, well_name). Wells the plate type lacks are rejected.
    """
    listed = new_experiments(documents, existing).select(
        "project_name",
        "experiment_name",
        "plate_type",
        "cell_line",
        *[F.col(f"grid_config.{axis}.N").alias(f"n{axis}") for axis in "xyzt"],
        F.explode("well_list").alias("well_name"),
    )
    matched, rejected = lookup_or_reject(listed, wells, ["plate_type", "well_name"], [])
    count = F.col("nx") * F.col("ny") * F.col("nz")
    # sequence(1, 0) would count down, so an empty grid is kept out first.
    sites = matched.where(count > 0).withColumn("site_id", F.explode(F.sequence(F.lit(1), count)))
    grid = numbers.site_grid(*[F.col(c) for c in ("site_id", "nx", "ny", "nz", "nt")], zero_based=zero_based)
    rows = sites.select(
        "project_name", "experiment_name", "well_name", "cell_line", "site_id", F.inline(F.array(grid))
    )
    return rows, rejected.select("project_name", "experiment_name", "well_name")


def experiment_channels(documents: DataFrame, channels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): ordered channels of each experiment with the first configuration of that name.

    Both lists sit in the same document, so the match is made inside the row.
    """
    config = F.get(F.filter("channels_config", lambda c: c["Name"] == F.col("name")), F.lit(0))
    ordered = documents.select(
        "project_name", "experiment_name", "channels_config", F.posexplode("channels_ordered").alias("imaging_order_index", "name")
    ).withColumn("_config", config)
    listed = ordered.select(
        "project_name",
        "experiment_name",
        "name",
        "imaging_order_index",
        F.col("_config").isNotNull().alias("_configured"),
        F.col("_config.ExposureTime").alias("exposure_time_ms"),
        F.col("_config.AnalogGain").alias("analog_gain"),
        F.col("_config.IlluminationIntensity").alias("illumination_strength"),
    )
    dim = channels.select("name", F.col("id").alias("channelid"))
    joined = listed.join(dim, "name", "left")
    good = F.col("_configured") & F.col("channelid").isNotNull()
    rejected = joined.where(~good).select(
        "project_name",
        "experiment_name",
        "name",
        F.when(~F.col("_configured"), "no configuration").otherwise("unknown channel").alias("reason"),
    )
    return joined.where(good).drop("_configured"), rejected


def stored_channel_rejects(documents: DataFrame, channels: DataFrame) -> DataFrame:
    """(project_name, experiment_name, name): channels that documents of stored experiments ask for and that those lack.

    ``channels`` has (project_name, experiment_name, name) of the stored experiments; others are not looked at.
    """
    experiment = ["project_name", "experiment_name"]
    asked = documents.join(channels.select(*experiment).distinct(), experiment, "left_semi")
    listed = asked.select(*experiment, F.explode("channels_ordered").alias("name")).distinct()
    return listed.join(channels, [*experiment, "name"], "left_anti")


def resolve_sites(requests: DataFrame, sites: DataFrame, strict: bool = False) -> DataFrame:
    """(experiment, well, site) requests with the id of the stored site; null where there is none.

    ``strict`` fails on the first unknown site. Both outcomes stay in one frame, so the join runs once.
    """
    on = ["experiment", "well", "site"]
    stored = sites.select("experiment", F.col("well_name").alias("well"), F.col("site_id").alias("site"), F.col("id").alias("siteid"))
    joined = requests.join(stored, on, "left").select(*requests.columns, "siteid")
    if strict:
        key = F.concat_ws("/", *[F.col(c).cast("string") for c in on])
        joined = require(joined, F.col("siteid").isNotNull(), F.concat(F.lit("site not found: "), key))
    return joined


def site_table(experiment_wells: DataFrame, plate_wells: DataFrame, well_sites: DataFrame) -> DataFrame:
    """(id, experiment, well_name, site_id) of all stored sites, from the three tables that hold them."""
    wells = experiment_wells.select(
        F.col("id").alias("experiment_wellid"), F.col("experimentid").alias("experiment"), "wellid"
    ).join(plate_wells.select(F.col("id").alias("wellid"), "well_name"), "wellid")
    return well_sites.join(wells, "experiment_wellid").select("id", "experiment", "well_name", "site_id")


def experiment_wells(stored: DataFrame, plate_wells: DataFrame) -> DataFrame:
    """(experiment, well_name) of the wells used."""
    dim = plate_wells.select(F.col("id").alias("wellid"), "well_name")
    return stored.join(dim, "wellid").select(F.col("experimentid").alias("experiment"), "well_name")


def parse_images(files: DataFrame, path: str = "path", strict: bool = False) -> DataFrame:
    """Image files with the fields of their names; other files are left out, or an error when ``strict``.

    The parts are made by a generator: a filter beside it can't be moved in front, where the pattern would run once more.
    """
    parts = F.array(names.image_parts(F.col(path)))
    if strict:
        checked = files.withColumn("_parts", F.explode(parts))
        split = require(checked, F.col("_parts").isNotNull(), F.concat(F.lit("not an image name: "), F.col(path)))
    else:
        split = files.withColumn("_parts", F.explode(F.array_compact(parts)))
    return split.select(*files.columns, *names.image_fields(F.col("_parts")))


def unnamed_images(files: DataFrame, path: str = "path") -> DataFrame:
    """Files whose name is not that of an image."""
    return files.where(names.image_parts(F.col(path)).isNull())


def ingest_images(
    files: DataFrame, wells: DataFrame, channels: DataFrame, plates: DataFrame, bucket: str, path: str = "path"
) -> DataFrame:
    """Image rows with storage path, plate, well and channel ids, and ``reason``: null, or why the row is rejected.

    ``files`` has (project_name, experiment_name, plate_type, path); ``channels`` the channels of each experiment (id,
    project_name, experiment_name, name), so one that the experiment lacks is rejected; ``plates`` the plate of each
    experiment (project_name, experiment_name, plateid).
    """
    experiment = ["project_name", "experiment_name"]
    split = files.withColumn("_parts", F.explode(F.array(names.image_parts(F.col(path)))))
    parsed = split.select(*files.columns, *names.image_fields(F.col("_parts")))
    stored = names.join_path(
        F.lit(bucket), F.col("project_name"), F.col("experiment_name"), names.sanitize(names.base_name(F.col(path)))
    )
    well_dim = wells.select("plate_type", F.col("well_name").alias("well"), F.col("id").alias("wellid"))
    channel_dim = channels.select(*experiment, F.col("name").alias("channel"), F.col("id").alias("experimentchannelid"))
    joined = (
        parsed.join(well_dim, ["plate_type", "well"], "left")
        .join(channel_dim, [*experiment, "channel"], "left")
        .join(plates.select(*experiment, "plateid"), experiment, "left")
    )
    reason = (
        F.when(F.col("well").isNull(), "not an image name")
        .when(F.col("plateid").isNull(), "unknown experiment")
        .when(F.col("wellid").isNull(), "unknown well")
        .when(F.col("experimentchannelid").isNull(), "unknown channel")
    )
    return joined.select(
        *experiment, path, "plateid", stored.alias("s3path"), "well", "wellid", "channel", "experimentchannelid",
        "site", "site_x", "site_y", "site_z", F.lit(1).alias("site_t"), reason.alias("reason"),
    )


def attach_coordinates(images: DataFrame, coordinates: DataFrame, on: Sequence[str] = ("experiment", "well", "site")) -> DataFrame:
    """Images with their stage coordinates; null where none were recorded."""
    taken = coordinates.select(
        *on, F.col("x_mm").alias("coord_x_mm"), F.col("y_mm").alias("coord_y_mm"),
        F.col("z_um").alias("coord_z_um"), F.col("t").alias("coord_t"),
    )
    return images.join(taken, list(on), "left")


def files_of_experiment(files: DataFrame, batches: DataFrame, condition: Column) -> DataFrame:
    """Result files of the batches that satisfy ``condition``."""
    wanted = batches.where(condition).select("experiment", "batchid")
    return files.join(wanted, ["experiment", "batchid"], "left_semi")


def ingest_batch_results(results: DataFrame, sites: DataFrame, batches: DataFrame) -> DataFrame:
    """(experiment, batchid, well, site, siteid, reason): sites a batch has processed, from its result rows.

    ``results`` has (experiment, batchid, name) with names ``<well>_s<site>_...``.
    Each (batch, site) comes once; ``reason`` is null, or why the row is rejected.
    """
    parsed = results.select("experiment", "batchid", F.inline(F.array(names.result_name(F.col("name"))))).distinct()
    known = batches.select("experiment", "batchid", F.lit(True).alias("_known"))
    resolved = resolve_sites(parsed.join(known, ["experiment", "batchid"], "left"), sites)
    reason = F.when(F.col("_known").isNull(), "unknown batch").when(F.col("siteid").isNull(), "unknown site")
    return resolved.select(
        "experiment", "batchid", "well", "site", F.when(F.col("_known"), F.col("siteid")).alias("siteid"), reason.alias("reason")
    )


def ingest_batch_files(files: DataFrame, batches: DataFrame) -> DataFrame:
    """(experiment, batchid, s3path, filename, reason): result files of batches, each path once.

    ``reason`` is null, or why the row is rejected.
    """
    key = ["experiment", "batchid", "_spread"]
    lost = F.col("experiment").isNull() | F.col("batchid").isNull()

    def keyed(rows: DataFrame, *columns: str) -> DataFrame:
        # Rows without a key have no partner; they are spread by what they hold.
        return rows.withColumn("_spread", F.coalesce(F.when(lost, F.xxhash64(*columns)), F.lit(0)))

    known = keyed(batches.select("experiment", "batchid"), "experiment", "batchid").withColumn("_known", F.lit(True))
    # Dealt by the key of the join, so that the files move once for both.
    listed = keyed(files.select("experiment", "batchid", "s3path", "filename"), "s3path", "filename").repartition(*key).distinct()
    reason = F.when(F.col("_known").isNull(), "unknown batch")
    return listed.join(known, key, "left").withColumn("reason", reason).drop("_known", "_spread")
