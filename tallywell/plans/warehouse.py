"""The experiment model: loads, lookups, progress, image sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.operators import image_sets as sets
from tallywell.operators import loads, progress, warehouse
from tallywell.operators.features import route_result_files as route_files
from tallywell.plans import standins as st
from tallywell.session import table
from tallywell.schemas import TABLES
from tallywell.sources import experiments as ex
from tallywell.sources.tables import union_frames
from tallywell.storage import append_rows, fresh_path, materialize
from tallywell.streaming.feed import read_or_empty


def _projects(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def _experiments(spark, sf_dir):
    path = F.concat("s_nationkey", F.lit("/"), "s_name", F.lit("/layout.csv"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("projectid"), F.col("s_name").alias("name"), path.alias("compound_layout_path")
    )


def _plate_type_wells(spark, sf_dir):
    return st.plate_wells(spark, sf_dir).select("id", F.lit(st.PLATE_TYPE).alias("plate_type"), "well_name")


def list_projects(spark, sf_dir):
    return warehouse.list_projects(_projects(spark, sf_dir))


def list_experiments(spark, sf_dir):
    return warehouse.list_experiments(_projects(spark, sf_dir), _experiments(spark, sf_dir), "NATION_3")


def lookup_layout(spark, sf_dir):
    projects, experiments = _projects(spark, sf_dir), _experiments(spark, sf_dir)
    named = experiments.join(projects.withColumnsRenamed({"id": "projectid", "name": "project"}), "projectid")
    project, experiment = named.select("project", "name").orderBy("name").first()
    return warehouse.lookup_layout(projects, experiments, project, experiment)


def validate_units(spark, sf_dir):
    _, rejected = ex.validate_units(st.experiment_documents(spark, sf_dir), strict=False)
    return rejected.select("project_name", "experiment_name", F.concat_ws("; ", "unit_errors").alias("errors"))


def parse_image_name(spark, sf_dir):
    parsed = warehouse.parse_images(st.image_files(spark, sf_dir))
    return parsed.drop("experiment", "seen")


def ingest_experiment(spark, sf_dir):
    documents = st.experiment_documents(spark, sf_dir)
    rows, _ = warehouse.ingest_experiments(documents, st.existing_experiments(spark, sf_dir), ex.dim_plate_types(spark))
    rows = materialize(rows, "new-experiments")  # read once per dimension and once more at the end
    dims = {}
    nations = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 0)
    stored_before = {
        "project_name": ("projectid", nations.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("project_name"))),
        "barcode": ("plateid", spark.createDataFrame([], "id bigint, barcode string")),
        "microscope": ("microscopeid", spark.createDataFrame([(1, "scope-0")], "id bigint, microscope string")),
        "objective": ("objectiveid", spark.createDataFrame([(1, "20x")], "id bigint, objective string")),
    }
    for column, (id_name, stored) in stored_before.items():
        new = warehouse.upsert_dimension(stored, rows, column)
        dims[column] = (stored.unionByName(new), column, id_name)
    rows = warehouse.with_surrogate_ids(rows, dims)
    rounded = [F.round(c, 9).alias(c) for c in ("delta_x_mm", "delta_y_mm", "delta_z_um", "delta_t_h")]
    return rows.select(
        "projectid", "name", "compound_layout_path", "plateid", "platetypeid", "microscopeid", "objectiveid",
        "num_images_x", "num_images_y", "num_images_z", "num_images_t", *rounded,
        F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
    )


def ingest_sites(spark, sf_dir):
    rows, _ = warehouse.ingest_sites(
        st.experiment_documents(spark, sf_dir), st.existing_experiments(spark, sf_dir), _plate_type_wells(spark, sf_dir)
    )
    return rows


def experiment_channels(spark, sf_dir):
    first = warehouse.new_experiments(st.experiment_documents(spark, sf_dir), st.existing_experiments(spark, sf_dir))
    rows, _ = warehouse.experiment_channels(first, ex.dim_channels(spark))
    return rows


def _files(spark, sf_dir):
    items = st.image_files(spark, sf_dir)
    return items.select(
        F.lit("screen").alias("project_name"), F.concat(F.lit("exp "), "experiment").alias("experiment_name"),
        F.lit(st.PLATE_TYPE).alias("plate_type"), "path",
    )


def ingest_images(spark, sf_dir):
    rows = warehouse.ingest_images(
        _files(spark, sf_dir), _plate_type_wells(spark, sf_dir), st.stored_channels(spark, sf_dir), st.plates(spark, sf_dir), "images"
    )
    columns = ["plateid", "s3path", "wellid", "experimentchannelid", "site", "site_x", "site_y", "site_z"]
    kept = [F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in columns]
    return rows.select("path", *kept, "reason")


def ingest_batch_results(spark, sf_dir):
    name = F.concat_ws("_", st.image_columns()["well"], F.concat(F.lit("s"), F.col("l_orderkey") % 5 + 1), F.lit("x0_nucleus"))
    results = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("experiment"),
        F.when(F.col("l_linenumber") == 1, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("batchid"),
        name.alias("name"),
    )
    return warehouse.ingest_batch_results(results, _sites(spark, sf_dir), st.batches(spark, sf_dir))


def ingest_batch_files(spark, sf_dir):
    # Files of batches, some recorded under a batch that is not there.
    files = st.batch_files(spark, sf_dir)
    lost = F.when(F.col("batchid") % 50 == 0, -F.col("batchid")).otherwise(F.col("batchid"))
    return warehouse.ingest_batch_files(files.withColumn("batchid", lost), st.batches(spark, sf_dir))


def stored_channel_rejects(spark, sf_dir):
    stored = warehouse.new_experiments(
        st.experiment_documents(spark, sf_dir), st.existing_experiments(spark, sf_dir)
    ).select("project_name", "experiment_name", F.explode(F.slice("channels_ordered", 1, 1)).alias("name"))
    return warehouse.stored_channel_rejects(st.experiment_documents(spark, sf_dir), stored)


def append_loads(spark, sf_dir):
    """Dimensions of the documents appended to their tables, twice: the second load finds everything stored."""
    root = fresh_path(spark, "model")
    documents = materialize(st.experiment_documents(spark, sf_dir).select("project_name", "microscope_name", "objective"), "documents")
    columns = {"projects": "project_name", "microscopes": "microscope_name", "objectives": "objective"}
    for _ in range(2):
        new = {}
        for name, column in columns.items():
            stored = read_or_empty(spark, f"{root}/{name}", T.StructType.fromDDL(TABLES[name]))
            new[name] = warehouse.upsert_dimension(stored, documents.select(F.col(column).alias("name")), "name")
        append_rows(new, root)
    tables = [spark.read.schema(TABLES[name]).parquet(f"{root}/{name}").withColumn("table_name", F.lit(name)) for name in columns]
    return union_frames(tables)


def append_facts(spark, sf_dir):
    """Documents of one region loaded first, then all of them, and both loads once more; what the second load has added."""
    model = loads.Model(spark, fresh_path(spark, "model"))
    documents = materialize(st.experiment_documents(spark, sf_dir), "documents")
    existing = st.existing_experiments(spark, sf_dir)
    first = documents.join(existing, ["project_name", "experiment_name"], "left_semi")
    for _ in range(2):
        for name, rows in (("one", first), ("two", documents)):
            loads.load_documents(model, name, rows, ex.dim_plate_types(spark), _plate_type_wells(spark, sf_dir), ex.dim_channels(spark))
    projects = model.read("projects").select(F.col("id").alias("projectid"), F.col("name").alias("project_name"))
    experiments = model.read("experiments").join(projects, "projectid").join(
        model.read("plates").select(F.col("id").alias("plateid"), "barcode"), "plateid"
    ).select(F.col("id").alias("experimentid"), "project_name", F.col("name").alias("experiment_name"), "barcode")
    experiments = experiments.join(existing, ["project_name", "experiment_name"], "left_anti")
    wells = model.read("experiment_wells").withColumnRenamed("id", "experiment_wellid").join(
        _plate_type_wells(spark, sf_dir).select(F.col("id").alias("wellid"), "well_name"), "wellid"
    )
    sites = model.read("experiment_well_sites").join(wells, "experiment_wellid")
    channels = model.read("experiment_imaging_channels").join(
        ex.dim_channels(spark).select(F.col("id").alias("channelid"), "name"), "channelid"
    )
    place = F.concat_ws("/", "site_x", "site_y", "site_z", "site_t")
    facts = (
        experiments.select("experimentid", F.lit("experiments").alias("table_name"), F.col("barcode").alias("what")),
        wells.select("experimentid", F.lit("experiment_wells").alias("table_name"), F.concat_ws("/", "well_name", "cell_line").alias("what")),
        sites.select("experimentid", F.lit("experiment_well_sites").alias("table_name"), F.concat_ws("/", "well_name", "site_id", place).alias("what")),
        channels.select("experimentid", F.lit("experiment_imaging_channels").alias("table_name"), F.concat_ws("/", "name", "imaging_order_index").alias("what")),
    )
    named = experiments.select("experimentid", "project_name", "experiment_name")
    return union_frames(list(facts)).join(named, "experimentid").drop("experimentid")


def upsert_dimension(spark, sf_dir):
    # Known names: those of the supplier side's first half of nations; offered: every part name and brand.
    stored = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.concat(F.lit("Brand#"), "n_nationkey").alias("name"))
    part = table(spark, sf_dir, "part")
    offered = part.select(F.col("p_brand").alias("name")).unionByName(part.select(F.col("p_name").alias("name")))
    return warehouse.upsert_dimension(stored, offered, "name")


def lookup_or_reject(spark, sf_dir):
    parsed = warehouse.parse_images(st.image_files(spark, sf_dir))
    wells = st.plate_wells(spark, sf_dir).select(F.col("well_name").alias("well"), F.col("id").alias("wellid"))
    return warehouse.lookup_with_reason(parsed.select("l_orderkey", "l_linenumber", "well"), wells, ["well"], ["wellid"])


def _sites(spark, sf_dir):
    return warehouse.site_table(st.stored_wells(spark, sf_dir), st.plate_wells(spark, sf_dir), st.stored_sites(spark, sf_dir))


def resolve_sites(spark, sf_dir):
    parsed = warehouse.parse_images(st.image_files(spark, sf_dir))
    return warehouse.resolve_sites(parsed.select("experiment", "well", "site", "l_orderkey"), _sites(spark, sf_dir))


def experiment_wells(spark, sf_dir):
    return warehouse.experiment_wells(st.stored_wells(spark, sf_dir), st.plate_wells(spark, sf_dir))


def _processed(spark, sf_dir):
    return progress.processed_sites(
        st.batch_sites(spark, sf_dir), _sites(spark, sf_dir), st.batches(spark, sf_dir), st.batch_files(spark, sf_dir)
    )


def processed_sites(spark, sf_dir):
    return _processed(spark, sf_dir)


def files_of_experiment(spark, sf_dir):
    found = warehouse.files_of_experiment(st.batch_files(spark, sf_dir), st.batches(spark, sf_dir), F.col("experiment") == 3)
    return found.select("s3path", "filename")


def route_result_files(spark, sf_dir):
    name = F.element_at(
        F.array(*[F.lit(n) for n in (*st.RESULT_FILES, "nucleus.tif", "nucleus.csv", "Image.csv")]), F.col("l_linenumber")
    )
    files = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", name.alias("filename"))
    return route_files(files, strict=False)


def site_scaffold(spark, sf_dir):
    return progress.site_scaffold(st.experiments(spark, sf_dir), experiment_wells(spark, sf_dir), _processed(spark, sf_dir))


def experiment_progress(spark, sf_dir):
    return progress.experiment_progress(st.experiments(spark, sf_dir), experiment_wells(spark, sf_dir), _processed(spark, sf_dir))


MATRIX_WELLS = ex.well_names(next(n for name, n in ex.PLATE_SIZES.items() if name == st.PLATE_TYPE))


def progress_matrix(spark, sf_dir):
    return progress.progress_matrix(site_scaffold(spark, sf_dir), MATRIX_WELLS)


def attach_coordinates(spark, sf_dir):
    parsed = warehouse.parse_images(st.image_files(spark, sf_dir))
    c = st.image_columns()
    # Coordinates were recorded for the sites of open, unreturned items.
    recorded = table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))
    coordinates = recorded.select(F.col("l_suppkey").alias("experiment"), c["well"].alias("well"), c["site"].cast("int").alias("site")).distinct().select(
        "*", (F.col("site") * 0.5).alias("x_mm"), (F.col("site") * 0.25).alias("y_mm"), (F.col("experiment") * 1.0).alias("z_um"),
        F.lit(None).cast("timestamp").alias("t"),
    )
    images = parsed.select("experiment", "l_orderkey", "l_linenumber", "well", "site")
    return warehouse.attach_coordinates(images, coordinates).drop("coord_t")


def next_batch_id(spark, sf_dir):
    # Customers as experiments, their orders as batches; some customers have none.
    experiments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("experiment"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("experiment"), F.col("o_orderkey").alias("batchid"))
    return warehouse.next_batch_id(experiments, orders)


def _stored_images(spark, sf_dir):
    """The image table that sets are formed from: the range split reads it twice, names are parsed once."""
    return materialize(warehouse.parse_images(st.image_files(spark, sf_dir)).drop("channel", "site_x", "site_y"), "images")


def image_sets(spark, sf_dir):
    return sets.image_sets(_stored_images(spark, sf_dir))


def files_by_name(spark, sf_dir):
    # The four names are hot groups.
    return sets.files_by_name(st.batch_files(spark, sf_dir))


def number_image_sets(spark, sf_dir):
    parsed = _stored_images(spark, sf_dir)
    next_ids = warehouse.next_batch_id(st.experiments(spark, sf_dir).select("experiment"), st.batches(spark, sf_dir))
    return sets.number_image_sets(parsed, next_ids, "seen")


_COUNTS = "n_images bigint, planes bigint"


def _measure(rows: pd.DataFrame) -> pd.DataFrame:
    """Images and planes of each set; sets of well A01 fail, those of A02 give nothing."""
    if (rows["well"] == "A01").any():
        raise ValueError("no cells")
    kept = rows[rows["well"] != "A02"].dropna(subset=list(sets.SET_KEY))
    starts = sets.set_starts(kept, sets.SET_KEY)  # the rows of a set come together
    planes = kept["site_z"]
    return kept[[*sets.SET_KEY]].iloc[starts].assign(
        n_images=np.diff(np.append(starts, len(kept))),
        planes=np.add.reduceat(planes.fillna(0).to_numpy(), starts) if len(starts) else planes,
    )


def _add_up(pieces: pd.DataFrame) -> pd.DataFrame:
    return pieces.groupby(list(sets.SET_KEY), as_index=False, sort=False)[["n_images", "planes"]].sum()


def map_image_sets(spark, sf_dir):
    images = _stored_images(spark, sf_dir).select("experiment", "well", "site", "path", "site_z")
    return sets.map_image_sets(images, _measure, _add_up, _COUNTS, _COUNTS)


def _lineage(spark, sf_dir, max_attempts=None):
    code = F.when(F.col("event_type") == "error", 137).when(F.col("event_type") == "purchase", 1).otherwise(0)
    attempts = table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 10).alias("experiment"), "user_id", "ts", code.alias("exit_code")
    )
    return sets.retry_lineage(attempts, ["user_id"], ["ts", "event_id"], max_attempts)


def retry_lineage(spark, sf_dir):
    return _lineage(spark, sf_dir).select("event_id", "user_id", "attempt", "status", "retry")


def retry_batches(spark, sf_dir):
    used = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("experiment"), F.col("event_id").alias("batchid"))
    next_ids = warehouse.next_batch_id(used.select("experiment").distinct(), used)
    return sets.next_attempts(_lineage(spark, sf_dir), next_ids, ["user_id"])


QUERIES = {
    f.__name__: f
    for f in (
        list_projects, list_experiments, lookup_layout, validate_units, parse_image_name, ingest_experiment,
        ingest_sites, experiment_channels, stored_channel_rejects, ingest_images, ingest_batch_results, ingest_batch_files,
        append_loads, append_facts, upsert_dimension, lookup_or_reject,
        resolve_sites, experiment_wells, processed_sites, files_of_experiment, route_result_files, site_scaffold,
        experiment_progress, progress_matrix, attach_coordinates, next_batch_id, image_sets, files_by_name,
        number_image_sets, map_image_sets, retry_lineage, retry_batches,
    )
}

_WELL_ID = """wells AS (SELECT DISTINCT p_partkey % 96 + 1 AS wellid, """ + st.sql_well("p_partkey % 96") + """ AS well FROM part)"""
_SCAFFOLD = f"""WITH {st.SQL_EXPERIMENTS}, {st.SQL_USED_WELLS}, {st.SQL_PROCESSED},
  expected AS (SELECT experiment, well_name, unnest(range(1, n + 1))::INTEGER AS site_id FROM used JOIN experiments USING (experiment)),
  flags AS (SELECT DISTINCT experiment, well_name, site_id, 1 AS f FROM processed),
  scaffold AS (
    SELECT experiment, well_name, site_id, coalesce(f, 0)::INTEGER AS processed
    FROM expected LEFT JOIN flags USING (experiment, well_name, site_id))"""
_NEXT = f"""{st.SQL_BATCHES}, next_ids AS (
  SELECT s_suppkey AS experiment, coalesce(max(batchid) + 1, 0) AS next_id
  FROM supplier LEFT JOIN batches ON s_suppkey = experiment GROUP BY s_suppkey)"""
_SITE_IDS = f"""{st.SQL_USED_WELLS}, sites AS (
  SELECT experiment, well_name AS well, s::INTEGER AS site, (experiment * 1000 + wi + 1) * 10 + s AS siteid
  FROM used, (SELECT unnest([1, 2, 3, 4]) AS s))"""

_ATTEMPTS = """a AS (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS attempt, event_type FROM events)"""

ORACLE = {
    "list_projects": "SELECT n_name AS name FROM nation",
    "list_experiments": "SELECT s_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_3'",
    "lookup_layout": """SELECT s_nationkey || '/' || s_name || '/layout.csv' AS compound_layout_path
      FROM supplier ORDER BY s_name LIMIT 1""",
    "validate_units": f"WITH {st.SQL_DOCUMENTS} SELECT project_name, experiment_name, 'z: um' AS errors FROM docs WHERE z_unit = 'um'",
    "parse_image_name": f"""WITH {st.SQL_IMAGES}
      SELECT l_orderkey, l_linenumber, path, well, site, site_x, site_y, site_z::INTEGER AS site_z, channel FROM files WHERE ok""",
    "ingest_experiment": f"""WITH {st.SQL_NEW_DOCUMENTS},
      good AS (SELECT * FROM new_docs WHERE plate_type = '96-CO-3603'),
      scopes AS (SELECT 1 AS id, 'scope-0' AS name UNION ALL
        SELECT row_number() OVER (ORDER BY microscope_name) + 1, microscope_name
        FROM (SELECT DISTINCT microscope_name FROM good WHERE microscope_name <> 'scope-0')),
      objectives AS (SELECT 1 AS id, '20x' AS name UNION ALL
        SELECT row_number() OVER (ORDER BY objective) + 1, objective FROM (SELECT DISTINCT objective FROM good WHERE objective <> '20x')),
      projects AS (
        SELECT (SELECT max(n_nationkey) FROM nation WHERE n_regionkey = 0) + row_number() OVER (ORDER BY project_name) AS id,
               project_name AS name FROM (SELECT DISTINCT project_name FROM good)),
      plates AS (SELECT row_number() OVER (ORDER BY plate_name) AS id, plate_name AS name FROM (SELECT DISTINCT plate_name FROM good))
      SELECT projects.id AS projectid, experiment_name AS name,
             project_name || '/' || experiment_name || '/layout.csv' AS compound_layout_path,
             plates.id AS plateid, 1::BIGINT AS platetypeid, scopes.id AS microscopeid, objectives.id AS objectiveid,
             nx AS num_images_x, ny AS num_images_y, nz AS num_images_z, nt AS num_images_t,
             0.5::DOUBLE AS delta_x_mm, 0.25::DOUBLE AS delta_y_mm, 3.0::DOUBLE AS delta_z_um, 1.5::DOUBLE AS delta_t_h,
             strftime(strptime(start_text, '%Y-%m-%d_%H.%M.%S'), '%Y-%m-%d %H:%M:%S') AS start_time
      FROM good JOIN scopes ON scopes.name = microscope_name JOIN objectives ON objectives.name = objective
           JOIN projects ON projects.name = project_name JOIN plates ON plates.name = plate_name""",
    "ingest_sites": f"""WITH {st.SQL_NEW_DOCUMENTS}, {_WELL_ID},
      listed AS (SELECT *, {st.sql_well('(k + i * 5) % 96')} AS well_name FROM (SELECT *, unnest(range(k % 7 + 3)) AS i FROM new_docs)),
      numbered AS (
        SELECT *, unnest(range(1, nx * ny * nz + 1))::INTEGER AS site_id FROM listed
        WHERE plate_type = '96-CO-3603' AND well_name IN (SELECT well FROM wells))
      SELECT project_name, experiment_name, well_name, cell_line, site_id, (site_id % nx)::INTEGER AS site_x,
             ((site_id // nx) % ny)::INTEGER AS site_y, ((site_id // (nx * ny)) % nz)::INTEGER AS site_z,
             ((site_id // (nx * ny * nz)) % nt)::INTEGER AS site_t FROM numbered""",
    "experiment_channels": f"""WITH {st.SQL_NEW_DOCUMENTS},
      listed AS (SELECT *, unnest(range(k % 4 + 1)) AS i FROM new_docs)
      SELECT project_name, experiment_name, list_extract({st.SQL_CHANNELS}, ((k + i) % 8 + 1)::INTEGER) AS name,
             i::INTEGER AS imaging_order_index, ((k + i) % 8 + 10)::DOUBLE AS exposure_time_ms, (k % 5)::DOUBLE AS analog_gain,
             ((k + i) % 8 * 2)::DOUBLE AS illumination_strength, (k + i) % 8 + 1 AS channelid FROM listed""",
    "ingest_images": f"""WITH {st.SQL_IMAGES}, {_WELL_ID},
      joined AS (
        SELECT path, file, 'images/screen/exp ' || experiment || '/' || file AS stored, wellid,
               experiment * 100 + list_position({st.SQL_CHANNELS}, channel) - 1 AS channelid, experiment + 5000 AS plateid,
               site, site_x, site_y, site_z::INTEGER AS site_z,
               CASE WHEN NOT ok THEN 'not an image name' WHEN wellid IS NULL THEN 'unknown well'
                    WHEN coalesce(list_position({st.SQL_CHANNELS}, channel), 0) IN (0, experiment % 8 + 1)
                    THEN 'unknown channel' END AS reason
        FROM files LEFT JOIN wells USING (well))
      SELECT path, CASE WHEN reason IS NULL THEN stored END AS s3path, CASE WHEN reason IS NULL THEN wellid END AS wellid,
             CASE WHEN reason IS NULL THEN plateid END AS plateid,
             CASE WHEN reason IS NULL THEN channelid END AS experimentchannelid, CASE WHEN reason IS NULL THEN site END AS site,
             CASE WHEN reason IS NULL THEN site_x END AS site_x, CASE WHEN reason IS NULL THEN site_y END AS site_y,
             CASE WHEN reason IS NULL THEN site_z END AS site_z, reason FROM joined""",
    "ingest_batch_results": f"""WITH {_SITE_IDS}, {st.SQL_BATCHES},
      asked AS (
        SELECT DISTINCT l_suppkey AS experiment, CASE WHEN l_linenumber = 1 THEN -l_orderkey ELSE l_orderkey END AS batchid,
               CASE WHEN l_partkey % 97 = 0 THEN 'Z99' ELSE {st.sql_well('l_partkey % 96')} END AS well,
               (l_orderkey % 5 + 1)::INTEGER AS site FROM lineitem)
      SELECT experiment, batchid, well, site, CASE WHEN status IS NOT NULL THEN siteid END AS siteid,
             CASE WHEN status IS NULL THEN 'unknown batch' WHEN siteid IS NULL THEN 'unknown site' END AS reason
      FROM asked LEFT JOIN batches USING (experiment, batchid) LEFT JOIN sites USING (experiment, well, site)""",
    "ingest_batch_files": f"""WITH {st.SQL_BATCH_FILES}
      SELECT experiment, CASE WHEN batchid % 50 = 0 THEN -batchid ELSE batchid END AS batchid, s3path, filename,
             CASE WHEN batchid % 50 = 0 AND batchid <> 0 THEN 'unknown batch' END AS reason FROM batch_files""",
    "stored_channel_rejects": f"""WITH {st.SQL_DOCUMENTS},
      listed AS (SELECT DISTINCT project_name, experiment_name, k, unnest(range(k % 4 + 1)) AS i FROM docs WHERE n_regionkey <> 0)
      SELECT project_name, experiment_name, list_extract({st.SQL_CHANNELS}, ((k + i) % 8 + 1)::INTEGER) AS name FROM listed WHERE i > 0
      UNION ALL SELECT DISTINCT project_name, experiment_name, 'X-ray' FROM docs WHERE n_regionkey <> 0 AND k % 37 = 1
      UNION ALL SELECT DISTINCT project_name, experiment_name, 'Custom' FROM docs WHERE n_regionkey <> 0 AND k % 41 = 2""",
    "append_loads": f"""WITH {st.SQL_DOCUMENTS},
      d AS (SELECT 'projects' AS table_name, project_name AS name FROM docs UNION SELECT 'microscopes', microscope_name FROM docs
            UNION SELECT 'objectives', objective FROM docs)
      SELECT table_name, row_number() OVER (PARTITION BY table_name ORDER BY name) AS id, name FROM d""",
    "upsert_dimension": """WITH offered AS (SELECT p_brand AS name FROM part UNION SELECT p_name FROM part)
      SELECT 24 + row_number() OVER (ORDER BY name) AS id, name FROM offered
      WHERE name NOT IN (SELECT 'Brand#' || n_nationkey FROM nation)""",
    "lookup_or_reject": f"""WITH {st.SQL_IMAGES}, {_WELL_ID}
      SELECT l_orderkey, l_linenumber, well, wellid, CASE WHEN wellid IS NULL THEN 'not found: ' || well END AS reason
      FROM images LEFT JOIN wells USING (well) WHERE ok""",
    "resolve_sites": f"""WITH {st.SQL_IMAGES}, {_SITE_IDS}
      SELECT experiment, well, site, l_orderkey, siteid FROM images LEFT JOIN sites USING (experiment, well, site) WHERE ok""",
    "experiment_wells": f"WITH {st.SQL_USED_WELLS} SELECT experiment, well_name FROM used",
    "processed_sites": f"WITH {st.SQL_PROCESSED} SELECT * FROM processed",
    "files_of_experiment": f"WITH {st.SQL_BATCH_FILES} SELECT s3path, filename FROM batch_files WHERE experiment = 3",
    "route_result_files": """SELECT l_orderkey, l_linenumber, filename,
        CASE WHEN regexp_full_match(filename, '(nucleus|cytoplasm)\\.(csv|parquet)') THEN 'merge'
             WHEN regexp_full_match(filename, '(Image|Experiment)\\.(csv|parquet)') THEN 'skip' ELSE 'unexpected' END AS route
      FROM (SELECT l_orderkey, l_linenumber, list_extract(['Experiment.parquet', 'Image.parquet', 'cytoplasm.parquet',
        'nucleus.parquet', 'nucleus.tif', 'nucleus.csv', 'Image.csv'], l_linenumber) AS filename FROM lineitem)""",
    "site_scaffold": f"{_SCAFFOLD} SELECT * FROM scaffold",
    "experiment_progress": f"""{_SCAFFOLD}
      SELECT experiment, count(*) AS total_sites, count(DISTINCT CASE WHEN processed = 1 THEN site_id END) AS num_registered_sites,
             sum(processed)::BIGINT AS registered_well_sites, sum(processed)::BIGINT AS num_processed_sites,
             floor(sum(processed) * 100.0::DOUBLE / count(*) + 0.5)::BIGINT AS percent_done
      FROM scaffold GROUP BY experiment""",
    "progress_matrix": f"{_SCAFFOLD} SELECT experiment, site_id, "
    + ", ".join(f"max(CASE WHEN well_name = '{w}' THEN processed END) AS {w}" for w in MATRIX_WELLS)
    + " FROM scaffold GROUP BY experiment, site_id",
    "attach_coordinates": f"""WITH {st.SQL_IMAGES},
      c AS (SELECT DISTINCT experiment, well, site, site * 0.5::DOUBLE AS coord_x_mm, site * 0.25::DOUBLE AS coord_y_mm,
                   experiment::DOUBLE AS coord_z_um FROM images WHERE returnflag = 'N' AND linestatus = 'O')
      SELECT experiment, l_orderkey, l_linenumber, well, site, coord_x_mm, coord_y_mm, coord_z_um
      FROM images LEFT JOIN c USING (experiment, well, site) WHERE ok""",
    "next_batch_id": """SELECT c_custkey AS experiment, coalesce(max(o_orderkey) + 1, 0) AS next_id
      FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "image_sets": f"""WITH {st.SQL_IMAGES}
      SELECT experiment, well, site, row_number() OVER (PARTITION BY experiment, well, site ORDER BY path) - 1 AS position, path
      FROM files WHERE ok""",
    "files_by_name": f"""WITH {st.SQL_BATCH_FILES}
      SELECT filename, row_number() OVER (PARTITION BY filename ORDER BY s3path) - 1 AS position, s3path FROM batch_files""",
    "number_image_sets": f"""WITH {st.SQL_IMAGES}, {_NEXT},
      s AS (SELECT experiment, well, site, count(*) AS n_images, min(seen) AS first FROM files WHERE ok GROUP BY ALL)
      SELECT experiment, well, site, n_images,
             next_id + row_number() OVER (PARTITION BY experiment ORDER BY first, well, site) - 1 AS batchid
      FROM s JOIN next_ids USING (experiment)""",
    "map_image_sets": f"""WITH {st.SQL_IMAGES}
      SELECT experiment, well, site, CASE WHEN well = 'A01' THEN 'failed' ELSE 'done' END AS status,
             CASE WHEN well = 'A01' THEN 'no cells' END AS error,
             CASE WHEN well NOT IN ('A01', 'A02') THEN count(*) END AS n_images,
             CASE WHEN well NOT IN ('A01', 'A02') THEN sum(site_z)::BIGINT END AS planes
      FROM images WHERE ok GROUP BY experiment, well, site""",
    "retry_lineage": f"""WITH {_ATTEMPTS}
      SELECT event_id, user_id, attempt,
             CASE event_type WHEN 'error' THEN 'failed.OOM(' || attempt || ')' WHEN 'purchase' THEN 'failed.1' ELSE 'done' END AS status,
             event_type = 'error' AS retry FROM a""",
    "retry_batches": f"""WITH {_ATTEMPTS},
      last AS (SELECT user_id, max(attempt) AS attempt FROM a GROUP BY user_id),
      waiting AS (SELECT a.* FROM a JOIN last USING (user_id, attempt) WHERE event_type = 'error'),
      next_ids AS (SELECT user_id % 10 AS experiment, max(event_id) + 1 AS next_id FROM events GROUP BY 1)
      SELECT experiment, user_id, attempt + 1 AS attempt,
             next_id + row_number() OVER (PARTITION BY experiment ORDER BY user_id) - 1 AS batchid
      FROM waiting JOIN next_ids ON experiment = user_id % 10""",
}

# Documents of an unknown plate type are left out whole.
ORACLE["append_facts"] = f"""WITH sites AS ({ORACLE['ingest_sites']}), channels AS ({ORACLE['experiment_channels']}),
      known AS (WITH {st.SQL_NEW_DOCUMENTS} SELECT project_name, experiment_name, plate_name FROM new_docs WHERE plate_type = '96-CO-3603')
    SELECT 'experiments' AS table_name, project_name, experiment_name, plate_name AS what FROM known
    UNION ALL SELECT DISTINCT 'experiment_wells', project_name, experiment_name, well_name || '/' || cell_line FROM sites
    UNION ALL SELECT 'experiment_well_sites', project_name, experiment_name,
      well_name || '/' || site_id || '/' || site_x || '/' || site_y || '/' || site_z || '/' || site_t FROM sites
    UNION ALL SELECT 'experiment_imaging_channels', project_name, experiment_name, name || '/' || imaging_order_index
      FROM channels SEMI JOIN known USING (project_name, experiment_name)"""
