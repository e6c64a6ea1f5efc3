"""Fixture data derived from the driver tables, once as DataFrames and once as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import names, text
from tallywell.session import table
from tallywell.sources.experiments import CHANNELS, PLATE_TYPES, with_experiment_name

CHANNEL_NAMES = [row[0] for row in CHANNELS]
PLATE_TYPE = PLATE_TYPES[0][0]

SQL_CHANNELS = "[" + ", ".join(f"'{name}'" for name in CHANNEL_NAMES) + "]"


def sql_well(index: str) -> str:
    return f"(chr(65 + (({index}) // 12)::INTEGER) || lpad((({index}) % 12 + 1)::VARCHAR, 2, '0'))"


# -- corpus ----------------------------------------------------------------------------------------


def doc_lines(spark: SparkSession, sf_dir: str, lang: str | None = None) -> DataFrame:
    """(doc_id, pos, line) of all documents, or of those in one language."""
    docs = table(spark, sf_dir, "documents")
    if lang:
        docs = docs.where(F.col("lang") == lang)
    return docs.select("doc_id", F.posexplode(text.lines_of(F.col("text"))).alias("pos", "line"))


def sql_lines(name: str, lang: str | None = None) -> str:
    where = f"WHERE lang = '{lang}'" if lang else ""
    return f"""{name} AS (
      SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS pos,
             unnest(string_split(text, chr(10))) AS line
      FROM documents {where})"""


# -- posts -----------------------------------------------------------------------------------------

REPOST = "CASE WHEN source = 'src0' THEN doc_id END"


def post_lines(spark: SparkSession, sf_dir: str, explicit_nulls: bool = False) -> DataFrame:
    """Documents as JSON lines; those of one source are reshares.

    Without ``explicit_nulls`` an original has no reshare key. With it, every
    second original has the key with a null.
    """
    docs = table(spark, sf_dir, "documents")
    reshare = F.when(F.col("source") == "src0", F.struct(F.col("doc_id").alias("id"))).alias("retweeted_status")
    body = F.struct("doc_id", "text", reshare)
    value = F.to_json(body)
    if explicit_nulls:
        value = F.when(F.col("doc_id") % 2 == 0, F.to_json(body, {"ignoreNullFields": "false"})).otherwise(value)
    return docs.select(value.alias("value"))


# -- images and batches ----------------------------------------------------------------------------


def image_columns() -> dict[str, Column]:
    index = F.col("l_partkey") % 96
    well = F.when(F.col("l_partkey") % 97 == 0, "Z99").otherwise(names.well_name(index, 12))
    site = F.col("l_orderkey") % 4 + 1
    channel = F.when(
        (F.col("l_linenumber") == 7) & (F.col("l_quantity") == 50), "Fluorescence 999 nm Ex"
    ).otherwise(F.element_at(F.array(*[F.lit(c) for c in CHANNEL_NAMES]), F.col("l_linenumber")))
    plane = F.col("l_quantity").cast("int") % 3
    z = F.when(plane == 0, "").otherwise(F.concat(F.lit("_z"), plane + 1))
    file = F.concat(
        well, F.lit("_s"), site, F.lit("_x"), site % 2, F.lit("_y"), F.floor(site / 2) % 2, z, F.lit("_"),
        F.replace(channel, F.lit(" "), F.lit("_")), F.lit(".tif"),
    )
    # Names that are no images: snapshots, and names without a channel.
    no_channel = F.concat(well, F.lit("_s"), site, F.lit("_x0_y0_.tif"))
    snapshot = F.concat(F.lit("snapshot-"), "l_orderkey", F.lit(".tif"))
    odd = F.when(F.col("l_orderkey") % 2 == 0, snapshot).otherwise(no_channel)
    file = F.when(F.col("l_tax") == 0.08, odd).otherwise(file)
    return {"index": index, "well": well, "site": site, "channel": channel, "file": file}


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(experiment, l_orderkey, l_linenumber, path, seen) per line item; some names are malformed."""
    c = image_columns()
    folder = F.concat(F.lit("/export/run "), F.col("l_orderkey") % 10, F.lit("/"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("experiment"), "l_orderkey", "l_linenumber", F.concat(folder, c["file"]).alias("path"),
        F.col("l_shipdate").alias("seen"),
    )


_SITE = "(l_orderkey % 4 + 1)"
_WELL = f"CASE WHEN l_partkey % 97 = 0 THEN 'Z99' ELSE {sql_well('l_partkey % 96')} END"
_CHANNEL = (
    "CASE WHEN l_linenumber = 7 AND l_quantity = 50 THEN 'Fluorescence 999 nm Ex' "
    f"ELSE list_extract({SQL_CHANNELS}, l_linenumber) END"
)
SQL_IMAGES = f"""images AS (
  SELECT l_suppkey AS experiment, l_orderkey, l_linenumber, {_WELL} AS well, {_SITE}::INTEGER AS site,
         ({_SITE} % 2)::INTEGER AS site_x, (({_SITE} // 2) % 2)::INTEGER AS site_y,
         CASE WHEN l_quantity::INTEGER % 3 = 0 THEN 1 ELSE l_quantity::INTEGER % 3 + 1 END AS site_z,
         {_CHANNEL} AS channel, l_tax <> 0.08 AS ok, l_shipdate AS seen, l_quantity::INTEGER % 3 AS plane,
         l_returnflag AS returnflag, l_linestatus AS linestatus
  FROM lineitem),
image_files AS (
  SELECT *, CASE WHEN ok THEN well || '_s' || site || '_x' || site_x || '_y' || site_y
                   || CASE WHEN plane = 0 THEN '' ELSE '_z' || (plane + 1) END
                   || '_' || replace(channel, ' ', '_') || '.tif'
                 WHEN l_orderkey % 2 = 0 THEN 'snapshot-' || l_orderkey || '.tif'
                 ELSE well || '_s' || site || '_x0_y0_.tif' END AS file
  FROM images),
files AS (SELECT *, '/export/run ' || (l_orderkey % 10) || '/' || file AS path FROM image_files)"""


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One experiment per supplier, 2 x 2 sites, every tenth with two time points."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("experiment"),
        F.lit(2).alias("num_images_x"),
        F.lit(2).alias("num_images_y"),
        F.lit(1).alias("num_images_z"),
        F.when(F.col("s_suppkey") % 10 == 0, 2).otherwise(1).alias("num_images_t"),
    )


def plate_wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, well_name) of the 96 wells that parts fall into."""
    index = F.col("p_partkey") % 96
    return (
        table(spark, sf_dir, "part").select(index.alias("_i")).distinct()
        .select((F.col("_i") + 1).alias("id"), names.well_name(F.col("_i"), 12).alias("well_name"))
    )


def stored_wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, experimentid, wellid, cell_line): the wells each experiment has used."""
    used = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("experimentid"), (F.col("l_partkey") % 96 + 1).alias("wellid")
    ).distinct()
    return used.select(
        (F.col("experimentid") * 1000 + F.col("wellid")).alias("id"), "experimentid", "wellid",
        F.concat(F.lit("line-"), F.col("experimentid") % 5).alias("cell_line"),
    )


def stored_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, experiment_wellid, site_id): four sites per used well."""
    return stored_wells(spark, sf_dir).select(
        F.col("id").alias("experiment_wellid"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("site_id")
    ).select((F.col("experiment_wellid") * 10 + F.col("site_id")).alias("id"), "experiment_wellid", "site_id")


def plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(project_name, experiment_name, plateid): one plate per experiment."""
    return table(spark, sf_dir, "supplier").select(
        F.lit("screen").alias("project_name"), F.concat(F.lit("exp "), "s_suppkey").alias("experiment_name"),
        (F.col("s_suppkey") + 5000).alias("plateid"),
    )


def stored_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, project_name, experiment_name, name): the channels of each experiment, all but one of the eight."""
    named = F.posexplode(F.array(*[F.lit(c) for c in CHANNEL_NAMES])).alias("i", "name")
    listed = table(spark, sf_dir, "supplier").select("s_suppkey", named).where(F.col("s_suppkey") % 8 != F.col("i"))
    return listed.select(
        (F.col("s_suppkey") * 100 + F.col("i")).alias("id"), F.lit("screen").alias("project_name"),
        F.concat(F.lit("exp "), "s_suppkey").alias("experiment_name"), "name",
    )


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(experiment, batchid, status): one batch per order and supplier."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("experiment"), F.col("l_orderkey").alias("batchid"))
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "processing images").otherwise("registered")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("batchid"), status.alias("status"))
    return items.distinct().join(orders, "batchid").select("experiment", "batchid", "status")


def batch_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(experiment, batchid, siteid) of the finished batches, with repeats."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("experiment"), F.col("l_orderkey").alias("batchid"),
        ((F.col("l_suppkey") * 1000 + F.col("l_partkey") % 96 + 1) * 10 + F.col("l_orderkey") % 4 + 1).alias("siteid"),
    )
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("batchid"))
    return items.join(orders, "batchid", "left_semi").select("experiment", "batchid", "siteid")


RESULT_FILES = ("Experiment.parquet", "Image.parquet", "cytoplasm.parquet", "nucleus.parquet")


def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(experiment, batchid, filename, s3path): four result files per batch; batches of low priority have none."""
    filed = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") != "5-LOW").select(F.col("o_orderkey").alias("batchid"))
    stored = batches(spark, sf_dir).join(filed, "batchid", "left_semi")
    listed = stored.select("experiment", "batchid", F.explode(F.array(*[F.lit(f) for f in RESULT_FILES])).alias("filename"))
    path = names.join_path(F.concat(F.lit("exp"), "experiment"), F.lit("plate"), F.col("batchid").cast("string"), F.col("filename"))
    return listed.withColumn("s3path", path)


SQL_BATCHES = """batches AS (
  SELECT DISTINCT l_suppkey AS experiment, l_orderkey AS batchid,
         CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'processing images' ELSE 'registered' END AS status,
         o_orderpriority AS priority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SQL_BATCH_FILES = f"""{SQL_BATCHES},
batch_files AS (
  SELECT experiment, batchid, status, filename, 'exp' || experiment || '/plate/' || batchid || '/' || filename AS s3path
  FROM batches, (SELECT unnest(['Experiment.parquet','Image.parquet','cytoplasm.parquet','nucleus.parquet']) AS filename)
  WHERE priority <> '5-LOW')"""
SQL_PROCESSED = f"""processed AS (
  SELECT DISTINCT l_suppkey AS experiment, l_orderkey AS batchid, {sql_well('l_partkey % 96')} AS well_name,
         (l_orderkey % 4 + 1)::INTEGER AS site_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW')"""
SQL_EXPERIMENTS = """experiments AS (
  SELECT s_suppkey AS experiment, (4 * CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END)::INTEGER AS n FROM supplier)"""
SQL_USED_WELLS = f"""used AS (
  SELECT DISTINCT l_suppkey AS experiment, l_partkey % 96 AS wi, {sql_well('l_partkey % 96')} AS well_name FROM lineitem)"""


# -- experiment documents --------------------------------------------------------------------------


def experiment_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per supplier; every seventh was exported again later from another microscope."""
    key = F.col("s_suppkey")
    base = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    base = base.withColumn("load", F.explode(F.when(key % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (key % 300).cast("int")), "yyyy-MM-dd")
    hour = F.lpad(((key % 12) + F.col("load") * 12).cast("string"), 2, "0")
    wells = F.transform(F.sequence(F.lit(0), (key % 7 + 2).cast("int")), lambda i: names.well_name((key + i * 5) % 96, 12))
    wells = F.when(key % 31 == 3, F.array_append(wells, F.lit("Z99"))).otherwise(wells)
    known = F.array(*[F.lit(c) for c in CHANNEL_NAMES])
    ordered = F.transform(
        F.sequence(F.lit(0), (key % 4).cast("int")), lambda i: F.element_at(known, ((key + i) % 8 + 1).cast("int"))
    )
    ordered = F.when(key % 37 == 1, F.array_append(ordered, F.lit("X-ray"))).otherwise(ordered)
    ordered = F.when(key % 41 == 2, F.array_append(ordered, F.lit("Custom"))).otherwise(ordered)

    def config(exposure: float) -> Column:
        return F.transform(
            F.array_append(known, F.lit("Custom")),
            lambda name, i: F.struct(
                name.alias("Name"), (i + F.lit(exposure)).alias("ExposureTime"),
                (key % 5).cast("double").alias("AnalogGain"), (i * F.lit(2.0)).alias("IlluminationIntensity"),
            ),
        )

    def axis(unit: str | Column, n: Column, d: float) -> Column:
        return F.struct((F.lit(unit) if isinstance(unit, str) else unit).alias("unit"), n.cast("int").alias("N"), F.lit(d).alias("d"))

    z_unit = F.when(key % 17 == 4, "um").otherwise("mm")
    documents = base.select(
        F.col("n_name").alias("project_name"),
        F.concat(F.lit("/data/exports/"), "s_name", F.when(key % 3 == 0, "/").otherwise("")).alias("output_path"),
        F.when(key % 29 == 5, "24-XX").otherwise(PLATE_TYPE).alias("plate_type"),
        F.concat(F.lit("plate-"), F.floor(key / 2)).alias("plate_name"),
        F.when(F.col("load") == 1, "scope-9").otherwise(F.concat(F.lit("scope-"), key % 4)).alias("microscope_name"),
        F.concat((key % 3 + 1) * 10, F.lit("x")).alias("objective"),
        F.concat(day, F.lit("_"), hour, F.lit(".07.09")).alias("timestamp"),
        F.concat(F.lit("line-"), key % 5).alias("cell_line"),
        wells.alias("well_list"),
        ordered.alias("channels_ordered"),
        F.concat(config(10.0), config(500.0)).alias("channels_config"),
        F.struct(
            axis("mm", key % 3 + 1, 0.5).alias("x"),
            axis("mm", key % 2 + 1, 0.25).alias("y"),
            axis(z_unit, F.when(key % 5 == 1, 2).otherwise(1), 0.003).alias("z"),
            axis("s", F.when(key % 10 == 0, 2).otherwise(1), 5400.0).alias("t"),
        ).alias("grid_config"),
        (key * 2 + F.col("load")).alias("document"),
    )
    return with_experiment_name(documents)


def existing_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(project_name, experiment_name) loaded before: those of one region."""
    nations = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 0)
    return (
        table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("project_name"), F.col("s_name").alias("experiment_name"))
    )


SQL_DOCUMENTS = """docs AS (
  SELECT n_name AS project_name, n_regionkey, s_name AS experiment_name, s_suppkey AS k, load,
         CASE WHEN s_suppkey % 29 = 5 THEN '24-XX' ELSE '96-CO-3603' END AS plate_type,
         'plate-' || (s_suppkey // 2) AS plate_name,
         CASE WHEN load = 1 THEN 'scope-9' ELSE 'scope-' || (s_suppkey % 4) END AS microscope_name,
         ((s_suppkey % 3 + 1) * 10) || 'x' AS objective,
         strftime(DATE '2024-01-01' + (s_suppkey % 300)::INTEGER, '%Y-%m-%d') || '_'
           || lpad((s_suppkey % 12 + load * 12)::VARCHAR, 2, '0') || '.07.09' AS start_text,
         'line-' || (s_suppkey % 5) AS cell_line,
         (s_suppkey % 3 + 1)::INTEGER AS nx, (s_suppkey % 2 + 1)::INTEGER AS ny,
         (CASE WHEN s_suppkey % 5 = 1 THEN 2 ELSE 1 END)::INTEGER AS nz,
         (CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END)::INTEGER AS nt,
         CASE WHEN s_suppkey % 17 = 4 THEN 'um' ELSE 'mm' END AS z_unit
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN (SELECT unnest([0, 1]) AS load) ON load = 0 OR s_suppkey % 7 = 0)"""
SQL_NEW_DOCUMENTS = f"{SQL_DOCUMENTS}, new_docs AS (SELECT * FROM docs WHERE load = 0 AND n_regionkey <> 0)"
