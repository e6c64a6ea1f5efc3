"""File formats: each query writes a driver table in the format and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywell.operators.counts import row_counts
from tallywell.plans.standins import doc_lines, experiment_documents, image_files, sql_lines
from tallywell.session import TABLES, table
from tallywell.sources import experiments as ex
from tallywell.sources import lines as line_sources
from tallywell.sources import objects, sinks, tables
from tallywell.storage import fresh_path, materialize, write_partitioned


def scan_lines(spark, sf_dir):
    path = fresh_path(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return line_sources.scan_lines(spark, path).withColumnRenamed("value", "line")


def scan_glob(spark, sf_dir):
    root = fresh_path(spark, "glob")
    table(spark, sf_dir, "documents").select("lang", "text").write.partitionBy("lang").text(f"{root}/texts")
    table(spark, sf_dir, "nation").write.json(f"{root}/other")
    return line_sources.scan_glob(spark, root, "part-*.txt").withColumnRenamed("value", "line")


def scan_csv_header(spark, sf_dir):
    path = fresh_path(spark, "csv")
    customers = table(spark, sf_dir, "customer")
    customers.write.option("header", "true").csv(path)
    return tables.scan_csv_header(spark, path, customers.columns)


_ITEM = "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate date"
_ITEM_COLUMNS = [part.split()[0] for part in _ITEM.split(", ")]


def scan_csv_typed(spark, sf_dir):
    path = fresh_path(spark, "csv")
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    items.select(*_ITEM_COLUMNS).write.option("header", "true").csv(path)
    return tables.scan_csv_typed(spark, path, _ITEM).withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def scan_parquet(spark, sf_dir):
    return tables.scan_parquet(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")


def scan_by_suffix(spark, sf_dir):
    root = fresh_path(spark, "suffix")
    part = table(spark, sf_dir, "part")
    small = part.where(F.col("p_size") <= 25).select("p_partkey", "p_name", "p_retailprice", "p_type")
    small.write.option("header", "true").csv(f"{root}/small.csv")
    part.where(F.col("p_size") > 25).select("p_partkey", "p_name", "p_retailprice").write.parquet(f"{root}/large.parquet")
    schema = "p_partkey bigint, p_name string, p_retailprice double, p_type string"
    return tables.scan_by_suffix(spark, [f"{root}/small.csv", f"{root}/large.parquet"], schema)


def scan_experiment_json(spark, sf_dir):
    root = fresh_path(spark, "experiments")
    documents = experiment_documents(spark, sf_dir).drop("experiment_name")
    body = F.to_json(F.struct(*[c for c in documents.columns if c != "document"]), {"pretty": "true"})
    # One file per document: dealt out, as the table is one file itself, and committed by the tasks, not one by one by the driver.
    dealt = documents.select(body.alias("value")).repartition(4 * spark.sparkContext.defaultParallelism)
    dealt.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(root)
    scanned = ex.scan_experiments(spark, root)
    return scanned.select(
        "project_name", "experiment_name", "plate_type", "microscope_name", "timestamp",
        F.col("grid_config.x.N").alias("nx"), F.col("grid_config.t.d").alias("step_t"),
        F.size("well_list").alias("n_wells"), F.size("channels_config").alias("n_configs"),
    )


def scan_images(spark, sf_dir):
    root = fresh_path(spark, "objects")
    pages = table(spark, sf_dir, "pages").select(F.col("html").alias("value"))
    pages.write.option("maxRecordsPerFile", 1).text(root)  # one object per page
    # Text files end with a newline, which belongs to the object but not to the page.
    return ex.scan_images(spark, root).select((F.col("length") - 1).alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def scan_image_refs(spark, sf_dir):
    """Half of the pages stand in a table of references, some of them twice, beside objects that don't exist."""
    root = fresh_path(spark, "objects")
    pages = table(spark, sf_dir, "pages")
    name = F.concat(F.lit("page-"), "page_id", F.lit(".html"))
    objects.put_objects(pages.select(F.concat(F.lit(f"{root}/"), name).alias("path"), F.col("html").cast("binary").alias("content")))
    once, twice = pages.where("page_id % 2 = 0"), pages.where("page_id % 10 = 0")
    gone = pages.where("page_id % 7 = 1").select(F.concat(F.lit("gone-"), "page_id", F.lit(".html")).alias("name"))
    named = once.select(name.alias("name")).unionByName(twice.select(name.alias("name"))).unionByName(gone)
    fetched = objects.fetch_objects(named.select(F.concat(F.lit(f"{root}/"), "name").alias("path")))
    return fetched.select(
        F.substring_index("path", "/", -1).alias("name"), "n_references", F.col("length").alias("n_bytes"),
        F.sha2("content", 256).alias("sha256"), "reason",
    )


def sql_query(spark, sf_dir):
    text = """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
      FROM {items} WHERE l_quantity BETWEEN :low AND :high AND l_linestatus = :status GROUP BY l_returnflag"""
    return tables.sql_query(spark, text, {"items": table(spark, sf_dir, "lineitem")}, low=10, high=40, status="O")


def dim_channels(spark, sf_dir):
    from tallywell.operators.warehouse import parse_images

    parsed = parse_images(image_files(spark, sf_dir))
    used = parsed.groupBy(F.col("channel").alias("name")).agg(F.count("*").alias("n_images"))
    dim = ex.dim_channels(spark).join(used, "name", "left")
    return dim.select(
        "name", "is_fluorescence", "fluorescence_wavelength_nm", "brightfield_type",
        F.coalesce("n_images", F.lit(0)).alias("n_images"),
    )


def gen_well_grid(spark, sf_dir):
    size = F.when(F.col("s_suppkey") % 2 == 0, 96).otherwise(384)
    plates = table(spark, sf_dir, "supplier").select("s_suppkey", size.alias("num_wells"))
    return ex.well_grid(plates).select("s_suppkey", "well_name")


def preview_tables(spark, sf_dir):
    whole = {name: table(spark, sf_dir, name) for name in TABLES}
    previews = {name: materialize(rows, "preview") for name, rows in tables.preview_tables(whole, 5).items()}
    # Previewed rows that the table really holds.
    held = {
        name: rows.alias("p").join(whole[name].alias("w"), [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in rows.columns], "left_semi")
        for name, rows in previews.items()
    }
    return row_counts(previews).join(row_counts(held).withColumnRenamed("n", "held"), "table_name")


def sink_csv_to_parquet(spark, sf_dir):
    csv, target = fresh_path(spark, "csv"), fresh_path(spark, "converted")
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("project"), F.col("l_linestatus").alias("plate"), F.col("l_linenumber").alias("batch"),
        "l_orderkey", "l_quantity",
    )
    items.write.option("header", "true").csv(csv)
    schema = "project string, plate string, batch int, l_orderkey bigint, l_quantity double"
    sinks.csv_to_parquet(spark, csv, schema, target, ["project", "plate", "batch"])
    return spark.read.schema(schema).parquet(target)


def scan_numbered_lines(spark, sf_dir):
    """Lines of several files, numbered across all of them in file-name order."""
    from tallywell.operators.indexing import index_file_lines

    path = fresh_path(spark, "numbered")
    ordered = doc_lines(spark, sf_dir).orderBy("doc_id", "pos")
    ordered.select(F.concat("doc_id", F.lit(":"), "pos").alias("value")).write.text(path)
    return index_file_lines(line_sources.scan_lines_with_position(spark, path)).select("value", "idx")


def sink_partitioned(spark, sf_dir):
    target = fresh_path(spark, "by-type")
    write_partitioned(table(spark, sf_dir, "events").select("event_type", "event_id"), target, ["event_type"])
    return spark.read.schema("event_id bigint, event_type string").parquet(target)


QUERIES = {
    f.__name__: f
    for f in (
        scan_lines, scan_glob, scan_csv_header, scan_csv_typed, scan_parquet, scan_by_suffix, scan_experiment_json,
        scan_images, scan_image_refs, sql_query, dim_channels, gen_well_grid, preview_tables, sink_csv_to_parquet,
        scan_numbered_lines, sink_partitioned,
    )
}

_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"


def _oracles() -> dict[str, str]:
    from tallywell.plans.standins import SQL_DOCUMENTS, SQL_IMAGES

    width = "CASE WHEN s_suppkey % 2 = 0 THEN 12 ELSE 24 END"
    channels = ", ".join(
        f"('{name}', {str(fluo).lower()}, {wave or 'NULL::INTEGER'}, {repr(kind) if kind else 'NULL'})"
        for name, fluo, wave, _, kind in ex.CHANNELS
    )
    return {
        "scan_lines": _LINES,
        "scan_glob": _LINES,
        "scan_csv_header": "SELECT COLUMNS(*)::VARCHAR FROM customer",
        "scan_csv_typed": f"SELECT {', '.join(_ITEM_COLUMNS[:-1])}, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem",
        "scan_parquet": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem",
        "scan_by_suffix": "SELECT p_partkey, p_name, p_retailprice, CASE WHEN p_size <= 25 THEN p_type END AS p_type FROM part",
        "scan_experiment_json": f"""WITH {SQL_DOCUMENTS}
          SELECT project_name, experiment_name, plate_type, microscope_name, start_text AS timestamp, nx, 5400.0::DOUBLE AS step_t,
                 (k % 7 + 3 + CASE WHEN k % 31 = 3 THEN 1 ELSE 0 END)::INTEGER AS n_wells, 18::INTEGER AS n_configs FROM docs""",
        "scan_images": "SELECT octet_length(encode(html)) AS n_bytes, sha256(html || chr(10)) AS sha256 FROM pages",
        "scan_image_refs": """WITH refs AS (
            SELECT 'page-' || page_id || '.html' AS name, html FROM pages WHERE page_id % 2 = 0
            UNION ALL SELECT 'page-' || page_id || '.html', html FROM pages WHERE page_id % 10 = 0
            UNION ALL SELECT 'gone-' || page_id || '.html', NULL FROM pages WHERE page_id % 7 = 1)
          SELECT name, count(*) AS n_references, octet_length(encode(any_value(html))) AS n_bytes, sha256(any_value(html)) AS sha256,
                 CASE WHEN any_value(html) IS NULL THEN 'not found' END AS reason
          FROM refs GROUP BY name""",
        "sql_query": """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
          FROM lineitem WHERE l_quantity BETWEEN 10 AND 40 AND l_linestatus = 'O' GROUP BY l_returnflag""",
        "dim_channels": f"""WITH {SQL_IMAGES},
          dim(name, is_fluorescence, fluorescence_wavelength_nm, brightfield_type) AS (VALUES {channels}),
          used AS (SELECT channel AS name, count(*) AS n FROM images WHERE ok GROUP BY 1)
          SELECT dim.*, coalesce(n, 0) AS n_images FROM dim LEFT JOIN used USING (name)""",
        "gen_well_grid": f"""WITH w AS (
            SELECT s_suppkey, {width} AS width, unnest(range(CASE WHEN s_suppkey % 2 = 0 THEN 96 ELSE 384 END)) AS i FROM supplier)
          SELECT s_suppkey, chr(65 + (i // width)::INTEGER) || lpad((i % width + 1)::VARCHAR, 2, '0') AS well_name FROM w""",
        "preview_tables": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, least(5, count(*)) AS n, least(5, count(*)) AS held FROM {name}" for name in TABLES
        ),
        "sink_csv_to_parquet": """SELECT l_returnflag AS project, l_linestatus AS plate, l_linenumber AS batch, l_orderkey, l_quantity
          FROM lineitem""",
        "scan_numbered_lines": f"""WITH {sql_lines('lines')}
          SELECT doc_id || ':' || pos AS value, row_number() OVER (ORDER BY doc_id, pos) - 1 AS idx FROM lines""",
        "sink_partitioned": "SELECT event_type, event_id FROM events",
    }


ORACLE = _oracles()
