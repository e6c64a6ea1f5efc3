"""Reports on plain tables, scalar columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywell.functions import codes, names, numbers
from tallywell.operators import indexing, tabular
from tallywell.operators.progress import throughput_report as rate_batches
from tallywell.session import table
from tallywell.sources.experiments import start_time
from tallywell.sources.tables import union_frames as union_all


def _citations(spark, sf_dir):
    """Line items as citations: a fine given as text with some junk, a make with gaps, a colour code."""
    junk = F.col("l_linenumber") == 7
    fine = F.when(junk, F.col("l_returnflag")).otherwise(F.col("l_extendedprice").cast("string"))
    make = F.when(F.col("p_brand") != "Brand#1", F.col("p_brand"))
    color = F.element_at(F.array(*[F.lit(c) for c in ("BK", "WT", "bk", "XX", "GY", "SL")]), (F.col("l_suppkey") % 6 + 1).cast("int"))
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return items.select("l_orderkey", "l_linenumber", fine.alias("fine"), make.alias("make"), color.alias("color"))


_SQL_CITATIONS = """citations AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN l_returnflag ELSE l_extendedprice::VARCHAR END AS fine,
         CASE WHEN p_brand <> 'Brand#1' THEN p_brand END AS make,
         list_extract(['BK', 'WT', 'bk', 'XX', 'GY', 'SL'], (l_suppkey % 6 + 1)::INTEGER) AS color
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_SQL_COLOR = "CASE color WHEN 'BK' THEN 'Black' WHEN 'WT' THEN 'White' WHEN 'GY' THEN 'Gray' WHEN 'SL' THEN 'Silver' ELSE color END"


def schema_rows(spark, sf_dir):
    return tabular.schema_rows(table(spark, sf_dir, "lineitem"))


def drop_columns(spark, sf_dir):
    return tabular.drop_columns(table(spark, sf_dir, "part"), "P_TYPE", "p_Size", "absent")


def cast_column(spark, sf_dir):
    cast = tabular.cast_column(_citations(spark, sf_dir), "fine", "float")
    return cast.select("l_orderkey", "l_linenumber", F.col("fine").cast("double").alias("fine"))


def count_at_max(spark, sf_dir):
    return tabular.count_at_max(table(spark, sf_dir, "lineitem"), "l_quantity")


def group_share(spark, sf_dir):
    return tabular.group_share(_citations(spark, sf_dir), "make").withColumn("share", F.round("share", 9))


def top_groups_share(spark, sf_dir):
    return tabular.top_groups_share(_citations(spark, sf_dir), "make", 20).withColumn("share", F.round("share", 9))


def expand_codes(spark, sf_dir):
    return _citations(spark, sf_dir).select("l_orderkey", "l_linenumber", codes.expand_codes(F.col("color")).alias("color_long"))


def expand_codes_udf(spark, sf_dir):
    long_names = dict(codes.COLORS)

    @F.pandas_udf("string")
    def expand(color):
        return color.map(lambda c: long_names.get(c, c))

    return _citations(spark, sf_dir).select("l_orderkey", "l_linenumber", expand("color").alias("color_long"))


def mode_in_group(spark, sf_dir):
    expanded = _citations(spark, sf_dir).withColumn("color_long", codes.expand_codes(F.col("color")))
    return tabular.mode_where(expanded, F.col("make") == "Brand#7", "color_long")


def linear_fit(spark, sf_dir):
    fit = tabular.linear_fit(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return fit.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


def throughput_report(spark, sf_dir):
    runs = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("units"),
        F.count_distinct("event_type").alias("workers"),
    )
    rated = rate_batches(runs, "units", "workers")
    rounded = [F.round(c, 9).alias(c) for c in ("minutes", "units_per_minute", "units_per_minute_per_worker")]
    return rated.select("user_id", "units", "workers", *rounded)


def pct_format(spark, sf_dir):
    pct = numbers.percent(F.col("l_discount"), F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(pct.isNotNull(), numbers.percent_text(pct)).alias("pct"),
        numbers.fixed_text(F.col("l_quantity")).alias("quantity"),
    )


def clock_to_hours(spark, sf_dir):
    # Order keys give times of day: 0.00 to 23.59.
    clock = F.col("o_orderkey") % 24 + (F.col("o_orderkey") % 60) / 100
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(numbers.clock_hours(clock), 6).alias("hours"))


def convert_units(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(numbers.mm_to_um(F.col("value")), 6).alias("um"),
        F.round(numbers.seconds_to_hours(F.col("value")), 9).alias("hours"),
    )


def site_grid(spark, sf_dir):
    nx, ny, nz, nt = F.lit(3), F.lit(2), F.lit(2), F.lit(2)
    grid = numbers.site_grid(F.col("l_linenumber") + (F.col("l_orderkey") % 24).cast("int"), nx, ny, nz, nt)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.inline(F.array(grid)))


def _file_paths(spark, sf_dir):
    suffixes = F.array(*[F.lit(s) for s in (".tif", ".CSV", ".json", ".tar.gz", "", ".bin", ".HTML")])
    ending = F.element_at(suffixes, (F.col("p_partkey") % 7 + 1).cast("int"))
    path = F.concat(F.lit("bucket-"), F.col("p_partkey") % 3, F.lit("/"), "p_brand", F.lit("/"), "p_name", F.lit(" ("), "p_partkey", F.lit(")é\\_"), ending)
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", path.alias("path"))


_SQL_PATHS = """paths AS (
  SELECT p_partkey, p_brand, 'bucket-' || (p_partkey % 3) || '/' || p_brand || '/' || p_name || ' (' || p_partkey || ')é\\_'
         || list_extract(['.tif', '.CSV', '.json', '.tar.gz', '', '.bin', '.HTML'], (p_partkey % 7 + 1)::INTEGER) AS path
  FROM part)"""
_SQL_SUFFIX = "regexp_extract(path, '(\\.[^./]+)$', 1)"
_SQL_BASE = "list_extract(string_split(path, '/'), -1)"


def path_parts(spark, sf_dir):
    path = F.col("path")
    return _file_paths(spark, sf_dir).select(
        "p_partkey", names.base_name(path).alias("base"), names.stem(path).alias("stem"),
        names.suffix(path).alias("suffix"), names.bucket_of(path).alias("bucket"), names.key_of(path).alias("object_key"),
    )


def build_paths(spark, sf_dir):
    built = names.join_path(F.lit("store"), F.col("p_brand"), F.col("p_partkey").cast("string"), names.base_name(F.col("path")))
    return _file_paths(spark, sf_dir).select("p_partkey", built.alias("built"))


def sanitize_name(spark, sf_dir):
    return _file_paths(spark, sf_dir).select("p_partkey", names.sanitize(names.base_name(F.col("path"))).alias("safe"))


def mime_type(spark, sf_dir):
    return _file_paths(spark, sf_dir).select("p_partkey", names.media_type(F.col("path")).alias("media_type"))


def parse_start_time(spark, sf_dir):
    shown = F.date_format("ts", "yyyy-MM-dd_HH.mm.ss")
    parsed = start_time(shown)
    return table(spark, sf_dir, "events").select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("start"))


def parse_result_name(spark, sf_dir):
    shown = F.concat_ws("_", F.concat(F.lit("W"), "l_partkey"), F.concat(F.lit("s"), "l_linenumber"), F.lit("x0_rest"))
    parsed = names.result_name(shown)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.inline(F.array(parsed)))


def union_frames(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    left = part.where(F.col("p_size") <= 25).select("p_partkey", "p_name", "p_type")
    right = part.where(F.col("p_size") > 25).select("p_type", "p_partkey", "p_retailprice")
    return union_all([left, right])


def concat_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("label"))
    return indexing.zip_columns(orders, events, ["o_orderkey"], ["event_id"])


def partition_rows(spark, sf_dir):
    # How rows lie in partitions is up to the reader; what holds anywhere is that each row is in one of them.
    found = tabular.partition_rows(table(spark, sf_dir, "lineitem"))
    return found.agg(F.sum("n").alias("n"), (F.count("*") == F.count_distinct("partition")).alias("once"))


QUERIES = {
    f.__name__: f
    for f in (
        schema_rows, drop_columns, cast_column, count_at_max, group_share, top_groups_share, expand_codes,
        expand_codes_udf, mode_in_group, linear_fit, throughput_report, pct_format, clock_to_hours, convert_units,
        site_grid, path_parts, build_paths, sanitize_name, mime_type, parse_start_time, parse_result_name,
        union_frames, concat_columns, partition_rows,
    )
}

_LINEITEM = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
)
_EXPANDED = f"WITH {_SQL_CITATIONS} SELECT l_orderkey, l_linenumber, {_SQL_COLOR} AS color_long FROM citations"

ORACLE = {
    "schema_rows": " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS name, '{kind}' AS type, count({name}) AS non_null FROM lineitem"
        for i, (name, kind) in enumerate(_LINEITEM)
    ),
    "drop_columns": "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part",
    "cast_column": f"WITH {_SQL_CITATIONS} SELECT l_orderkey, l_linenumber, try_cast(fine AS FLOAT)::DOUBLE AS fine FROM citations",
    "count_at_max": """SELECT max(l_quantity) AS max_value, count(*) AS n FROM lineitem
      WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)""",
    "group_share": f"""WITH {_SQL_CITATIONS}
      SELECT make, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM citations), 9) AS share FROM citations GROUP BY make""",
    "top_groups_share": f"""WITH {_SQL_CITATIONS},
      g AS (SELECT make, count(*) AS n FROM citations GROUP BY make ORDER BY n DESC, make NULLS FIRST LIMIT 20)
      SELECT make, round(n::DOUBLE / (SELECT count(*) FROM citations), 9) AS share FROM g""",
    "expand_codes": _EXPANDED,
    "expand_codes_udf": _EXPANDED,
    "mode_in_group": f"""WITH {_SQL_CITATIONS}
      SELECT {_SQL_COLOR} AS color_long, count(*) AS n FROM citations WHERE make = 'Brand#7'
      GROUP BY 1 ORDER BY n DESC, color_long LIMIT 1""",
    "linear_fit": """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
        round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem GROUP BY l_returnflag""",
    "throughput_report": """WITH r AS (
        SELECT user_id, count(*) AS units, count(DISTINCT event_type) AS workers,
               epoch_us(max(ts) - min(ts)) / 6e7 AS minutes FROM events GROUP BY user_id)
      SELECT user_id, units, workers, round(minutes, 9) AS minutes,
             round(units / nullif(minutes, 0), 9) AS units_per_minute,
             round(units / nullif(minutes, 0) / workers, 9) AS units_per_minute_per_worker FROM r""",
    "pct_format": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_tax <> 0 THEN printf('%6.2f%%', l_discount * 100 / l_tax) END AS pct,
        printf('%.2f', round(l_quantity, 2)) AS quantity FROM lineitem""",
    "clock_to_hours": """SELECT o_orderkey, round((o_orderkey % 24)::DOUBLE + (o_orderkey % 60) / 60.0::DOUBLE, 6) AS hours FROM orders""",
    "convert_units": "SELECT event_id, round(value * 1000, 6) AS um, round(value / 3600, 9) AS hours FROM events",
    "site_grid": """WITH s AS (SELECT l_orderkey, l_linenumber, (l_linenumber + l_orderkey % 24)::INTEGER AS n FROM lineitem)
      SELECT l_orderkey, l_linenumber, (n % 3)::INTEGER AS site_x, ((n // 3) % 2)::INTEGER AS site_y,
             ((n // 6) % 2)::INTEGER AS site_z, ((n // 12) % 2)::INTEGER AS site_t FROM s""",
    "path_parts": f"""WITH {_SQL_PATHS}
      SELECT p_partkey, {_SQL_BASE} AS base, {_SQL_BASE}[:len({_SQL_BASE}) - len({_SQL_SUFFIX})] AS stem, {_SQL_SUFFIX} AS suffix,
             split_part(path, '/', 1) AS bucket, substr(path, strpos(path, '/') + 1) AS object_key FROM paths""",
    "partition_rows": "SELECT count(*) AS n, true AS once FROM lineitem",
    "build_paths": f"""WITH {_SQL_PATHS}
      SELECT p_partkey, 'store/' || p_brand || '/' || p_partkey || '/' || {_SQL_BASE} AS built FROM paths""",
    "sanitize_name": f"""WITH {_SQL_PATHS}
      SELECT p_partkey, trim(regexp_replace(replace(strip_accents({_SQL_BASE}), ' ', '_'), '[^A-Za-z0-9_.-]', '', 'g'), '._') AS safe FROM paths""",
    "mime_type": f"""WITH {_SQL_PATHS}
      SELECT p_partkey, CASE lower({_SQL_SUFFIX}) WHEN '.tif' THEN 'image/tiff' WHEN '.csv' THEN 'text/csv'
        WHEN '.json' THEN 'application/json' WHEN '.html' THEN 'text/html' ELSE 'application/octet-stream' END AS media_type
      FROM paths""",
    "parse_start_time": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS start FROM events",
    "parse_result_name": "SELECT l_orderkey, 'W' || l_partkey AS well, l_linenumber AS site FROM lineitem",
    "union_frames": """SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_name END AS p_name, p_type,
        CASE WHEN p_size > 25 THEN p_retailprice END AS p_retailprice FROM part""",
    "concat_columns": """WITH a AS (SELECT o_orderkey, o_orderpriority AS label, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders),
      b AS (SELECT event_id, event_type AS label_2, row_number() OVER (ORDER BY event_id) AS i FROM events)
      SELECT o_orderkey, label, event_id, label_2 FROM a FULL JOIN b USING (i)""",
}
