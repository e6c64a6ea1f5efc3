"""Post documents, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions.checks import require
from tallywell.functions.text import strip
from tallywell.schemas import POST
from tallywell.storage import materialize

RESHARE_KEY = "retweeted_status"


def scan_ndjson(spark: SparkSession, path: str, schema: str = POST) -> DataFrame:
    """Typed projection of the two fields the jobs use; malformed input fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Raw JSON lines as (value, keys, text); blank lines are skipped.

    ``strict`` fails the job on a line that is not a JSON object, otherwise such
    lines are dropped.
    """
    value = strip(F.col("value"))
    parsed = lines.select(value.alias("value")).where(F.length("value") > 0)
    parsed = parsed.withColumn("keys", F.json_object_keys("value"))
    valid = F.col("keys").isNotNull()
    parsed = require(parsed, valid, F.lit("malformed JSON line")) if strict else parsed.where(valid)
    return parsed.withColumn("text", F.get_json_object("value", "$.text"))


def originals_by_key(posts: DataFrame) -> DataFrame:
    """Posts whose object has no reshare key at all; an explicit null still counts as a reshare."""
    return posts.where(~F.array_contains("keys", RESHARE_KEY))


def originals_by_null(posts: DataFrame) -> DataFrame:
    """Posts whose reshare struct is null, with the struct dropped."""
    return posts.where(F.col(RESHARE_KEY).isNull()).drop(RESHARE_KEY)


def load_posts(spark: SparkSession, path: str, table_path: str | None = None, reload: bool = True) -> DataFrame:
    """Original posts as a Parquet table; ``reload`` replaces what is there, otherwise rows are added."""
    posts = originals_by_null(scan_ndjson(spark, path))
    if table_path is None:
        return materialize(posts, "posts")
    posts.write.mode("overwrite" if reload else "append").parquet(table_path)
    return spark.read.schema(posts.schema).parquet(table_path)
