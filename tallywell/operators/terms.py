"""Share of posts that contain each term of a word list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions import terms as tm
from tallywell.functions.numbers import percent


def term_list(posts: DataFrame, terms: Sequence[str]) -> DataFrame:
    return posts.sparkSession.createDataFrame([(t,) for t in terms], "term string")


def term_share_extract(posts: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """(term, n, total, pct) by extracting all terms of a post at once.

    The total is counted in the same pass: every post also contributes one
    marker row, and all rows shrink to one per term before the shuffle.
    """
    found = posts.select(
        F.explode(F.concat(F.array(F.lit(None).cast("string")), tm.distinct_terms(F.col(text), terms))).alias("term")
    )
    counts = found.groupBy("term").agg(F.count("*").alias("n"))
    # At most one row per term plus the marker, so one row of them is a bounded map.
    per_post = counts.agg(
        F.map_from_entries(F.collect_list(F.struct(F.coalesce("term", F.lit("")).alias("k"), F.col("n").alias("v")))).alias("m")
    )
    zero = F.lit(0).cast("bigint")
    total = F.coalesce(F.try_element_at("m", F.lit("")), zero)
    shares = per_post.select(
        F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"), "m", total.alias("total")
    ).select("term", F.coalesce(F.try_element_at("m", F.col("term")), zero).alias("n"), "total")
    return shares.withColumn("pct", percent(F.col("n"), F.col("total")))


def term_share_flags(posts: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """(term, n, total, pct) by one indicator sum per term: a single pass, and no text is shuffled."""
    lowered = posts.select(F.lower(text).alias("_lower"))
    flags = [tm.lower_contains_term(F.col("_lower"), term).alias(f"t{i}") for i, term in enumerate(terms)]
    sums = [F.sum(F.col(f"t{i}").cast("bigint")).alias(f"t{i}") for i in range(len(terms))]
    return _one_row_to_shares(lowered.select(*flags).agg(F.count("*").alias("total"), *sums), terms)


def term_share_filter(posts: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """(term, n, total, pct) by one filtered count per term."""
    counts = [F.count_if(tm.contains_term(F.col(text), term)).alias(f"t{i}") for i, term in enumerate(terms)]
    return _one_row_to_shares(posts.agg(F.count("*").alias("total"), *counts), terms)


def _one_row_to_shares(row: DataFrame, terms: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(F.lit(term).alias("term"), F.coalesce(F.col(f"t{i}"), F.lit(0)).alias("n")) for i, term in enumerate(terms)
    ]
    shares = row.select("total", F.inline(F.array(*entries)))
    return shares.select("term", "n", "total", percent(F.col("n"), F.col("total")).alias("pct"))


def term_matches(posts: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """(term, n) of posts matching each term's pattern."""
    return term_share_filter(posts, terms, text).select("term", "n")
