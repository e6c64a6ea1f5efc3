"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.words import WORD
from tallywell.operators.indexing import index_rows
from tallywell.storage import materialize

ADDED = ["size", "source_size", "target", "copies", "taken"]


def n_words(text: Column) -> Column:
    """Words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), times: int = 3) -> DataFrame:
    """Targets for (source, source_size), one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all
    sizes. No target is above ``times`` its source's size: sources in the order of size by
    weight are filled up first, as long as the share of the rest would exceed them; the rest
    shares by weight what is left. That is where repeated resharing ends.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    weighed = sizes.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long").alias("_w"))
    # One row per source, as small as the list of sources itself.
    order = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    running = weighed.select(
        "source",
        "source_size",
        "_w",
        F.sum("source_size").over(everything).alias("_all"),
        F.sum("_w").over(everything).alias("_weights"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_filled"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_passed"),
    )
    left = F.col("_all") - times * F.col("_filled")
    open_weight = F.col("_weights") - F.col("_passed")
    is_full = times * F.col("source_size") * open_weight <= left * F.col("_w")
    marked = running.withColumn("_full", is_full)
    full_size = F.sum(F.when(F.col("_full"), F.col("source_size")).otherwise(0)).over(everything)
    full_weight = F.sum(F.when(F.col("_full"), F.col("_w")).otherwise(0)).over(everything)
    share = F.try_divide((F.col("_all") - times * full_size) * F.col("_w"), F.col("_weights") - full_weight)
    target = F.when(F.col("_full"), (times * F.col("source_size")).cast("double")).otherwise(share)
    return marked.select("source", "source_size", target.cast("double").alias("target"))


def _offset(source: Column, seed: int) -> Column:
    """One offset in [0, 1) per source, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\x00null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_sources(
    sized: DataFrame, key: str = "doc_id", seed: int = 7, weights: tuple[int, ...] = (1, 2, 3), times: int = 3
) -> DataFrame:
    """How often each row of (``key``, source, size) is taken: adds source_size, target, copies, taken.

    Every row of a source is expected target / source_size times, at most ``times``. Rows of a source
    stand in the order of size and key, so their expected copies add up to rank times rate; plus the
    source's offset, the row is taken once for each whole number that its step crosses. Neighbours in that
    order are of like size, which keeps the words taken near the target. Null keys stand first, equal
    rows are taken as often in any order. A source without words has target 0 and is not taken.
    """
    ranked = index_rows(sized, [F.col("source").asc_nulls_last(), "size", F.col(key).asc_nulls_first()], "_rank")
    sizes = ranked.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_rank").alias("_first"))
    targets = source_targets(sizes, weights, times).withColumnRenamed("source", "_source")
    firsts = sizes.select(F.col("source").alias("_from"), "_first")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    # One row per source; Spark broadcasts them if they are small.
    rates = targets.join(firsts, F.col("_source").eqNullSafe(F.col("_from"))).select(
        "_source", "source_size", "target", "_first", rate.alias("_rate"), _offset(F.col("_source"), seed).alias("_u")
    )
    joined = ranked.join(rates, F.col("source").eqNullSafe(F.col("_source")))
    place = F.col("_rank") - F.col("_first")
    step = F.floor((place + 1) * F.col("_rate") + F.col("_u")) - F.floor(place * F.col("_rate") + F.col("_u"))
    copies = F.least(step, F.lit(times)).cast("long")
    return joined.withColumn("copies", copies).select(
        *sized.columns, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def size_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of each document, stored: the sort below it reads its input twice."""
    return materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mixing-sizes")


def take_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, same columns.

    Rows, not ids, are sampled, so rows that share an id count one by one.
    """
    own = [F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)]
    sized = docs.select(*own, F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"))
    mixed = mix_sources(sized, **options)
    taken = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
