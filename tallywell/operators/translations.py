"""Lexical translation probabilities from aligned lines, by expectation-maximisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.operators.indexing import index_rows
from tallywell.storage import materialize

#: A left word that every line has, for right words that nothing on the left explains.
NONE = ""


def short_pairs(aligned: DataFrame, max_words: int = 20) -> DataFrame:
    """(idx, left_words, right_words) of aligned lines of 1 to ``max_words`` words on both sides, of any two lengths."""
    split = lambda c: F.filter(F.split(F.lower(c), " ", -1), lambda w: w != "")
    tokens = aligned.select("idx", split(F.col("left_line")).alias("left_words"), split(F.col("right_line")).alias("right_words"))
    return tokens.where(F.size("left_words").between(1, max_words) & F.size("right_words").between(1, max_words))


def _links(pairs: DataFrame) -> DataFrame:
    """(idx, left_word, right_word, times): the words of each pair of lines, with how often the right one comes times the left one."""
    left = pairs.select("idx", F.explode(F.concat(F.array(F.lit(NONE)), "left_words")).alias("left_word"), "right_words")
    left = left.groupBy("idx", "left_word").agg(F.count("*").alias("a"), F.first("right_words").alias("right_words"))
    both = left.select("idx", "left_word", "a", F.explode("right_words").alias("right_word"))
    return both.groupBy("idx", "left_word", "right_word").agg(F.first("a").alias("a"), F.count("*").alias("b"))


def word_translations(pairs: DataFrame, rounds: int = 5) -> DataFrame:
    """(left_word, right_word, probability): how likely each left word stands for each right one, after ``rounds`` rounds.

    ``pairs``: (idx, left_words, right_words) with a bounded number of words, see ``short_pairs``; each line also has the left
    word ``NONE``. In the first round all right words of a line are shared evenly between its left words; in each other one
    in proportion to the probabilities so far. A word's expected counts, divided by their sum, are its next
    probabilities. Words of a line meet only each other, so the work grows with the lines; a probability is one row,
    and both hot words and hot pairs are added up in part before they are shuffled. No pairs give no rows.
    """
    links = materialize(_links(pairs), "links")
    known = None
    for _ in range(rounds):
        if known is None:
            weighted = links.withColumn("t", F.lit(1.0))
        else:
            weighted = links.join(known, ["left_word", "right_word"])
        shares = weighted.groupBy("idx", "right_word").agg(
            F.collect_list(F.struct("left_word", F.col("a").alias("a"), "b", "t")).alias("own"),  # the left words of one line
            F.sum(F.col("a") * F.col("t")).alias("whole"),
        )
        given = shares.select("right_word", "whole", F.inline("own")).select(
            "left_word", "right_word", (F.col("a") * F.col("t") / F.col("whole") * F.col("b")).alias("share")
        )
        expected = materialize(given.groupBy("left_word", "right_word").agg(F.sum("share").alias("n")), "expected")
        sums = expected.groupBy("left_word").agg(F.sum("n").alias("whole"))
        known = expected.join(sums, "left_word").select("left_word", "right_word", (F.col("n") / F.col("whole")).alias("t"))
    if known is None:
        raise ValueError("at least one round")
    return known.withColumnRenamed("t", "probability")


def best_translations(translations: DataFrame, k: int = 1) -> DataFrame:
    """``translations`` of the ``k`` most probable right words of each left word, with rank from 1; ties to the smaller word."""
    ranked = index_rows(translations, [F.desc("probability"), "right_word"], "rank", within=["left_word"])
    return ranked.where(F.col("rank") < k).withColumn("rank", F.col("rank") + 1)
