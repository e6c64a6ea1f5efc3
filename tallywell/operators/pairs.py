"""Word pairs from two corpora aligned line by line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions.text import lower_tokens
from tallywell.operators.indexing import index_rows


def aligned_lines(left: DataFrame, right: DataFrame, order_by: Sequence[str], line: str = "line") -> DataFrame:
    """(idx, left_line, right_line) of lines with the same position; surplus lines are dropped."""
    a = index_rows(left, order_by).select("idx", F.col(line).alias("left_line"))
    b = index_rows(right, order_by).select("idx", F.col(line).alias("right_line"))
    return a.join(b, "idx")


def pair_filter(aligned: DataFrame, max_words: int = 20, drop_empty: bool = False) -> DataFrame:
    """Tokenise both sides and keep pairs of equally long, short lines.

    A line that is empty is one empty token, so two empty lines pass;
    ``drop_empty`` leaves out lines without any text.
    """
    tokens = aligned.select(
        "idx", lower_tokens(F.col("left_line")).alias("left_words"), lower_tokens(F.col("right_line")).alias("right_words")
    )
    size = F.size("left_words")
    kept = tokens.where((size > 0) & (size <= max_words) & (size == F.size("right_words")))
    if drop_empty:
        blank = F.array(F.lit(""))
        kept = kept.where((F.col("left_words") != blank) & (F.col("right_words") != blank))
    return kept


def word_pairs(pairs: DataFrame, drop_empty: bool = False) -> DataFrame:
    """(idx, pos, left_word, right_word): the words of each pair matched by position."""
    zipped = pairs.select("idx", F.posexplode(F.arrays_zip("left_words", "right_words")).alias("pos", "pair"))
    result = zipped.select(
        "idx", "pos", F.col("pair.left_words").alias("left_word"), F.col("pair.right_words").alias("right_word")
    )
    return result.where((F.col("left_word") != "") & (F.col("right_word") != "")) if drop_empty else result


def word_pair_count(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("left_word", "right_word").agg(F.count("*").alias("n"))
