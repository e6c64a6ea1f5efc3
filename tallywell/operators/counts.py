"""Counting operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions import text as tx


def _values(df: DataFrame, items: Column, name: str) -> DataFrame:
    return df.select(F.explode(items).alias(name))


def word_count(tokens: DataFrame, column: str = "tokens") -> DataFrame:
    """(word, n) of all non-empty tokens of an array column; unsorted."""
    words = _values(tokens, F.col(column), "word").where(F.col("word") != "")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def whitespace_word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """(word, n) of whitespace-separated words, case kept."""
    return _values(lines, tx.words(F.col(column)), "word").groupBy("word").agg(F.count("*").alias("n"))


def first_letter_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """(letter, n) of whitespace-separated words by lower-cased first character."""
    words = _values(lines, tx.words(F.col(column)), "word")
    return words.groupBy(tx.first_letter(F.col("word")).alias("letter")).agg(F.count("*").alias("n"))


def top_k(counts: DataFrame, k: int, by: str = "n", ties: Sequence[str] = ("word",)) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties go to the smaller key. Plans as take-ordered."""
    return counts.orderBy(F.desc(by), *[F.asc(c) for c in ties]).limit(k)


def sum_by_key(pairs: DataFrame, key: str = "key", count: str = "count") -> DataFrame:
    """Add up pre-counted pairs."""
    return pairs.groupBy(key).agg(F.sum(count).alias(count))


def zero_filled(counts: DataFrame, keys: DataFrame, key: str, count: str) -> DataFrame:
    """Counts for every key in ``keys``; a key without rows gets 0, keys not listed are left out."""
    return keys.join(counts, key, "left").withColumn(count, F.coalesce(count, F.lit(0)))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) for several frames."""
    counted = [
        frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, frame in tables.items()
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


def count_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: both row counts and whether they agree."""
    counts = left.agg(F.count("*").alias("left_count")).withColumn(
        "right_count", right.agg(F.count("*").alias("n")).scalar()
    )
    return counts.withColumn("same", F.col("left_count") == F.col("right_count"))


def map_count_lines(
    lines: DataFrame, mapper: Callable[[str], Iterable[tuple[str, int]]], column: str = "value"
) -> DataFrame:
    """Run a line mapper that emits (key, count) pairs and add them up by key.

    Each Arrow batch is pre-summed before the shuffle, so a key that occurs in
    every line leaves a task once per batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[str, int] = {}
            for line in batch[column]:
                for key, count in mapper(line):
                    sums[key] = sums.get(key, 0) + count
            yield pd.DataFrame({"key": list(sums), "count": list(sums.values())}).astype({"count": "int64"})

    return sum_by_key(lines.select(column).mapInPandas(run, "key string, count bigint"))
