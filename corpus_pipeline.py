"""A training corpus from documents: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywell.llm import decontaminate, mixing, near_dedup, quality, sharding
from tallywell.llm.queries import read
from tallywell.session import ship_package
from tallywell.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _ready(spark: SparkSession, sf_dir: str) -> None:
    ship_package(spark)
    read(spark, sf_dir, "documents")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, each row by itself: a null or empty text fails the base rules; no documents give none."""
    _ready(spark, sf_dir)
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies: the least doc_id (nulls last), of repeated rows one. Null texts count as empty."""
    _ready(spark, sf_dir)
    return near_dedup.keep_one(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Null and empty texts hold none; without benchmark items all documents stay."""
    _ready(spark, sf_dir)
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: repeats are rows of their own, a null source is one like others."""
    _ready(spark, sf_dir)
    return mixing.take_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document; equal texts, null and empty ones among them, share a shard, ties follow the doc_id."""
    _ready(spark, sf_dir)
    return sharding.shard_documents(docs, keep=["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near copies", near_copies),
    ("benchmark items", benchmark_items),
    ("source mix", source_mix),
    ("shards", shards),
]

#: Expectation-maximisation, sketches and walks have no SQL form; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
