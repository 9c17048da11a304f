"""From raw documents to shards for training, in five stages.

Each stage takes what the one before kept, written as Parquet and read again, and is one of the operators of
``gridspark.llm`` with its production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import decontaminate, minhash, mixing, quality, sharding
from gridspark.llm.shared import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SHARDS = 40


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose text the classifier scores 0.5 or more."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 of five-word shingles): that with the smallest id.

    Rows without words stand alone. Of rows with equal ids, texts that aren't alike are told apart by their hash.
    """
    return minhash.representatives(docs, words=5, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that overlap no item of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for."""
    return mixing.mix(docs)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``shard``, ``slot`` and ``grown_shard`` for every row; repeats of a document share its shard."""
    return sharding.number_slots(sharding.assign_shards(docs, SHARDS), ties=("text",))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near duplicates", one_of_each_group),
    ("decontamination", uncontaminated),
    ("mix", mixed),
    ("shards", in_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: SQL has no trained classifier; the stages are tested against brute force instead.
ORACLE_SQL = None
