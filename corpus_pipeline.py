"""The training-data pipeline: documents through five stages, each of one operator of ``maskfold.llm``.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept, with the columns of
``documents``; its result is written as Parquet to the shared folder and reread as the next one's input, so a lost
executor repeats tasks of one stage only. The stages: documents that the toxicity operator rejects go; of each
group of documents linked by shared five-word shingles the one of the smallest id stays; documents that hold a
benchmark item go; the sources are mixed to their target weights, a document repeated by its number of copies; and
every row gets its shard. The last stage adds ``shard`` and ``shard_bytes``.

An empty table goes through all stages and gives no rows. SQL can't express the trained and hashed stages, so
``ORACLE_SQL`` is None; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # the package sits next to this file

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from maskfold.llm.decontaminate import without_benchmark  # noqa: E402
from maskfold.llm.mixing import mixed  # noqa: E402
from maskfold.llm.ngram_join import one_of_each  # noqa: E402
from maskfold.llm.sharding import sharded  # noqa: E402
from maskfold.llm.shared import written  # noqa: E402
from maskfold.llm.toxicity import clean  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model of the labelled ones."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their copies in the mix."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shards."""
    return sharded(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that all stages leave of the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
