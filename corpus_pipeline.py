"""From raw documents to packed sequences: quality classifier, quality rules, near duplicates, long repeats, packing.

Every stage takes all that its predecessor kept, as a table. Null and empty texts fail the rules (they have no words).
Extra columns of the documents pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratestrata.llm import long_repeats, near_duplicates, packing, quality_classifier, quality_rules
from ratestrata.llm.common import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from `labels`, scores at its threshold or above."""
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.good(docs, model)


def rules_passed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the web policy rejects."""
    return quality_rules.passing(docs, quality_rules.WEB)


def near_duplicates_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return near_duplicates.one_per_group(docs, width=5, percent=80)


def long_repeats_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words or more that stand in a document of a smaller doc_id."""
    return long_repeats.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 2048 tokens."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classified),
    ("quality_rules", rules_passed),
    ("near_duplicates", near_duplicates_removed),
    ("long_repeats", long_repeats_removed),
    ("packing", packed),
]

#: A learned model and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir), name)
    return docs
