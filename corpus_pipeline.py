"""A corpus from raw documents: stages that each work on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vouch.llm import language, packing, quality, simhash, suffixes
from vouch.llm.frames import table
from vouch.llm.queries import vocabulary
from vouch.sources.staging import new_folder, remove


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go."""
    return language.keep_known(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that an earlier document has are cut out of the text."""
    return suffixes.remove_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token pieces with their ids, packed into sequences."""
    return packing.pack_documents(docs, vocabulary(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Hashed weights, random vectors and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written to the shared folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        path = None
        if k + 1 < len(STAGES):
            path = new_folder(spark)
            docs = written(docs, path)
        # the next stage's table, or the packed pieces that the last one keeps, stand by themselves
        if before:
            remove(spark, before)
        before = path
    return docs


def written(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The frame as a Parquet table in the shared folder, read again."""
    path = path or new_folder(docs.sparkSession)
    docs.write.parquet(path)
    return docs.sparkSession.read.parquet(path)
