"""The corpus pipeline: documents in, packed batches out.

Each stage works on all that the stage before kept; what it returns is written as Parquet and read again for the next.
All stages take null ids, sources and texts (a null text counts as empty), texts of any length and repeated rows; an empty
table goes through as an empty one. Further columns, of whatever name, go along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickmart.llm import mixing, ngram_join, packing, suffix_dedup, toxicity
from tickmart.llm.scratch import fresh_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained scorer doesn't reject. Empty texts are scored too; repeated rows are judged alike."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def ngram_jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one of the smallest doc_id; repeated rows are such a group. Texts without
    words have no group and stay, one of each id and all without id."""
    return ngram_join.one_of_each_group(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that occur earlier; every row stays, with an empty text if nothing is left of it. Rows
    without id count as the last ones."""
    return suffix_dedup.without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight says. A null source is one of its own; equal rows draw one by one."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket, batch and place, instead of its columns. Empty texts have length 0 and take a place too."""
    return packing.packed_batches(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", ngram_jaccard_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the trained scorer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
