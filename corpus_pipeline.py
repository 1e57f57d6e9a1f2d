"""Corpus pipeline over ``documents``: toxicity, quality rules, n-gram Jaccard join, benchmark decontamination, packing.

Each stage takes the documents that the stage before it kept, written as Parquet and read again, and returns the rows that it
keeps with the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontamination, jaccard, packing, quality_rules, toxicity
from tallyhouse.llm.base import prepare, remainder, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; labels are learned from keys outside every fifth fold."""
    prepare(spark)
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    prepare(spark)
    return quality_rules.keep(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.75 or more, the one with the smallest id."""
    prepare(spark)
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents with their places in sequences."""
    prepare(spark)
    return packing.pack(docs, "word_bpe_49k.json", end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("jaccard", one_of_similar),
    ("decontamination", drop_contaminated),
    ("packing", pack_tokens),
]

#: Learned scores, components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
