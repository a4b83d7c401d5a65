"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerscope.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from ledgerscope.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; texts without letters go."""
    return language_id.drop_unknown(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over five-word shingles."""
    return jaccard_join.drop_near_duplicates(docs, size=5, threshold=(80, 100), repeats=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of their sources, once or more often."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins; copies of a document never share one."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Learned language profiles and packing can't be written in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
