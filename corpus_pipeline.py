"""A cleaning pipeline of five stages over documents: language, near duplicates, benchmark passages, secrets, packing.

Each stage reads what its predecessor has written. Rows whose text is null have no letter and go in the first stage; texts of any
length go through whole; repeated rows are told apart by doc_id in the second, where of rows that tie for a group that with the least
hash of its text stays, and of equal ones any; further columns, whatever their names, are kept until packing, which returns pieces; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fjordlake.llm.common import documents, written
from fjordlake.llm.decontamination import drop_contaminated
from fjordlake.llm.language import fit, keep_identified
from fjordlake.llm.near_duplicates import one_of_each
from fjordlake.llm.packing import pack
from fjordlake.llm.secrets import redact_secrets


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the centroids are learned from these documents' own training share."""
    return keep_identified(docs, fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least doc_id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, with their place in the sequences."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL cannot express the trained and tokenizing stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
