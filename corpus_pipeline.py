"""The corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``; where a text changes, its ``n_chars`` follows.

Edge cases: an empty table passes through every stage; null texts fail the quality rules; extra columns are carried
by the first four stages whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.chunks import remove_repeats
from llm.common import given, materialize
from llm.packing import pack_documents
from llm.pii import mask_personal_data
from llm.quality import keep_good
from llm.simhash import keep_one


def _measured(docs: DataFrame) -> DataFrame:
    """The texts' lengths brought up to date."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and their host's verdict."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class that pairs of five-word Jaccard similarity of 0.8 or more connect."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur earlier in the corpus; a document of which nothing is left goes."""
    return _measured(remove_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _measured(mask_personal_data(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and place."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules), ("SimHash near-dedup", near_dedup), ("substring dedup", substring_dedup),
    ("PII", personal_data), ("best-fit packing", best_fit_packing),
]

#: Fingerprints, rolling hashes, message passing and packing have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
