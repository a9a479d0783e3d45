"""The corpus pipeline: quality rules, languages, near copies, secrets, packing.

Every stage works on all rows that the stage before it kept, is written as Parquet to the shared folder and read again. Rows with
null ids or texts, repeated rows and further columns pass through as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.llm import langid, packing, quality, secrets, simhash
from barloom.llm.common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with a score of at least a half and whose code length is one of that language; the trees
    learn from this stage's input."""
    return langid.keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of the smallest id."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]
#: languages, fingerprints and packing are learned models and programs that SQL cannot express; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, fn in first:
        docs = stage(fn(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
