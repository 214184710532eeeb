"""A training-data pipeline: five of the operators, one after the other, over all documents.

Each stage takes what its predecessor kept, as a table: ``run`` writes a stage's rows as Parquet
into the shared folder and reads them again, so a lost executor costs tasks of one stage, and a
stage never computes another one anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlens.llm import bpe, decontaminate, jaccard_join, quality_rules, secret_scan
from eventlens.llm.common import new_dir, ship
from eventlens.llm.queries import table, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and keep enough lines of their own."""
    ship(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: shingles of five words, similarity 0.8."""
    ship(spark)
    return jaccard_join.keep_one(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark."""
    ship(spark)
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: tokens, digest of the ids, digest of what they decode to."""
    ship(spark)
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secrets),
    ("bpe", tokens),
]

#: Edit distances, the random forest and BPE have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
