"""From raw documents to packed training sequences, in stages that are written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from indicator_lake.llm import jaccard, mixing, packing, quality, secrets
from indicator_lake.llm.shipping import ship
from indicator_lake.llm.tables import stored
from indicator_lake.session import work_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.passing(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts stays: the one with the smallest id."""
    ship(spark)
    return jaccard.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts that hold them."""
    ledger = secrets.record(docs, work_folder(spark, "secret-ledger"))
    return secrets.without_secrets(docs, ledger, complete=True)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as the mix takes it."""
    return mixing.mixed(docs)


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    ship(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), encode_special_tokens=False)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mixing_sources),
    ("packing", packing_sequences),
]

#: Tokenising, hashed n-grams and random rounding have no SQL; a test checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage reads what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage{i + 1}")
    return docs
