"""The corpus pipeline: reject poor texts, keep one of each near-duplicate group, redact, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and is the next
stage's ``docs``. All but the last return the columns of ``documents``. A stage handles null, empty and repeated
rows as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import mixing, ngram_join, packing, pii, quality
from ledgerloom.llm.base import materialize, table
from ledgerloom.llm.entry import TOKENIZER


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, n=5, percent=80).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; rows of small sources come up to twice."""
    return mixing.mixed(docs, target_entropy=0.95, most_repeats=2.0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 tokens and at most 64 documents; attention cost is bounded by the tokens."""
    return packing.pack(docs, TOKENIZER, limit=2048, documents=64)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
