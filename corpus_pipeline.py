"""The corpus pipeline: stages of (name, function) over ``documents``, each calling one operator
of ``alertlens.llm``, written as Parquet and reread as the next stage's input.

Every stage works on all rows its predecessor kept, and its decisions take effect: toxic
documents and all but one of each near-duplicate group go, personal data is replaced in the
texts, documents are left out or repeated to meet the mixing weights, and what is left is packed.
A stage before the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alertlens.llm import mixing, packing, pii, simhash, toxicity
from alertlens.llm.common import materialize, read_table
from alertlens.llm.queries import tokenizer_path


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity operator rejects."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each near-duplicate group."""
    return simhash.one_of_each(spark, docs)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every span of personal data in the texts."""
    return pii.redacted(docs)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's budget allows (0 to 2 times)."""
    return mixing.mixed(spark, docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences: one row per piece."""
    return packing.op8(spark, docs, tokenizer_path())


STAGES = [
    ("toxicity", stage_toxicity),
    ("simhash", stage_simhash),
    ("pii", stage_pii),
    ("mixing", stage_mixing),
    ("packing", stage_packing),
]

#: SQL cannot express the stages (a trained classifier, tokenizers); tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
