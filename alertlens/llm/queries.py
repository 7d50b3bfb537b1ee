"""The registered queries of this subpackage: each applies one operator, with its production
parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alertlens.llm import ann, embed_dedup, merkle, mixing, nsbounds, packing, pii, quality, sharding, simhash, substring, toxicity, vafile
from alertlens.llm.common import read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(read_table(spark, sf_dir, "documents"))


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(spark, read_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op3(spark, read_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(spark, read_table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op5(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op7(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def tokenizer_path() -> str:
    """The public tokenizer's file; any other of the same library can be given to the operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op8(spark, read_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark, read_table(spark, sf_dir, "embeddings"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(spark, read_table(spark, sf_dir, "documents"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.search(spark, read_table(spark, sf_dir, "embeddings"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nsbounds.clustered(spark, read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_substring": op2_substring,
    "op3_mixing": op3_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality": op5_quality,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_nearest": op9_nearest,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_exact_topk": op12_exact_topk,
    "op13_clustering": op13_clustering,
}

ORACLE: dict[str, str] = {
    "op3_mixing": mixing.oracle_sql(),
    "op11_merkle": merkle.oracle_sql(),
    "op12_exact_topk": vafile.oracle_sql(),
    "op13_clustering": nsbounds.oracle_sql(),
}
