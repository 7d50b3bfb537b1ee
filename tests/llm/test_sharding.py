"""Minimax sharding against a brute-force partition."""

import zlib

import pytest
from pyspark.sql import functions as F

from alertlens.llm import sharding


def least_capacity(sizes, shards):
    """Smallest C for which greedy filling works, by trying every interval sum."""
    def need(c):
        n, fill = 1, 0
        for s in sizes:
            if s > c:
                return 10**9
            if fill + s > c:
                n, fill = n + 1, 0
            fill += s
        return n
    lo, hi = 0, sum(sizes)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if need(mid) <= shards else (mid, hi)
    return hi


def rows_of(spark, docs):
    return sharding.shard(spark, docs).collect()


def test_whole_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = rows_of(spark, docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts) and {r.doc_id for r in got} == set(texts)
    for r in got:
        b = texts[r.doc_id].encode()
        assert r["size"] == len(b) + 1 and r.text_crc32 == zlib.crc32(b) and r.law == "bytes" and r.grown_shard is None
    by_text, by_shard = {}, {}
    for r in got:
        by_text.setdefault(texts[r.doc_id], set()).add(r.shard)
        by_shard.setdefault(r.shard, []).append(r)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    keyed = sharding.keyed(docs).groupBy("key").agg(F.sum("size").alias("b")).orderBy("key").collect()
    assert max(sum(r["size"] for r in rs) for rs in by_shard.values()) == least_capacity([r.b for r in keyed], 8)


@pytest.mark.parametrize("sizes", [[5] * 40, [1000] + [3] * 30, [1], [2, 900, 2, 900], list(range(1, 60))])
def test_capacity_is_least(spark, sizes):
    docs = spark.createDataFrame([(i, f"{i:04d}" + "x" * s, 1, 2) for i, s in enumerate(sizes)], "doc_id bigint, text string, size int, key int")
    got = rows_of(spark, docs)
    groups = [r.b for r in sharding.keyed(docs).groupBy("key").agg(F.sum("size").alias("b")).orderBy("key").collect()]
    load = {}
    for r in got:
        load[r.shard] = load.get(r.shard, 0) + r["size"]
    assert len(got) == len(sizes) and max(load.values()) == least_capacity(groups, 8) and set(load) <= set(range(8))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a"), (4, "é" * 70_000)] + [(i, "same text") for i in range(10, 60)]
    got = rows_of(spark, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, r["size"]) for r in got)[:5] == [(0, 2), (1, 1), (2, 1), (2, 1), (4, 140_001)]
    assert len({r.shard for r in got if (r.doc_id or 0) >= 10}) == 1
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert rows_of(spark, spark.createDataFrame([], "doc_id bigint, text string")) == []


def test_equal_rows_without_an_id_are_spread(spark):
    """A third of the rows are equal and have no id: gapless slots, and no range holds them all."""
    from pyspark.sql import functions as F

    from alertlens.operators.ranges import PART

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(None, "same text")] * 3000 + [(i, f"text {i}") for i in range(6000)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        out = sharding.shard(spark, df).collect()
        for s in {r.shard for r in out}:
            assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
        keyed = sharding.keyed(df).withColumns({"shard": F.lit(0), "_h": F.xxhash64("doc_id", "key")})
        order = [F.col(c).asc_nulls_first() for c in ("shard", "_h", "doc_id", "key", "rid")]
        parts = keyed.where("doc_id is null").repartitionByRange(*order).groupBy(F.spark_partition_id().alias(PART)).count()
        assert parts.agg(F.max("count")).first()[0] < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
