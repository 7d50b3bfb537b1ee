"""Sharding by a minimax contiguous partition.

Law ``bytes``: documents with equal texts are an atomic group; groups are ordered by the SHA-256
of their text; the ordered groups are cut into ``shards`` contiguous runs so that the largest
run's bytes are as few as possible.  That least capacity is found by search: a capacity is
feasible if greedy filling (each shard takes groups while they fit) needs no more than
``shards`` shards.

All of it is DataFrame work.  Prefix sums over the ordered groups come from two levels: sums per
slice of the hash (a fixed number of slices), and running sums within a slice.  A greedy step is
a lookup "largest prefix sum up to x" on the prefix table, which is written once in order, so a
lookup reads only the row groups around x (at most one group's size below it); each pass tries
many capacities at once.  Rows find their shard by comparing their hash with the cut hashes, and
their slot by their position in ranges of the shard's rows, so that no task holds a shard or a
group of equal rows.

Size: UTF-8 bytes of the text plus 1 (a null text has none and is its own group, apart from the
empty text).  Equal rows keep separate slots; a null doc_id is allowed; an empty table gives an
empty result.  A group larger than total/shards makes its shard larger than the others: groups
are not split.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertlens.llm.common import materialize
from alertlens.operators.ranges import with_running

SLICES = 1024  # of the hash space, for prefix sums
FANOUT = 24  # capacities tried in one pass


def _slice(key: Column) -> Column:
    """Leading bits of a hex key, as a number below SLICES."""
    return F.floor(F.conv(F.substring(key, 1, 4), 16, 10).cast("int") * SLICES / 65536).cast("int")


def keyed(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, size, text_crc32, key) of every row; ``rid`` is a number of its own."""
    raw = F.encode(F.col("text").cast("string"), "UTF-8")
    return docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce(raw, F.lit("").cast("binary"))).alias("text_crc32"),
        F.coalesce(F.sha2(raw, 256), F.sha2(F.lit("null text").cast("binary"), 224)).alias("key"),
    )


def prefix_sums(rows: DataFrame) -> DataFrame:
    """(key, bytes, upto) of every group in key order; ``upto`` includes the group."""
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes")).withColumn("slice", _slice(F.col("key")))
    groups = materialize(groups, "shard-groups")
    per = groups.groupBy("slice").agg(F.sum("bytes").alias("in_slice"))  # at most SLICES rows
    before = per.select("slice", (F.sum("in_slice").over(Window.orderBy("slice")) - F.col("in_slice")).alias("before"))
    within = F.sum("bytes").over(Window.partitionBy("slice").orderBy("key"))
    return (
        groups.withColumn("within", within).join(F.broadcast(before), "slice")
        .select("key", "bytes", (F.col("before") + F.col("within")).alias("upto"))
        .repartitionByRange("upto").sortWithinPartitions("upto")
    )


def _jump(table: DataFrame, starts: list[int], capacities: list[int], largest: int, total: int) -> list[int]:
    """For each start: the largest prefix sum up to start + capacity (the start, if none is).

    The predicate bounds keep the scan to the row groups around the targets.
    """
    goals = [min(a + c, total) for a, c in zip(starts, capacities, strict=True)]
    near = table.where((F.col("upto") > min(goals) - largest) & (F.col("upto") <= max(goals)))
    best = near.agg(*[F.max(F.when(F.col("upto") <= g, F.col("upto"))) for g in goals]).first()
    return [max(a, v or 0) for a, v in zip(starts, best, strict=True)]


def greedy(table: DataFrame, capacities: list[int], shards: int, largest: int, total: int) -> list[list[int]]:
    """For each capacity: the prefix sums at which greedy filling ends each shard."""
    at = [[0] for _ in capacities]
    for _ in range(shards):
        nxt = _jump(table, [x[-1] for x in at], capacities, largest, total)
        for x, v in zip(at, nxt, strict=True):
            x.append(v)
        if min(nxt) >= total:
            break
    return [x[1:] for x in at]


def cuts(table: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least feasible capacity and the prefix sums at its cuts."""
    total, largest = table.agg(F.max("upto"), F.max("bytes")).first()
    if total is None:
        return 0, []
    lo, hi = max(-(-total // shards), largest) - 1, -(-total // shards) + largest  # lo is not feasible, hi is
    ends = None
    while hi - lo > 1 or ends is None:
        step = max(1, -(-(hi - lo) // (FANOUT + 1)))
        tried = sorted({min(lo + step * k, hi) for k in range(1, FANOUT + 2)})
        for c, got in zip(tried, greedy(table, tried, shards, largest, total), strict=True):
            if got[-1] >= total:
                hi, ends = c, got
                break
            lo = c
    return hi, ends


def slots(rows: DataFrame) -> DataFrame:
    """Add a gapless ``slot`` per shard to rows with ``shard``; order: hash of id and text, id, key,
    row number.  Positions come from ranges of that order, which tells all rows apart: rows that
    are equal, also without an id, are spread over as many tasks as any others."""
    order = [F.col(c).asc_nulls_first() for c in ("_h", "doc_id", "key", "rid")]
    placed = with_running(rows.withColumn("_h", F.xxhash64("doc_id", "key")), order, ["shard"])
    return placed.withColumn("slot", F.col("position") - 1)


def shard(spark: SparkSession, docs: DataFrame, shards: int = 8) -> DataFrame:
    rows = materialize(keyed(docs), "shard-rows")
    table = materialize(prefix_sums(rows), "shard-prefixes")
    _, ends = cuts(table, shards)
    bounds = sorted(set(ends[:-1]))
    # the last key of every shard but the last; a shard that got nothing repeats its predecessor's end
    last = [r[0] for r in table.where(F.col("upto").isin(bounds)).orderBy("upto").select("key").collect()] if bounds else []
    number = sum((F.when(F.col("key") > k, 1).otherwise(0) for k in last), F.lit(0))
    out = slots(rows.withColumn("shard", number.cast("int")))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
