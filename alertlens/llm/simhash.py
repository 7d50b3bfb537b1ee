"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprint: the text's ASCII capitals are lowered, words are runs of bytes other than white
space (space and 9 to 13), every 3-word shingle (joined by spaces, repeats included; fewer words:
the whole sequence) is hashed by XXH64 with seed 42, and a bit is 1 if set in over half the
hashes.  No word: zero.

Links: fingerprints that differ in at most 2 bits.  Rows are first reduced to distinct
fingerprints.  The 64 bits are cut into 6 blocks; two fingerprints within 2 bits agree on at
least 4 of them, so each of the 15 choices of 4 blocks is an upper node of the index: the
fingerprints with the same bits under its mask.  What is free below such a node is at most 22
bits, which bounds it to 2^22 fingerprints whatever the input.  Below it the fingerprints stand
in Gray order, so neighbours share long bit patterns; runs of 8 become nodes that hold the bits
their members share, runs of 8 nodes the next level, and so on.  A self-join descends from the
top by pairs of nodes and drops a pair, with everything below it, as soon as the shared bits
already differ in more than 2 places.

A node's links leave its task as a spanning forest, not as pairs, and components are merged by
star contraction.  A hot fingerprint costs one row a task; no group of copies meets in one task.

Null and empty texts have fingerprint zero and link like any other.  Rows that repeat an id keep a
fingerprint each.  An empty table gives an empty result.  A row without an id takes part through its fingerprint but never names a
component; if no row of its component has an id, component_id is null.  Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map, group_starts, materialize, whole_groups
from alertlens.llm.components import connected

SHINGLE = 3
DISTANCE = 2
BLOCKS = (11, 11, 11, 11, 10, 10)
FAN = 8


def masks(distance: int = DISTANCE) -> list[int]:
    """One mask per choice of the blocks that must agree."""
    low = np.cumsum((0, *BLOCKS)).tolist()
    block = [((1 << w) - 1) << s for w, s in zip(BLOCKS, low, strict=False)]
    return [sum(c) for c in combinations(block, len(BLOCKS) - distance)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII only, as wanted
    if not words:
        return 0
    n, joined = len(words), b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, n)
    end = (size + 1).cumsum() - 1
    k = min(shingle, n)
    first, last = (end - size)[: n - k + 1].tolist(), end[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), len(first)
    for lo in range(0, total, 65536):  # bounds the bit matrix of a very long text
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[lo:lo + 65536], last[lo:lo + 65536], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row: Column | None = None) -> DataFrame:
    """(doc_id, row, fp) of every row; fp is the fingerprint as a signed long, ``row`` a text that
    the caller wants beside it."""
    row = F.lit(None) if row is None else row
    return arrow_map(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row.cast("string").alias("row"), F.col("text").cast("string").alias("text")),
        lambda c: {"doc_id": c[0], "row": c[1], "fp": [signed(fingerprint(t, shingle)) for t in c[2]]},
        "doc_id bigint, row string, fp bigint",
    )


def gray_rank(code: Column) -> Column:
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Least index reachable by links a-b, on top of ``label``."""
    label = np.arange(n) if label is None else label
    while True:
        m = np.minimum(label[a], label[b])
        if (label[a] == m).all() and (label[b] == m).all():
            return label
        for end in (a, b):
            np.minimum.at(label, label[end], m)
            np.minimum.at(label, end, m)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt


def node_links(codes: np.ndarray, distance: int = DISTANCE, chunk: int = 1 << 13) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in Gray-ordered ``codes`` within ``distance`` bits, by descending the
    hierarchy of shared bit patterns."""
    levels = [(codes, codes)]
    while len(levels[-1][0]) > 1:
        lo, hi = levels[-1]
        at = np.arange(0, len(lo), FAN)
        levels.append((np.bitwise_and.reduceat(lo, at), np.bitwise_or.reduceat(hi, at)))
    top = len(levels) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    step = np.arange(FAN)
    while stack:
        level, a, b = stack.pop()
        lo, hi = levels[level]
        # bits that all members of both nodes share, and in which the nodes differ
        both = ~(lo[a] ^ hi[a]) & ~(lo[b] ^ hi[b])
        near = np.bitwise_count((lo[a] ^ lo[b]) & both) <= distance
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level == 0:
            yield a, b
            continue
        n = len(levels[level - 1][0])
        for s in range(0, len(a), chunk):
            x = np.broadcast_to((a[s:s + chunk, None] * FAN + step)[:, :, None], (len(a[s:s + chunk]), FAN, FAN)).ravel()
            y = np.broadcast_to((b[s:s + chunk, None] * FAN + step)[:, None, :], (len(b[s:s + chunk]), FAN, FAN)).ravel()
            ok = (x < n) & (y < n) & ((x < y) if level == 1 else (x <= y))
            stack.append((level - 1, x[ok], y[ok]))


def group_links(codes: np.ndarray, first: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """(position, least linked position) of codes linked inside their group; ``first`` are the
    positions at which groups start.  A group of up to ``FAN`` codes is one bottom node, and those
    are compared all at once; every larger group is descended from its top."""
    size = np.diff(np.append(first, len(codes)))
    label = np.arange(len(codes))
    small = np.repeat(size <= FAN, size)
    ends = np.repeat(first + size, size)
    at = np.flatnonzero(small & (np.repeat(size, size) > 1))
    for d in range(1, FAN):
        at = at[at + d < ends[at]]
        if not len(at):
            break
        hit = at[np.bitwise_count(codes[at] ^ codes[at + d]) <= distance]
        if len(hit):
            label = forest(len(codes), hit, hit + d, label)
    for s, n in zip(first[size > FAN].tolist(), size[size > FAN].tolist(), strict=True):
        part = np.arange(n)
        for a, b in node_links(codes[s:s + n], distance):
            part = forest(n, a, b, part)
        label[s:s + n] = part + s
    linked = np.flatnonzero(label != np.arange(len(codes)))
    return linked, label[linked]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (table, key, fp) sorted so that groups are together: the groups' spanning forests."""
    for table in whole_groups(batches, 2):
        t, key, fp = (c.to_numpy() for c in table.columns)
        a, b = group_links(fp.view(np.uint64), group_starts(t, key))
        yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])


def link_edges(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) over distinct fingerprints, connecting exactly those within ``distance`` bits of a
    chain of links."""
    table = F.explode(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("bigint")).alias("key"))
        for i, m in enumerate(masks(distance))
    ]))
    rows = fps.select("fp", table.alias("x")).select("x.t", "x.key", "fp")
    rows = rows.repartition("t", "key").withColumn("rank", gray_rank(F.col("fp"))).sortWithinPartitions("t", "key", "rank")
    return rows.select("t", "key", "fp").mapInArrow(_links, "a bigint, b bigint")


def _labelled(distinct: DataFrame, distance: int) -> DataFrame:
    """``distinct`` fingerprints with ``label``, the least fingerprint of their component."""
    label = materialize(connected(link_edges(distinct, distance)), "simhash-labels")
    named = distinct.join(label, F.col("fp") == F.col("node"), "left")
    return named.select(*distinct.columns, F.coalesce("label", "fp").alias("label"))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = materialize(fingerprints(docs, shingle).drop("row"), "simhash-rows")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    named = _labelled(distinct, distance)
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of = materialize(named.join(least, "label").select("fp", "component_id"), "simhash-components")
    return rows.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of every component, with all its columns: the one with the least id, of rows that
    repeat that id the least by the hash of all columns, so the choice doesn't depend on how the
    rows are dealt out.  Rows that share an id but not a component all stay.  Rows without an id
    stay; they don't represent a component that has a row with an id."""
    whole = F.sha2(F.to_json(F.struct(*[F.col(c) for c in docs.columns])).cast("binary"), 256)
    rows = materialize(fingerprints(docs, shingle, whole), "simhash-rows")
    # a fingerprint's first row by (id, hash of the row), and how often that row is there
    each = rows.where("doc_id is not null").groupBy("fp", "doc_id", "row").agg(F.count("*").alias("n"))
    best = each.groupBy("fp").agg(F.min(F.struct("doc_id", "row", "n")).alias("best"))
    distinct = rows.select("fp").distinct().join(best, "fp", "left")
    named = _labelled(materialize(distinct, "simhash-distinct"), distance)
    keep = named.groupBy("label").agg(F.min("best").alias("best")).where("best is not null")
    keep = materialize(keep.select(F.col("best.row").alias("__row"), F.col("best.n").alias("__n")), "simhash-keep")
    found = docs.withColumn("__row", whole).join(keep, "__row")
    once = found.where(F.col("__n") == 1)
    again = found.where(F.col("__n") > 1).dropDuplicates(["__row"])  # equal in every column
    return once.unionByName(again).select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
