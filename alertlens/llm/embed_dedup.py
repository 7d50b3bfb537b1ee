"""Embedding near-duplicates by randomised-rotation binary codes.

Every unit vector x is rotated (a seeded orthogonal matrix); its code is the signs of the
rotated components, that is the corner c of the cube nearest to it, and its correction factor is
f = <c, x>.  For another rotated vector y, <c, y> / f estimates <x, y> without bias, with an
error of about sqrt((1 - f^2) / f^2 / (dim - 1)); besides, x lies at the angle arccos f from c,
so <x, y> is at most cos(angle(c, y) - arccos f).  A pair is recomputed exactly only if neither
bound excludes the threshold.

A vector is encoded once and stored: the packed bits of c, the factor f, and the rotated vector
on an even grid of 2^``planes`` steps between its least and greatest component, as packed bit
planes.  <c, y> is then ``planes`` counts of common bits a 64 components; the grid's rounding
moves it by at most sqrt(dim) * step / 2, which both bounds grant.  Vectors are scaled and
multiplied only for pairs left open.

Which pairs are estimated: vectors with the same label and dimension that agree on all bits of
at least one band of their code, over several bands of independent rotations; a pair counts in
the first band it shares.  A band gets one more bit each time the largest label doubles beyond
``fill`` x 2^``bits`` classes, and there are as many bands as keep the chance that a pair at the
threshold shares none below ``miss``; so unlike vectors share a bucket of about ``fill`` at every
size, and the work grows with about the power 1.3 of the vectors' number.  Equal vectors are one
class with a count, so a common vector costs one row.  A bucket larger than ``block`` classes is
split into blocks, and pairs of blocks go to different tasks.  Only link counts and a spanning
forest leave a task, never pairs.

Labels of any type are compared by value (0.0 equals -0.0, NaN equals NaN).  Vectors without a
label, without an id, null, empty, zero or with null or non-finite components link with nothing:
no links, their own component (null without an id).  Rows that repeat an id are vectors of their
own that share a name.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlens.llm.common import arrow_map, group_starts, materialize, whole_groups
from alertlens.llm.components import connected
from alertlens.llm.simhash import forest
from alertlens.llm.vectors import matrix, prepared, unit


@dataclass(frozen=True)
class Params:
    threshold: float = 0.93
    bits: int = 12  # of a band, at least
    fill: int = 256  # classes of a label that share a bucket by chance, before a band gets more bits
    miss: float = 0.003  # chance that a pair at the threshold shares no band
    planes: int = 8  # bits of a component on the grid
    sigmas: float = 6.0  # of the estimate's error that are granted
    block: int = 2048  # classes of a bucket that one task compares
    seed: int = 11


def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def band_plan(largest: int, p: Params) -> tuple[int, int]:
    """(bands, bits of a band) for ``largest`` classes of one label and dimension."""
    bits = min(30, max(p.bits, math.ceil(math.log2(max(1, largest) / p.fill))))
    agree = (1 - math.acos(min(1.0, p.threshold)) / math.pi) ** bits  # of a pair at the threshold, in one band
    return (1 if agree >= 1 else math.ceil(math.log(p.miss) / math.log1p(-agree))), bits


def band_keys(x: np.ndarray, bands: int, bits: int, p: Params) -> np.ndarray:
    """(row, band) -> the band's bits, from as many rotations as the bands need."""
    dim, many = x.shape[1], bands * bits
    sign = np.concatenate([x @ rotation(dim, p.seed + 1 + k) > 0 for k in range(-(-many // dim))], axis=1)[:, :many]
    return (sign.reshape(len(x), bands, bits) << np.arange(bits)).sum(2).astype("<u4")


def packed(bits: np.ndarray) -> np.ndarray:
    """The last axis as words of 64 bits."""
    by = np.packbits(bits, axis=-1)
    by = np.pad(by, [(0, 0)] * (by.ndim - 1) + [(0, -by.shape[-1] % 8)])
    return np.ascontiguousarray(by).view(np.uint64)


def encode(x: np.ndarray, p: Params) -> np.ndarray:
    """What is stored of unit vectors, a row of 64-bit words each: factor, grid's origin and step,
    sum of the grid values, the code's bits, the planes' bits."""
    dim = x.shape[1]
    y = x @ rotation(dim, p.seed)
    low = y.min(1, keepdims=True)
    step = (y.max(1, keepdims=True) - low) / ((1 << p.planes) - 1)
    q = np.rint((y - low) / np.where(step > 0, step, 1)).astype(np.int64)
    numbers = np.concatenate([np.abs(y).sum(1, keepdims=True) / np.sqrt(dim), low, step, low * dim + step * q.sum(1, keepdims=True)], axis=1)
    planes = packed(q[:, None] >> np.arange(p.planes)[:, None] & 1 == 1)
    return np.concatenate([numbers.view(np.uint64), packed(y > 0), planes.reshape(len(x), -1)], axis=1)


class Codes:
    """Stored codes of vectors of one dimension, with their components for exact products."""

    def __init__(self, stored: np.ndarray, components: np.ndarray, p: Params):
        self.p, self.dim, self.components = p, components.shape[1], components
        self.factor, self.low, self.step, self.sum = np.ascontiguousarray(stored[:, :4]).view(float).T
        words = -(-self.dim // 64)
        self.bits = stored[:, 4:4 + words]
        self.ones = np.bitwise_count(self.bits).sum(1, dtype=np.int64)
        self.planes = stored[:, 4 + words:].reshape(len(stored), p.planes, words)
        self.units, self.known = np.zeros_like(components), np.zeros(len(components), bool)

    def products(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code of a times rotated vector of b, and how far the grid may have moved it."""
        common = np.bitwise_count(self.bits[a][:, None] & self.planes[b]).sum(2, dtype=np.int64) @ (1 << np.arange(self.p.planes))
        at_ones = self.low[b] * self.ones[a] + self.step[b] * common
        return (2 * at_ones - self.sum[b]) / np.sqrt(self.dim), np.sqrt(self.dim) * self.step[b] / 2 + 1e-9

    def most(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least of both upper bounds of the cosines."""
        dot, moved = self.products(a, b)
        f = np.clip(self.factor[a], 1e-9, 1.0)
        error = self.p.sigmas * np.sqrt((1 - f * f) / (f * f) / max(1, self.dim - 1))
        nearest = np.clip(np.clip(f, dot - moved, dot + moved), -1, 1)
        angle = np.cos(np.maximum(0.0, np.abs(np.arccos(nearest) - np.arccos(f)) - 1e-9))
        return np.minimum((dot + moved) / f + error, angle)

    def exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        new = np.unique(np.concatenate([a, b]))
        new = new[~self.known[new]]
        if len(new):
            self.units[new], self.known[new] = unit(self.components[new]), True
        return np.einsum("ij,ij->i", self.units[a], self.units[b])

    def close(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs (a, b) have a cosine at or over the threshold."""
        open_ = np.flatnonzero(self.most(a, b) >= self.p.threshold - 1e-9)
        ok = np.zeros(len(a), bool)
        ok[open_] = self.exact(a[open_], b[open_]) >= self.p.threshold
        return ok


def _compare(table: pa.Table, p: Params, bands: int) -> pa.RecordBatch:
    """Links of whole buckets: rows (band, key, dim, label, left, right, block, rep, n, raw, code, keys)."""
    cols = [table.column(n).to_numpy() for n in ("band", "key", "dim", "label", "left", "right")]
    starts = group_starts(*cols)
    ends = np.append(starts[1:], table.num_rows)
    multi = ends - starts > 1
    rep, n, block = (table.column(c).to_numpy() for c in ("rep", "n", "block"))
    raw, code, keys = (table.column(c).to_pylist() for c in ("raw", "code", "keys"))
    out: tuple[list, list, list] = ([], [], [])
    # rows of several small groups of one dimension are compared together
    todo: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal todo, held
        if not todo:
            return
        rows = np.concatenate(todo)
        size = np.array([len(t) for t in todo])
        last = np.repeat(size.cumsum(), size)
        dim = int(cols[2][rows[0]])
        codes = Codes(np.frombuffer(b"".join(code[i] for i in rows), "<u8").reshape(len(rows), -1), matrix([raw[i] for i in rows], dim), p)
        k = np.frombuffer(b"".join(keys[i] for i in rows), "<u4").reshape(len(rows), bands)
        band, cross, blk = cols[0][rows], cols[4][rows] != cols[5][rows], block[rows]
        links, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
        early = np.arange(bands)
        at = np.arange(len(rows))
        for d in range(1, int(size.max())):
            at = at[at + d < last[at]]
            for lo in range(0, len(at), 1 << 14):
                a = at[lo:lo + (1 << 14)]
                b = a + d
                new = ~(cross[a] & (blk[a] == blk[b]))
                new &= ~((k[a] == k[b]) & (early < band[a][:, None])).any(1)
                a, b = a[new], b[new]
                hit = codes.close(a, b)
                a, b = a[hit], b[hit]
                if len(a):
                    np.add.at(links, a, n[rows[b]])
                    np.add.at(links, b, n[rows[a]])
                    label = forest(len(rows), a, b, label)
        got = np.flatnonzero(links)
        out[0].append(rep[rows[got]])
        out[1].append(rep[rows[label[got]]])
        out[2].append(links[got])
        todo, held = [], 0

    for s, e in zip(starts[multi].tolist(), ends[multi].tolist(), strict=True):
        if todo and (held + e - s > 8192 or cols[2][todo[0][0]] != cols[2][s]):
            flush()
        todo.append(np.arange(s, e))
        held += e - s
    flush()
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], names=["a", "b", "links"])


def label_key(vectors: DataFrame) -> Column:
    """The label as a text that is equal exactly where labels are."""
    kind, c = vectors.schema["label"].dataType, F.col("label")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0).cast(kind)  # -0.0 becomes 0.0
    elif isinstance(kind, T.BinaryType):
        c = F.hex(c)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        c = F.when(c.isNotNull(), F.to_json(F.struct(c), {"ignoreNullFields": "false"}))
    return c.cast("string").alias("label")


def near_duplicates(spark: SparkSession, vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    p = params
    every = prepared(vectors, label_key(vectors)).withColumn("digest", F.md5("raw"))
    every = materialize(every, "vec-rows")
    part = F.expr("vec_id is not null and label is not null and raw is not null")
    rows = every.where(part)
    classes = rows.groupBy("label", "dim", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min("raw").alias("raw"))
    classes = materialize(classes, "vec-classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0]
    bands, bits = band_plan(largest or 1, p)

    def keyed(c: list[list]) -> dict[str, list]:
        keys: list = [None] * len(c[0])
        code: list = [None] * len(c[0])
        for dim in set(c[1]):
            at = [i for i, d in enumerate(c[1]) if d == dim]
            x = unit(matrix([c[4][i] for i in at], dim))
            for i, k, v in zip(at, band_keys(x, bands, bits, p), encode(x, p), strict=True):
                keys[i], code[i] = k, v.astype("<u8").tobytes()
        return {"label": c[0], "dim": c[1], "rep": c[2], "n": c[3], "raw": c[4], "code": code,
                "keys": [k.tobytes() for k in keys], "bands": [k.tolist() for k in keys]}

    coded = arrow_map(classes.select("label", "dim", "rep", "n", "raw"), keyed,
                      "label string, dim int, rep bigint, n bigint, raw binary, code binary, keys binary, bands array<int>", rows=2048)
    coded = materialize(coded, "vec-codes")
    bucket = ["band", "key", "dim", "label"]
    spread = coded.select("label", "dim", "rep", "n", "raw", "code", "keys", F.posexplode("bands").alias("band", "key"))
    large = coded.select("label", "dim", F.posexplode("bands").alias("band", "key")).groupBy(*bucket).count()
    large = materialize(large.where(F.col("count") > p.block).select(*bucket, F.ceil(F.col("count") / p.block).cast("int").alias("blocks")), "vec-large")
    spread = spread.join(large, bucket, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")})
    by = [*bucket, "left", "right"]
    spread = spread.select(*by, "block", "rep", "n", "raw", "code", "keys").repartition(*by).sortWithinPartitions(*by, "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 6):
            yield _compare(table, p, bands)

    found = materialize(spread.mapInArrow(compare, "a bigint, b bigint, links bigint"), "vec-links")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    label = connected(found.select("a", "b")).withColumnRenamed("node", "rep")
    of = (
        classes.select("label", "dim", "digest", "rep", "n").join(links, "rep", "left")
        .join(label.withColumnRenamed("label", "least"), "rep", "left")
        .select("label", "dim", "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("bigint").alias("n_links"),
                F.coalesce("least", "rep").alias("component_id"))
    )
    of = materialize(of, "vec-components")
    done = rows.select("vec_id", "label", "dim", "digest").join(of, ["label", "dim", "digest"]).select("vec_id", "n_links", "component_id")
    alone = every.where(~part).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
