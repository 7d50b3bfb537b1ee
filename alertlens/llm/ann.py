"""Approximate nearest neighbours by cross-polytope hashing.

Each table has pseudo-rotations: three rounds of seeded sign flips and a fast Hadamard transform
(vectors are padded with zeros to a power of two).  A polytope's cell is the signed axis nearest
to the rotated unit vector: the largest coordinate and its sign.  A table concatenates polytopes,
the last one over the first coordinates of its rotation only, until a cell holds at most
``rows_a_cell`` vectors on average: the number of cells grows with the table, the vectors in one
don't.  A query probes, in each table, the cells that lack least: a cell's cost is the sum over
its polytopes of the squared distance between its coordinate and the largest one.  The number of
probes grows with the 0.4th power of the number of cells, which holds the recall of vectors
without structure; the candidates of a query grow by that power too, not with the table.  All
vectors in probed cells are reranked by their exact inner product with the query.

For inner products of vectors of different lengths, an index vector gets one more coordinate,
sqrt(M^2 - |x|^2) with M the greatest length, and a query a zero there: among vectors so
completed the largest inner product is the smallest angle.  It is left out where all lengths are
equal.

Neighbouring cells (those that share their first axes) are one zone, and a query travels to a
zone once, with the list of its cells there.  A task gets one tile: a block of a zone's vectors
and a block of the queries that probe it, both bounded, so a zone that holds a large share of all
vectors is spread over many tasks.  Of equal vectors the ``k`` + 1 least ids are candidates, which
is all that a list of ``k`` can hold.  A tile returns at most ``k`` vectors a query; one that several
tables show is counted once.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without an
id, take no part.  Only vectors of the query's dimension are candidates.  A row key, not the id,
tells rows apart: each of the rows that repeat an id is a query with a list of its own (ranks from
1), a candidate of the others, and may stand in a list beside the other rows of its id.  Equal
scores are ranked by the smaller id; equal vectors tie.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map, group_starts, materialize, whole_groups
from alertlens.llm.vectors import matrix, prepared


@dataclass(frozen=True)
class Params:
    k: int = 20
    every: int = 20  # queries: ids divisible by this
    tables: int = 14
    probes: int = 10  # of a table with one polytope; more cells have more (``probes_of``)
    rows_a_cell: float = 32
    rows_a_tile: int = 4096
    queries_a_tile: int = 1024
    seed: int = 23


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, dim = x.shape
    h = 1
    while h < dim:
        x = x.reshape(n, dim // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, dim)
        h *= 2
    return x / np.sqrt(dim)


def rotated(x: np.ndarray, table: int, seed: int, polytope: int = 0) -> np.ndarray:
    rng = np.random.default_rng([seed, table, x.shape[1], polytope])
    for _ in range(3):
        x = hadamard(x * rng.choice((-1.0, 1.0), x.shape[1]))
    return x


def padded_dim(dim: int) -> int:
    return 1 << max(1, (dim - 1).bit_length())


def padded(x: np.ndarray, extra: np.ndarray | None) -> np.ndarray:
    if extra is not None:
        x = np.concatenate([x, extra[:, None]], axis=1)
    return np.pad(x, ((0, 0), (0, padded_dim(x.shape[1]) - x.shape[1])))


def polytopes(n: int, dim: int, p: Params) -> list[int]:
    """Axes of a table's polytopes for ``n`` vectors of a padded dimension: full ones but the last."""
    axes, cells = [dim], 2 * dim
    while n > p.rows_a_cell * cells:
        if axes[-1] < dim:
            axes[-1] *= 2
        else:
            axes.append(1)
        cells *= 2
    return axes


def cells_of(axes: list[int]) -> int:
    return int(np.prod([2 * d for d in axes]))


def probes_of(axes: list[int], p: Params) -> int:
    cells = cells_of(axes)
    return min(cells, int(np.ceil(p.probes * (cells / (2 * axes[0])) ** 0.4)))


def cells(x: np.ndarray, axes: list[int], table: int, probes: int, seed: int) -> np.ndarray:
    """(row, probe) -> cell of one table, least cost first: the polytopes' axes (plus their number
    if negative) as digits.  The ``probes`` least sums need only the ``probes`` least of each part."""
    cost, cell = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
    for k, d in enumerate(axes):
        y = rotated(x, table, seed, k)[:, :d]
        y = np.concatenate([y, -y], axis=1)
        more = np.argsort(-y, axis=1, kind="stable")[:, :probes] if probes > 1 else y.argmax(1)[:, None]
        lack = np.square(y.max(1)[:, None] - np.take_along_axis(y, more, 1))
        cost = (cost[:, :, None] + lack[:, None]).reshape(len(x), -1)
        cell = (cell[:, :, None] * (2 * d) + more[:, None]).reshape(len(x), -1)
        least = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        cost, cell = np.take_along_axis(cost, least, 1), np.take_along_axis(cell, least, 1)
    return cell


def zone_size(n: int, axes: list[int], p: Params) -> int:
    """Cells of a zone, a power of two: about a tile of rows, and within one axis of the first polytope."""
    size, cells = 1, cells_of(axes)
    while size * 2 * axes[0] < cells and 2 * size * n <= p.rows_a_tile * cells:
        size *= 2
    return size


def _hashed(rows: DataFrame, p: Params, query: bool) -> DataFrame:
    """(dim, tab, zone, rid, vec_id, raw, at) with one row per zone, ``at`` being the row's cells
    there; ``most``, ``flat`` and ``n`` tell the completion of index vectors and the cells."""

    def run(c: list[list]) -> dict[str, list]:
        got: list = [None] * len(c[0])
        for dim in set(c[1]):
            at = [i for i, d in enumerate(c[1]) if d == dim]
            x = matrix([c[3][i] for i in at], dim)
            norm = np.array([c[2][i] for i in at])
            most, flat, n = (c[j][at[0]] for j in (4, 5, 6))
            extra = None
            if not flat:
                extra = np.zeros(len(at)) if query else np.sqrt(np.maximum(0.0, 1 - (norm / most) ** 2))
            x = padded(x / (norm[:, None] if query else most), extra)
            axes = polytopes(n, x.shape[1], p)
            size = zone_size(n, axes, p)
            for i in at:
                got[i] = []
            for t in range(p.tables):
                cell = np.sort(cells(x, axes, t, probes_of(axes, p) if query else 1, p.seed), axis=1)
                zone = cell // size
                cut = zone[:, 1:] != zone[:, :-1]
                for i, z, k, new in zip(at, zone.tolist(), cell.astype("<i8"), cut, strict=True):
                    ends = [0, *(np.flatnonzero(new) + 1).tolist(), len(z)] if query else (0, 1)
                    got[i] += [{"tab": t, "zone": z[a], "cells": k[a:b].tobytes()} for a, b in zip(ends, ends[1:], strict=False)]
        return {"rid": c[7], "vec_id": c[0], "dim": c[1], "raw": c[3], "at": got}

    out = arrow_map(rows.select("vec_id", "dim", "norm", "raw", "most", "flat", "n", "rid"), run,
                    "rid bigint, vec_id bigint, dim int, raw binary, at array<struct<tab:int,zone:bigint,cells:binary>>", rows=256)
    return out.select("rid", "vec_id", "dim", "raw", F.explode("at").alias("at")).select("dim", "at.tab", "at.zone", "rid", "vec_id", "raw", "at.cells")


def _search(table: pa.Table, p: Params) -> pa.RecordBatch:
    """The k best of every query in whole tiles: rows (dim, tab, zone, rows block, query block,
    is_query, rid, vec_id, raw, cells)."""
    key = [table.column(i).to_numpy() for i in range(5)]
    is_query, ids, rid = (table.column(n).to_numpy() for n in ("is_query", "vec_id", "rid"))
    raw, asked = table.column("raw").to_pylist(), table.column("cells").to_pylist()
    starts = group_starts(*key)
    ends = np.append(starts[1:], table.num_rows)
    out: list[list] = [[] for _ in range(5)]
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        rows = np.arange(s, e)
        qs, vs = rows[is_query[s:e] == 1], rows[is_query[s:e] == 0]
        if not len(qs) or not len(vs):
            continue
        dim = int(key[0][s])
        cell = np.frombuffer(b"".join(asked[i] for i in vs), "<i8")
        order = np.argsort(cell, kind="stable")
        cell, vs = cell[order], vs[order]
        x, vid, vrid = matrix([raw[i] for i in vs], dim), ids[vs], rid[vs]
        for q in qs.tolist():
            want, y = np.frombuffer(asked[q], "<i8"), np.frombuffer(raw[q], "<f8")
            lo = np.searchsorted(cell, want)
            count = np.searchsorted(cell, want, "right") - lo
            at = np.repeat(lo - count.cumsum() + count, count) + np.arange(count.sum())
            at = at[vrid[at] != rid[q]]
            score = (x[at] * y).sum(1)
            if len(at) > p.k:
                near = score >= np.partition(score, len(at) - p.k)[len(at) - p.k]
                at, score = at[near], score[near]
            best = np.lexsort((vrid[at], vid[at], -score))[: p.k]
            at = at[best]
            for o, v in zip(out, (np.full(len(at), rid[q]), np.full(len(at), ids[q]), vid[at], vrid[at], score[best]), strict=True):
                o.append(v)
    cat = lambda a, t: np.concatenate(a) if a else np.zeros(0, t)
    return pa.RecordBatch.from_arrays([*(pa.array(cat(a, np.int64)) for a in out[:4]), pa.array(cat(out[4], float))],
                                      names=["qrid", "query_id", "vec_id", "rid", "score"])


def _probe(rows: DataFrame, queries: DataFrame, p: Params) -> DataFrame:
    """(qrid, query_id, vec_id, rid, score): what the tiles of these queries return."""
    index = materialize(_hashed(rows, p, query=False), "ann-index")
    asked = materialize(_hashed(queries, p, query=True), "ann-queries")
    zone = ["dim", "tab", "zone"]
    # a row for some thousand vectors of a table; Spark broadcasts it if small
    blocks = index.groupBy(*zone).agg(F.ceil(F.count("*") / p.rows_a_tile).cast("int").alias("row_blocks"))
    blocks = blocks.join(asked.groupBy(*zone).agg(F.ceil(F.count("*") / p.queries_a_tile).cast("int").alias("query_blocks")), zone)
    blocks = materialize(blocks, "ann-blocks")
    by = [*zone, "row_block", "query_block"]

    def side(df: DataFrame, own: str, other: str, is_query: int) -> DataFrame:
        block = F.pmod(F.xxhash64("rid", "tab"), F.col(f"{own}_blocks")).cast("int")
        return df.join(blocks, zone).withColumns({
            f"{own}_block": block, f"{other}_block": F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)),
        }).select(*by, F.lit(is_query).alias("is_query"), "rid", "vec_id", "raw", "cells")

    tiles = side(index, "row", "query", 0).unionByName(side(asked, "query", "row", 1)).repartition(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 5):
            yield _search(table, p)

    return tiles.mapInArrow(run, "qrid bigint, query_id bigint, vec_id bigint, rid bigint, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of every query with their ranks; a pair that several tables found has one row."""
    order = Window.partitionBy("qrid").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).dropDuplicates(["qrid", "rank"])


def search(spark: SparkSession, vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's ``k`` nearest found.  Queries that found
    fewer than ``k`` are asked again with every cell of one table, that is against all rows."""
    p = params
    rows = materialize(prepared(vectors, F.monotonically_increasing_id().alias("rid")).where("raw is not null and vec_id is not null"), "ann-rows")
    # lengths within a millionth of each other count as equal
    most = rows.groupBy("dim").agg(F.max("norm").alias("most"), (F.min("norm") >= F.max("norm") * (1 - 1e-6)).alias("flat"), F.count("*").alias("n"))
    rows = rows.join(materialize(most, "ann-norms"), "dim")
    queries = rows.where(F.col("vec_id") % p.every == 0)
    copy = F.row_number().over(Window.partitionBy("dim", "raw").orderBy("vec_id", "rid"))
    rows = rows.withColumn("copy", copy).where(F.col("copy") <= p.k + 1)
    found = materialize(_ranked(_probe(rows, queries, p), p.k), "ann-found")
    full = found.where(F.col("rank") == p.k).select(F.col("qrid").alias("rid"))
    short = materialize(queries.join(full, "rid", "left_anti"), "ann-short")
    if not short.isEmpty():
        widest = 2 * padded_dim(int(short.agg(F.max("dim")).first()[0]) + 1)
        more = _ranked(_probe(rows, short, replace(p, tables=1, probes=widest, rows_a_cell=np.inf)), p.k)
        found = found.join(short.select(F.col("rid").alias("qrid")), "qrid", "left_anti").unionByName(more)
    return found.select("query_id", "rank", "vec_id", "score")
