"""Exact top-k search by inner product with vector-approximation files.

Components are turned into integers, floor(scale x); a score is the integer inner product.

The file: vectors are dealt to blocks by a hash of their row key.  Each block has its own partition
points, the quantiles of every component over the block's rows, and a vector's approximation is
one byte a component, the number of its cell.  A cell is kept as the least and greatest value in
it, so a component with no more values than cells is approximated without loss.

Scan: a task gets one tile, the approximations of a block and a block of the queries, both
bounded.  The cells give a lower and an upper bound of every score.  A vector is a candidate if
its upper bound reaches the tile's k-th best lower bound (of two equal bounds the smaller id
counts as better, so copies don't pile up); candidates leave the tile as two row keys and two
bounds.

Reading: candidates below the k-th best lower bound of all tiles go.  Exact vectors are read in
the order of upper bounds: first the k best of each query; the k-th exact score found makes every
candidate certain whose upper bound is below it, and only the others are read as well.

Equal vectors (group of copies): a vector with more than ``k`` equal ones of smaller id can't be a
result of any query, so those rows stay out of the file.  This is a top-k with a partial step
before the shuffle, so a group of any size costs k + 1 rows a task.

Every row with an id divisible by ``every`` is a query with a list of its own, also where ids
repeat; its candidates are all rows but itself, so a row that repeats the query's id is one.
Candidates without an id are allowed; they rank last among equal scores.  Vectors that are null or
hold a null or non-finite component take no part; zero and empty vectors do.  Only vectors of
the query's dimension are candidates.  Sums that double precision can't hold exactly are taken in
whole numbers of any size; a score outside the range of long is given as the nearest long.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map, group_starts, materialize, whole_groups

EXACT = float(1 << 53)  # whole numbers below it are exact in double precision
LONG = (1 << 63) - 1
MARKS, VECTOR, QUERY = 0, 1, 2  # kinds of rows in a tile


@dataclass(frozen=True)
class Params:
    k: int = 20
    every: int = 20  # queries: ids divisible by this
    scale: int = 64
    cells: int = 64  # a component, at most 256
    rows_a_block: int = 8192
    components_a_block: int = 1 << 19  # fewer rows a block where vectors are long
    queries_a_block: int = 2048
    seed: int = 5


def finite(components: list | None) -> bytes | None:
    """The components as little-endian doubles, or None where the vector takes no part."""
    if components is None:
        return None
    v = np.array([np.nan if x is None else x for x in components], "<f8")
    return v.tobytes() if np.isfinite(v).all() else None


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale x) as doubles, which hold it exactly (infinite where it is out of range)."""
    with np.errstate(over="ignore"):
        return np.floor(x * scale)


def whole(x: float, scale: int) -> int:
    """floor(scale x) as a whole number of any size."""
    n, d = float(x).as_integer_ratio()
    return n * scale // d


def products(a: np.ndarray, b: np.ndarray, scale: int) -> list[int]:
    """The exact inner products of the rows of ``a`` and ``b`` (unscaled), as longs."""
    x, y = scaled(a, scale), scaled(b, scale)
    size = np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, x.shape[1])
    if size < EXACT:
        return (x * y).sum(1).astype(np.int64).tolist()
    out = []
    for u, v in zip(a, b, strict=True):
        s = sum(whole(p, scale) * whole(q, scale) for p, q in zip(u, v, strict=True))
        out.append(max(-LONG - 1, min(LONG, s)))
    return out


def approximated(x: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, component) and the cells' least and greatest values (component, cell)."""
    n, dim = x.shape
    codes = np.zeros((n, dim), np.uint8)
    low, high = np.zeros((dim, cells)), np.zeros((dim, cells))
    for d in range(dim):
        order = np.argsort(x[:, d], kind="stable")
        s = x[order, d]
        new = np.append(True, s[1:] != s[:-1])
        if int(new.sum()) <= cells:  # a cell for each value
            cell = np.cumsum(new) - 1
        else:  # equally filled, equal values together
            at = (np.arange(n) * cells // n)[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
            cell = np.cumsum(np.append(True, at[1:] != at[:-1])) - 1
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        low[d, : len(first)] = s[first]
        high[d, : len(first)] = s[np.append(first[1:], n) - 1]
        codes[order, d] = cell
    return codes, low, high


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (query, row) of the inner products with rows between ``low`` and
    ``high``, widened by what rounding may change."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    with np.errstate(invalid="ignore", over="ignore"):
        least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
        size = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T
        if not size.max(initial=0) < EXACT:
            slack = size * (q.shape[1] + 4) * 2.0**-52
            least, most = least - slack, most + slack
    return np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)


def reach(least: np.ndarray, most: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Which rows of each query may be among its k best; ``order`` are the rows' ids, the smaller
    the better among equal scores.  -inf in ``most`` marks a row out."""
    out = most > -np.inf
    n = least.shape[1]
    if n <= k:
        return out
    kth = np.partition(least, n - k, axis=1)[:, n - k]
    sure, tied = out & (most > kth[:, None]), out & (most == kth[:, None])
    for j in np.flatnonzero(tied.any(1)).tolist():
        # of a tie those stay that are no worse by id than the k-th best lower bound
        level = np.sort(order[least[j] == kth[j]])
        last = level[k - int((least[j] > kth[j]).sum()) - 1]
        sure[j] |= tied[j] & (order <= last)
    return sure


def _file(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """Whole blocks (dim, block, rid, vec_id, raw) -> rows (dim, block, kind, rid, vec_id, code): one
    with the block's cells, one a vector."""
    for table in whole_groups(batches, 2):
        dims, block = table.column(0).to_numpy(), table.column(1).to_numpy()
        starts = group_starts(dims, block)
        for s, e in zip(starts.tolist(), np.append(starts[1:], table.num_rows).tolist(), strict=True):
            part = table.slice(s, e - s)
            dim = int(dims[s])
            x = scaled(np.frombuffer(b"".join(part.column("raw").to_pylist()), "<f8").reshape(e - s, dim), p.scale)
            codes, low, high = approximated(x, p.cells)
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim] * (e - s + 1), pa.int32()), "block": pa.array([int(block[s])] * (e - s + 1), pa.int32()),
                "kind": pa.array([MARKS] + [VECTOR] * (e - s), pa.int32()),
                "rid": pa.array([-1, *part.column("rid").to_pylist()], pa.int64()),
                "vec_id": pa.array([None, *part.column("vec_id").to_pylist()], pa.int64()),
                "code": pa.array([np.stack([low, high]).astype("<f8").tobytes(), *(c.tobytes() for c in codes)], pa.binary()),
            })


def _scan(table: pa.Table, p: Params, chunk: int = 256) -> Iterator[pa.RecordBatch]:
    """The candidates of whole tiles: rows (dim, block, asked, kind, rid, vec_id, code)."""
    key = [table.column(i).to_numpy() for i in range(3)]
    kind, rid = table.column("kind").to_numpy(), table.column("rid").to_numpy()
    order = table.column("vec_id").fill_null(LONG).to_numpy()
    code = table.column("code").to_pylist()
    starts = group_starts(*key)
    for s, e in zip(starts.tolist(), np.append(starts[1:], table.num_rows).tolist(), strict=True):
        rows = np.arange(s, e)
        marks, vs, qs = (rows[kind[s:e] == k] for k in (MARKS, VECTOR, QUERY))
        if not len(vs) or not len(qs):
            continue
        dim = int(key[0][s])
        low, high = np.frombuffer(code[marks[0]], "<f8").reshape(2, dim, p.cells)
        codes = np.frombuffer(b"".join(code[i] for i in vs), np.uint8).reshape(len(vs), dim)
        d = np.arange(dim)
        low, high = low[d, codes], high[d, codes]
        for at in range(0, len(qs), chunk):
            part = qs[at:at + chunk]
            q = scaled(np.frombuffer(b"".join(code[i] for i in part), "<f8").reshape(len(part), dim), p.scale)
            least, most = bounds(q, low, high)
            own = rid[part][:, None] == rid[vs][None]
            least[own] = most[own] = -np.inf
            i, j = np.nonzero(reach(least, most, order[vs], p.k) & ~own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[part][i]), pa.array(rid[vs][j]), pa.array(order[vs][j]), pa.array(least[i, j]), pa.array(most[i, j])],
                names=["qrid", "rid", "ord", "least", "most"])


def _read(pairs: DataFrame, rows: DataFrame, queries: DataFrame, p: Params) -> DataFrame:
    """(qrid, rid, ord, most, score): the exact scores of candidates, from the vectors themselves."""
    def run(c: list[list]) -> dict[str, list]:
        score: list = [0] * len(c[0])
        for dim in {len(v) for v in c[4]}:
            at = [i for i, v in enumerate(c[4]) if len(v) == dim]
            a, b = (np.frombuffer(b"".join(c[k][i] for i in at), "<f8").reshape(len(at), dim // 8) for k in (4, 5))
            for i, s in zip(at, products(a, b, p.scale), strict=True):
                score[i] = s
        return {"qrid": c[0], "rid": c[1], "ord": c[2], "most": c[3], "score": score}

    both = pairs.join(rows.select("rid", "raw"), "rid").join(queries.select(F.col("rid").alias("qrid"), F.col("raw").alias("asked")), "qrid")
    return arrow_map(both.select("qrid", "rid", "ord", "most", "raw", "asked"), run,
                     "qrid bigint, rid bigint, ord bigint, most double, score bigint", rows=1024)


def prepared(vectors: DataFrame) -> DataFrame:
    """(rid, vec_id, dim, raw) of every row that takes part."""
    narrow = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("bigint").alias("vec_id"),
                            F.col("embedding").cast("array<double>").alias("embedding"))

    def run(c: list[list]) -> dict[str, list]:
        raw = [finite(v) for v in c[2]]
        return {"rid": c[0], "vec_id": c[1], "dim": [len(r) // 8 if r is not None else None for r in raw], "raw": raw}

    return arrow_map(narrow, run, "rid bigint, vec_id bigint, dim int, raw binary", rows=1024).where("raw is not null")


def search(spark: SparkSession, vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query's ``k`` best."""
    p = params
    rows = materialize(prepared(vectors), "va-rows")
    queries = rows.where(F.col("vec_id") % p.every == 0)
    copies = Window.partitionBy("dim", "raw").orderBy(F.col("vec_id").asc_nulls_last(), "rid")
    kept = rows.withColumn("_c", F.row_number().over(copies)).where(F.col("_c") <= p.k + 1).drop("_c")
    kept = materialize(kept, "va-kept")

    in_block = F.greatest(F.lit(64), F.least(F.lit(p.rows_a_block), F.expr(f"{p.components_a_block} div greatest(dim, 1)")))
    blocks = kept.groupBy("dim").agg(F.ceil(F.count("*") / F.first(in_block)).cast("int").alias("blocks"))
    asked = queries.groupBy("dim").agg(F.ceil(F.count("*") / p.queries_a_block).cast("int").alias("ask_blocks"))
    sizes = materialize(blocks.join(asked, "dim"), "va-sizes")

    def block(n: str):
        return F.pmod(F.xxhash64("rid", F.lit(p.seed)), F.col(n)).cast("int")

    dealt = kept.join(sizes, "dim").select("dim", block("blocks").alias("block"), "rid", "vec_id", "raw")
    dealt = dealt.repartition("dim", "block").sortWithinPartitions("dim", "block")
    file = materialize(dealt.mapInArrow(lambda it: _file(it, p), "dim int, block int, kind int, rid bigint, vec_id bigint, code binary"), "va-file")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["dim", "block", "asked", "kind", "rid", "vec_id", "code"]
    vectors_in = file.join(sizes, "dim").withColumn("asked", every("ask_blocks")).select(*cols)
    queries_in = queries.join(sizes, "dim").withColumns({"asked": block("ask_blocks"), "kind": F.lit(QUERY), "code": F.col("raw")})
    queries_in = queries_in.withColumn("block", every("blocks")).select(*cols)
    tile = ["dim", "block", "asked"]
    tiles = vectors_in.unionByName(queries_in).repartition(*tile).sortWithinPartitions(*tile, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            yield from _scan(table, p)

    found = materialize(tiles.mapInArrow(run, "qrid bigint, rid bigint, ord bigint, least double, most double"), "va-candidates")

    # the k-th best lower bound of all tiles; ids settle equal bounds, as in a tile
    query = Window.partitionBy("qrid")
    sure = found.withColumn("_r", F.row_number().over(query.orderBy(F.desc("least"), "ord", "rid"))).where(F.col("_r") <= p.k)
    sure = sure.groupBy("qrid").agg(F.max("_r").alias("n"), F.min(F.struct(F.col("least"), (-F.col("ord")).alias("o"))).alias("t"))
    may = found.join(sure, "qrid").where(
        (F.col("n") < p.k) | (F.col("most") > F.col("t.least")) | ((F.col("most") == F.col("t.least")) & (F.col("ord") <= -F.col("t.o"))))
    by_bound = F.row_number().over(query.orderBy(F.desc("most"), "ord", "rid"))
    may = materialize(may.select("qrid", "rid", "ord", "most").withColumn("turn", by_bound), "va-reading-order")

    first = materialize(_read(may.where(F.col("turn") <= p.k), rows, queries, p), "va-read")
    kth = first.groupBy("qrid").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("s"))
    open_ = may.where(F.col("turn") > p.k).join(kth, "qrid").where((F.col("n") < p.k) | (F.col("most") >= F.col("s") - F.abs("s") * 1e-15))
    read = first.unionByName(_read(open_, rows, queries, p))

    rank = F.row_number().over(query.orderBy(F.desc("score"), "ord", "rid"))
    best = read.withColumn("rank", rank).where(F.col("rank") <= p.k)
    best = best.join(rows.select("rid", "vec_id"), "rid").join(
        queries.select(F.col("rid").alias("qrid"), F.col("vec_id").alias("query_id")), "qrid")
    return best.select("query_id", "rank", "vec_id", "score")


def oracle_sql(params: Params = Params()) -> str:
    p = params
    usable = "embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0"
    return f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(CAST({p.scale} AS DOUBLE) * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE {usable}),
s AS (
  SELECT q.rid AS qrid, q.vec_id AS query_id, v.vec_id, v.rid, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON len(q.e) = len(v.e) AND q.rid <> v.rid WHERE q.vec_id % {p.every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qrid ORDER BY score DESC, vec_id ASC NULLS LAST, rid) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {p.k}"""
