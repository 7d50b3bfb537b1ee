"""Centroid clustering (Lloyd's rounds) with ns-bounds.

Components are whole numbers, floor(scale x).  The state of a vector holds, for each centroid,
the distance at its last exact evaluation and the round of it.  All centroids of all rounds are
kept (rounds x centroids vectors, two documented parameters).  In a later round a stored distance
is loosened by the norm of the centroid's total displacement since that evaluation, which is at
most the sum of its drifts a round and usually far less: downwards to a lower bound, for the
assigned centroid upwards to an upper bound.  A vector all of whose lower bounds lie above its
upper bound stays where it is.  Otherwise its assigned centroid is evaluated exactly, then every
centroid whose lower bound doesn't clear that distance, and the nearest is taken (ties: the
smaller number).

The assignments are exact: comparisons are of squared distances in whole numbers, and bounds are
widened by more than the rounding of their square roots.  A round is one map over the vectors
without a shuffle, written with its state, and one pass that adds up components: every task
returns at most centroids x components partial sums, in limbs of 40 bits, so a sum of any size is
exact.  A centroid becomes the floor of sum / count; an empty one stays.  Only centroids and sums
are on the driver.

Start: the kept vectors with the smallest hex SHA-256 of ``1:<vec_id>``; rows without an id come
last, rows that repeat an id are ordered by their components.  With fewer kept vectors than
centroids each of them starts one.  Vectors that don't have exactly ``dim`` components, or one
that is null or not finite, take no part and return no row.  Repeated ids and equal vectors keep
a row each.  Distances and inertia outside the range of long are given as the greatest long.
An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map, materialize
from alertlens.llm.vafile import EXACT, LONG, finite, scaled, whole

LIMB = 40  # bits
SLACK = 1e-12  # relative; the square root of a whole number is off by less than 2^-52
RESULT = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")


@dataclass(frozen=True)
class Params:
    centroids: int = 16
    rounds: int = 3
    dim: int = 64
    scale: int = 64


Centroids = list[list[int]]


def root(square: int) -> float:
    """The square root of a whole number of any size."""
    try:
        return math.sqrt(square)
    except OverflowError:
        try:
            return float(math.isqrt(square))
        except OverflowError:
            return math.inf


def squared(raw: np.ndarray, at: np.ndarray, to: np.ndarray, centroids: Centroids, scale: int) -> list[int]:
    """The exact squared distances of rows ``at`` of ``raw`` (unscaled) from centroids ``to``."""
    x = scaled(raw, scale)
    reach = max((abs(v) for c in centroids for v in c), default=0)
    most = np.abs(x).max(initial=0.0)
    if reach < EXACT and (most + reach) ** 2 * x.shape[1] < EXACT:
        gap = x[at] - np.array(centroids, float)[to]
        return (gap * gap).sum(1).astype(np.int64).tolist()
    return [sum((whole(v, scale) - c) ** 2 for v, c in zip(raw[i], centroids[j], strict=True)) for i, j in zip(at.tolist(), to.tolist(), strict=True)]


def displacement(history: list[Centroids]) -> np.ndarray:
    """(round, centroid) -> norm of what lies between that round's centroid and today's."""
    now = history[-1]
    return np.array([[root(sum((a - b) ** 2 for a, b in zip(c, n, strict=True))) for c, n in zip(old, now, strict=True)] for old in history])


def assign(raw: np.ndarray, cluster: np.ndarray, dist: np.ndarray, seen: np.ndarray, history: list[Centroids],
           moved: np.ndarray, scale: int) -> int:
    """One round for a batch, in place: (cluster, distance and round of each centroid's last
    evaluation).  Returns how many exact distances were taken."""
    t, now = len(history) - 1, history[-1]
    n, k = dist.shape
    rows = np.arange(n)
    exact: dict[int, dict[int, int]] = {}

    def evaluate(i: np.ndarray, j: np.ndarray) -> None:
        for a, b, s in zip(i.tolist(), j.tolist(), squared(raw, i, j, now, scale), strict=True):
            exact.setdefault(a, {})[b] = s
            dist[a, b] = root(s)
        seen[i, j] = t

    if t == 0:
        evaluate(np.repeat(rows, k), np.tile(np.arange(k), n))
        cluster[:] = [min(range(k), key=lambda b: (exact[a][b], b)) for a in range(n)]
        return n * k
    with np.errstate(invalid="ignore"):
        lower = dist - moved[seen, np.arange(k)]
        lower -= SLACK * (dist + moved[seen, np.arange(k)])
        upper = (dist[rows, cluster] + moved[seen[rows, cluster], cluster]) * (1 + SLACK)
        lower[rows, cluster] = np.inf
        open_ = np.flatnonzero(~(lower.min(1) > upper))  # also where a bound is not a number
        if not len(open_):
            return 0
        evaluate(open_, cluster[open_])
        own = dist[open_, cluster[open_]] * (1 + SLACK)
        i, j = np.nonzero(~(lower[open_] > own[:, None]))
    evaluate(open_[i], j)
    for a in open_.tolist():
        cluster[a] = min(exact[a], key=lambda b: (exact[a][b], b))
    return len(open_) + len(i)


def kept(vectors: DataFrame, p: Params) -> DataFrame:
    """(vec_id, raw) of every vector that takes part."""
    narrow = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    out = arrow_map(narrow.where(F.size("embedding") == p.dim), lambda c: {"vec_id": c[0], "raw": [finite(v) for v in c[1]]},
                    "vec_id bigint, raw binary", rows=1024)
    return out.where("raw is not null")


def first_centroids(rows: DataFrame, p: Params) -> Centroids:
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    got = rows.orderBy(key.asc_nulls_last(), "raw").limit(p.centroids).select("raw").collect()
    return [[whole(v, p.scale) for v in np.frombuffer(r[0], "<f8").tolist()] for r in got]


def next_state(state: DataFrame, history: list[Centroids], p: Params) -> DataFrame:
    """The state after an assignment to the last centroids of ``history``."""
    moved, k = displacement(history), len(history[-1])

    def run(c: list[list]) -> dict[str, list]:
        n = len(c[0])
        raw = np.frombuffer(b"".join(c[1]), "<f8").reshape(n, p.dim)
        if len(history) == 1:
            cluster, dist, seen = np.zeros(n, np.int64), np.zeros((n, k)), np.zeros((n, k), np.int64)
        else:
            cluster = np.array(c[2], np.int64)
            dist = np.frombuffer(b"".join(c[3]), "<f8").reshape(n, k).copy()
            seen = np.frombuffer(b"".join(c[4]), "<i2").reshape(n, k).astype(np.int64)
        taken = assign(raw, cluster, dist, seen, history, moved, p.scale)
        return {"vec_id": c[0], "raw": c[1], "cluster": cluster.tolist(), "dist": [d.tobytes() for d in dist],
                "seen": [s.tobytes() for s in seen.astype("<i2")], "taken": [taken] + [0] * (n - 1)}

    return arrow_map(state, run, "vec_id bigint, raw binary, cluster int, dist binary, seen binary, taken bigint", rows=2048)


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """(limb, value) of a whole number; the values carry its sign."""
    sign, total, k = (-1 if total < 0 else 1), abs(total), 0
    while total:
        yield k, sign * (total & ((1 << LIMB) - 1))
        total >>= LIMB
        k += 1


def _partial(batches: Iterator[pa.RecordBatch], k: int, p: Params) -> Iterator[pa.RecordBatch]:
    """One task's sums (cluster, pos, limb, value) and counts (pos -1)."""
    sums = [[0] * p.dim for _ in range(k)]
    counts = [0] * k
    for batch in batches:
        if not batch.num_rows:
            continue
        cluster = batch.column(0).to_numpy()
        raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<f8").reshape(-1, p.dim)
        x = scaled(raw, p.scale)
        small = np.abs(x).max(initial=0.0) * len(x) < EXACT
        for c in np.unique(cluster).tolist():
            at = cluster == c
            counts[c] += int(at.sum())
            add = x[at].sum(0).tolist() if small else [sum(whole(v, p.scale) for v in col) for col in raw[at].T.tolist()]
            sums[c] = [s + int(a) for s, a in zip(sums[c], add, strict=True)]
    rows = [(c, -1, 0, n) for c, n in enumerate(counts) if n]
    rows += [(c, d, j, v) for c in range(k) for d in range(p.dim) for j, v in limbs(sums[c][d])]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                     names=["cluster", "pos", "limb", "value"])


def moved_centroids(state: DataFrame, old: Centroids, p: Params) -> Centroids:
    k = len(old)
    parts = state.select("cluster", "raw").mapInArrow(lambda it: _partial(it, k, p), "cluster int, pos int, limb int, value bigint")
    got = parts.groupBy("cluster", "pos", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("v")).collect()
    counts = {r.cluster: int(r.v) for r in got if r.pos < 0}
    sums = [[0] * p.dim for _ in old]
    for r in got:
        if r.pos >= 0:
            sums[r.cluster][r.pos] += int(r.v) << (LIMB * r.limb)
    return [[s // counts[c] for s in sums[c]] if c in counts else old[c] for c in range(k)]


def rounds(rows: DataFrame, p: Params) -> tuple[DataFrame, list[Centroids]]:
    """The written state after the last assignment, and the centroids of every round."""
    history = [first_centroids(rows, p)]
    state = materialize(next_state(rows, history, p), "ns-state-0")
    for t in range(1, p.rounds + 1):
        history.append(moved_centroids(state, history[-1], p))
        state = materialize(next_state(state.select("vec_id", "raw", "cluster", "dist", "seen"), history, p), f"ns-state-{t}")
    return state, history


def clustered(spark: SparkSession, vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    p = params
    rows = materialize(kept(vectors, p), "ns-rows")
    if rows.isEmpty():
        return spark.createDataFrame([], RESULT)
    state, history = rounds(rows, p)
    last = history[-1]

    def run(c: list[list]) -> dict[str, list]:
        raw = np.frombuffer(b"".join(c[2]), "<f8").reshape(-1, p.dim)
        d = squared(raw, np.arange(len(raw)), np.array(c[1], np.int64), last, p.scale)
        return {"vec_id": c[0], "cluster": c[1], "distance": [min(v, LONG) for v in d]}

    out = materialize(arrow_map(state.select("vec_id", "cluster", "raw"), run, "vec_id bigint, cluster int, distance bigint", rows=2048), "ns-distances")
    per = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))  # one row a centroid
    total = {r.cluster: int(r.s) for r in per.collect()}
    facts = [(c, min(s, LONG), min(sum(total.values()), LONG), hashlib.sha256(",".join(map(str, last[c])).encode()).hexdigest())
             for c, s in sorted(total.items())]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(params: Params = Params()) -> str:
    """Plain rounds: every vector against every centroid."""
    p = params
    usable = f"embedding IS NOT NULL AND len(embedding) = {p.dim} AND list_count(embedding) = {p.dim} AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0"
    ctes = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  list_transform(embedding, lambda x: CAST(floor(CAST({p.scale} AS DOUBLE) * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE {usable})""",
            f"""c0 AS MATERIALIZED (SELECT * FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, e) - 1 AS j, e FROM v)
  WHERE j < {p.centroids})"""]
    for t in range(p.rounds + 1):
        ctes.append(f"""d{t} AS MATERIALIZED (SELECT v.rid, v.vec_id, v.e, c.j,
  CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM v CROSS JOIN c{t} c)""")
        ctes.append(f"a{t} AS MATERIALIZED (SELECT * FROM d{t} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, j) = 1)")
        if t < p.rounds:
            ctes.append(f"""s{t} AS (SELECT j, pos, sum(x) AS s, count(*) AS n FROM
  (SELECT j, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM a{t}) GROUP BY j, pos)""")
            ctes.append(f"m{t} AS (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS e FROM s{t} GROUP BY j)")
            ctes.append(f"c{t + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.e, c.e) AS e FROM c{t} c LEFT JOIN m{t} m ON m.j = c.j)")
    t = p.rounds
    return "WITH " + ",\n".join(ctes) + f"""
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{t} a JOIN c{t} c ON c.j = a.j"""
