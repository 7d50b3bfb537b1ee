"""Centroid clustering with ns-bounds against plain rounds in whole numbers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np

from alertlens.llm import nsbounds

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, raw int"


def brute(rows, p):
    have = []
    for d, v in rows:
        if v is not None and len(v) == p.dim and all(x is not None and math.isfinite(x) for x in v):
            have.append((d, [math.floor(Fraction(x) * p.scale) for x in v], np.array(v, "<f8").tobytes()))
    first = sorted(have, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[2]))
    c = [x for _, x, _ in first[: p.centroids]]
    for t in range(p.rounds + 1):
        d = [[sum((a - b) ** 2 for a, b in zip(x, y, strict=True)) for y in c] for _, x, _ in have]
        at = [min(range(len(c)), key=lambda j: (r[j], j)) for r in d]
        if t < p.rounds:
            new = []
            for j, old in enumerate(c):
                mine = [x for (_, x, _), a in zip(have, at, strict=True) if a == j]
                new.append([sum(col) // len(mine) for col in zip(*mine, strict=True)] if mine else old)
            c = new
    top = 2**63 - 1
    dist = [min(r[a], top) for r, a in zip(d, at, strict=True)] if have else []
    per = {j: min(top, sum(x for x, a in zip(dist, at, strict=True) if a == j)) for j in range(len(c))}
    return sorted(((i, a, x, per[a], min(top, sum(dist)), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest())
                   for (i, _, _), a, x in zip(have, at, dist, strict=True)), key=repr)


def run(spark, rows, p, parts=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in nsbounds.clustered(spark, df, p).collect()), key=repr)


def test_clusters_ties_repeats_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((6, 64))
    rows = [(i, (centre[i % 6] + 0.2 * rng.standard_normal(64)).tolist()) for i in range(400)]
    rows += [(5000 + i, rows[3][1]) for i in range(200)]  # a third are copies
    rows += [(7, rows[8][1]), (None, rows[9][1]), (901, None), (902, [1.0] * 63), (903, []), (904, [None] * 64), (905, [math.nan] * 64)]
    p = nsbounds.Params()
    assert run(spark, rows, p) == brute(rows, p)
    few = rows[:5]  # fewer vectors than centroids
    assert run(spark, few, p) == brute(few, p)
    equal = [(i, [0.5] * 64) for i in range(40)]  # ties, empty centroids
    assert run(spark, equal, p) == brute(equal, p)
    assert run(spark, [], p) == [] == run(spark, rows[-3:], p)


def test_numbers_of_any_size(spark):
    rng = random.Random(5)
    big = [1e300, -1.7e308, 1e18, 2.5, -0.01, 0.0, 1e9]
    rows = [(i, [rng.choice(big) for _ in range(4)]) for i in range(50)]
    p = nsbounds.Params(centroids=5, rounds=4, dim=4)
    assert run(spark, rows, p, 2) == brute(rows, p)


def test_bounds_spare_most_evaluations(spark):
    rng = np.random.default_rng(6)
    centre = 3 * rng.standard_normal((16, 64))
    rows = [(i, (centre[i % 16] + 0.3 * rng.standard_normal(64)).tolist()) for i in range(2000)]
    p = nsbounds.Params(rounds=3)
    df = nsbounds.kept(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), p)
    state, history = nsbounds.rounds(df, p)
    assert len(history) == 4
    assert state.agg({"taken": "sum"}).first()[0] < 0.3 * 2000 * 16


def test_displacement_is_not_the_sum_of_drifts():
    """A centroid that comes back leaves a bound as tight as it was."""
    history = [[[0, 0]], [[30, 40]], [[0, 0]]]
    assert nsbounds.displacement(history).tolist() == [[0.0], [50.0], [0.0]]


def test_limbs():
    for v in (0, 5, -5, 2**40, -(2**200) + 3):
        assert sum(x << (40 * k) for k, x in nsbounds.limbs(v)) == v
