"""Embedding near-duplicates against all pairs."""

import datetime
from decimal import Decimal

import numpy as np
import pytest

from alertlens.llm import embed_dedup as E


def brute(rows):
    """{row number: (links, component)} of (vec_id, embedding, label)."""
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, float)
        return a / np.linalg.norm(a)

    us = [unit(v) for _, v, _ in rows]
    adj = [[j for j in range(len(rows)) if j != i and us[i] is not None and us[j] is not None and rows[i][2] is not None
            and rows[i][2] == rows[j][2] and rows[i][0] is not None and rows[j][0] is not None and len(us[i]) == len(us[j])
            and us[i] @ us[j] >= 0.93] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in adj[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(adj[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def check(spark, rows, params=E.Params()):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, rep int")
    got = E.near_duplicates(spark, df, params).collect()
    # single precision in, so the brute force sees what the table holds
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(f32)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_clusters_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 32))
    rows = [(i, base[i].tolist(), int(i % 3)) for i in range(40)]
    for k in range(120):
        i = int(rng.integers(40))
        rows.append((100 + k, (base[i] + 0.04 * rng.standard_normal(32)).tolist(), int(i % 3) if k % 7 else None))
    rows += [(400 + k, base[0].tolist(), 0) for k in range(30)]  # equal vectors
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 32, 0), (503, [float("nan")] * 32, 0), (504, [None] + [1.0] * 31, 0),
             (505, [float("inf")] + [1.0] * 31, 0), (None, base[0].tolist(), 0), (506, [1.0, 0.0], 0), (507, [2.0, 0.0], 0)]
    check(spark, rows)


def test_large_buckets_are_split(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + 0.02 * rng.standard_normal(32)).tolist(), 1) for i in range(150)]
    check(spark, rows, E.Params(block=20))


def near_threshold(rng, n, dim, lo, hi):
    """Unit vectors x[:n], x[n:] whose pairs (k, n + k) have cosines spread over [lo, hi]."""
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.standard_normal((n, dim))
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    c = np.linspace(lo, hi, n)[:, None]
    return np.concatenate([x, c * x + np.sqrt(1 - c * c) * z])


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_estimate_is_unbiased_and_bounds_hold(dim):
    n, p = 4000, E.Params()
    x = near_threshold(np.random.default_rng(1), n, dim, 0.3, 1.0)
    codes = E.Codes(E.encode(x, p), x, p)
    a, b = np.arange(n), np.arange(n, 2 * n)
    true = (x[a] * x[b]).sum(1)
    # the stored bits and planes give the product of code and rotated vector, up to the grid's rounding
    y = x @ E.rotation(dim, p.seed)
    dot, moved = codes.products(a, b)
    plain = (np.where(y[a] > 0, 1, -1) * y[b]).sum(1) / np.sqrt(dim)
    assert (np.abs(dot - plain) <= moved).all() and (moved < 0.02).all()
    if dim > 3:
        assert abs((dot / codes.factor[a] - true).mean()) < 0.01
    assert (codes.most(a, b) >= true - 1e-7).all()
    assert ((x[a] * x[b]).sum(1) >= 0.93).sum() > 100 and (codes.close(a, b) == (true >= 0.93)).all()


def test_bounds_leave_few_pairs_open():
    x = np.random.default_rng(3).standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    p = E.Params()
    codes = E.Codes(E.encode(x, p), x, p)
    assert (codes.most(np.arange(2000), np.arange(2000, 4000)) >= 0.93).mean() < 0.05


def test_bands_grow_with_the_largest_label():
    p = E.Params()
    assert E.band_plan(1, p) == E.band_plan(1 << 20, p) == (24, 12)
    rng = np.random.default_rng(8)
    for largest in (1 << 20, 1 << 23, 10**8):
        bands, bits = E.band_plan(largest, p)
        assert largest / 2**bits <= p.fill
        x = near_threshold(rng, 4000, 64, 0.93, 0.931)
        k = E.band_keys(x, bands, bits, p)
        assert (k[:4000] == k[4000:]).any(1).mean() > 0.99
    work = [b * n * n / 2**w for n in (10**7, 10**9) for b, w in [E.band_plan(n, p)]]
    assert work[1] / work[0] < 100 ** 1.35


def test_pairs_around_the_threshold(spark):
    x = near_threshold(np.random.default_rng(6), 200, 64, 0.9295, 0.9305)
    check(spark, [(i, v.tolist(), i % 200 % 2) for i, v in enumerate(x)])


def test_more_bits_and_bands_in_a_job(spark):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal((10, 32))
    rows = [(i, (centre[i % 10] + 0.02 * rng.standard_normal(32)).tolist(), 1) for i in range(120)]
    check(spark, rows, E.Params(fill=1, bits=2, miss=1e-9))


@pytest.mark.parametrize("kind, one, two", [
    ("string", "a", "b"), ("double", 1.1, 1.2), ("boolean", True, False), ("binary", b"\xff", b"\xfe"), ("decimal(10,2)", Decimal("1.10"), Decimal("1.20")),
    ("array<int>", [1, None], [1]), ("date", datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)),
])
def test_labels_of_any_type(spark, kind, one, two):
    rows = [(1, [1.0, 2.0], one), (2, [1.0, 2.0], one), (3, [1.0, 2.0], two), (4, [1.0, 2.0], None), (5, [1.0, 2.0], two), (6, [1.0, 2.0], None)]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<float>, label {kind}")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.near_duplicates(spark, df).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 0, 4), (5, 1, 3), (6, 0, 6)]


def test_zero_labels_of_both_signs_are_equal(spark):
    df = spark.createDataFrame([(1, [1.0], 0.0), (2, [1.0], -0.0), (3, [1.0], float("nan")), (4, [1.0], float("nan"))], "vec_id bigint, embedding array<float>, label double")
    assert sorted((r.vec_id, r.component_id) for r in E.near_duplicates(spark, df).collect()) == [(1, 1), (2, 1), (3, 3), (4, 3)]


def test_empty(spark):
    assert E.near_duplicates(spark, spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0
