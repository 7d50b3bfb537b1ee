"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from alertlens.llm import ann


def brute(rows, p):
    ok = [(i, np.array([float(np.float32(x)) for x in v])) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, y in ok:
        if q % p.every == 0:
            s = sorted(((-float((x * y).sum()), i) for i, x in ok if i != q and len(x) == len(y)))[: p.k]
            out[q] = [(i, -v) for v, i in s]
    return out


def run(spark, rows, p):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, rank int")
    got = {}
    for r in sorted(ann.search(spark, df, p).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_all_probes_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)]  # ties
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] + [1.0] * 7), (None, [1.0] * 8), (420, [1.0, 2.0]), (440, [3.0, 1.0])]
    p = ann.Params(tables=2, probes=32, rows_a_tile=50, queries_a_tile=4)
    want = brute(rows, p)
    got = run(spark, rows, p)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_on_random_vectors(spark, spread):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= 1 + spread * rng.random((1500, 1))  # different lengths need the completion
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    p = ann.Params()
    assert recall(run(spark, rows, p), brute(rows, p)) >= 0.9


def test_recall_on_a_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    rows = [(r.vec_id, list(r.embedding)) for r in df]
    assert recall(run(spark, rows, ann.Params()), brute(rows, ann.Params())) >= 0.9


def test_few_rows(spark):
    assert run(spark, [], ann.Params()) == {}
    assert run(spark, [(20, [1.0, 0.0])], ann.Params()) == {}
    assert [i for i, _ in run(spark, [(20, [1.0, 0.0]), (3, [-1.0, 0.0])], ann.Params())[20]] == [3]


def test_repeated_ids(spark):
    """Two rows with one id are two queries, and candidates of each other."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(100)]
    rows += [(20, rows[20][1]), (40, rng.standard_normal(8).tolist()), (7, rows[7][1])]
    p = ann.Params(k=6, tables=2, probes=32, rows_a_tile=30, queries_a_tile=3)
    ok = [(i, np.array([float(np.float32(x)) for x in v])) for i, v in rows]
    want = []
    for n, (q, y) in enumerate(ok):
        if q % p.every == 0:
            s = sorted((-float((x * y).sum()), i) for m, (i, x) in enumerate(ok) if m != n)[: p.k]
            want += [(q, r, i, round(-v, 9)) for r, (v, i) in enumerate(s, 1)]
    for parts in (1, 4):
        df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, rank int").repartition(parts)
        got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.search(spark, df, p).collect()]
        assert sorted(got) == sorted(want)


def test_cells_grow_with_the_table():
    p = ann.Params()
    for n in (0, 500, 4096, 4097, 10**5, 10**7, 10**9):
        axes = ann.polytopes(n, 64, p)
        assert axes[:-1] == [64] * (len(axes) - 1) and n <= p.rows_a_cell * ann.cells_of(axes)
        size = ann.zone_size(n, axes, p)
        assert ann.cells_of(axes) % size == 0 and size * n <= max(p.rows_a_tile, p.rows_a_cell) * ann.cells_of(axes)
    assert ann.polytopes(4096, 64, p) == [64] and ann.polytopes(4097, 64, p) == [64, 1]


def test_probes_by_cost():
    """Probes of concatenated polytopes against the plain list of all cells' costs."""
    x = ann.padded(np.random.default_rng(4).standard_normal((20, 8)), None)
    axes = [8, 8, 2]
    got = ann.cells(x, axes, 3, 40, 23)
    y = [ann.rotated(x, 3, 23, k)[:, :d] for k, d in enumerate(axes)]
    y = [np.concatenate([v, -v], axis=1) for v in y]
    for i in range(len(x)):
        costs = {(a * 16 + b) * 4 + c: sum((v[i].max() - v[i][j]) ** 2 for v, j in zip(y, (a, b, c), strict=True))
                 for a in range(16) for b in range(16) for c in range(4)}
        assert len(set(got[i].tolist())) == 40  # cells may tie
        assert np.allclose([costs[c] for c in got[i].tolist()], sorted(costs.values())[:40], rtol=0, atol=1e-12)
    assert (ann.cells(x, axes, 3, 1, 23)[:, 0] == got[:, 0]).all()


def test_concatenated_polytopes(spark):
    """Small cells: every probe is exact, a few find most."""
    rng = np.random.default_rng(5)
    centres = np.repeat(rng.standard_normal((60, 16)), 30, axis=0)
    rows = [(i, v.tolist()) for i, v in enumerate(centres + 0.5 * rng.standard_normal(centres.shape))]
    p = ann.Params(tables=1, probes=10**6, rows_a_cell=2, rows_a_tile=100, queries_a_tile=10)
    assert len(ann.polytopes(len(rows), 16, p)) > 1
    want = brute(rows, p)
    assert {q: [i for i, _ in v] for q, v in run(spark, rows, p).items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert recall(run(spark, rows, ann.Params(rows_a_cell=8)), want) >= 0.9


def test_many_copies(spark):
    """A third of all rows equal: lists hold the least ids, whatever the number of copies."""
    rng = np.random.default_rng(6)
    rows = [(i, ([1.0] * 8 if i % 3 == 0 else rng.standard_normal(8).tolist())) for i in range(600)]
    p = ann.Params(k=5, tables=2, probes=32, rows_a_tile=20, queries_a_tile=4)
    want = brute(rows, p)
    got = run(spark, rows, p)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
