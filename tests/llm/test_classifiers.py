"""Toxicity and quality: held-out accuracy, segments against brute force, odd rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertlens.llm import quality, toxicity

SF01 = "/root/testdata/sf0.1"


def held_out_accuracy(df, label):
    labels = df.sparkSession.read.parquet(f"{SF01}/labels.parquet")
    rows = df.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    good = [r for r in rows if r[1] == 1]
    bad = [r for r in rows if r[1] == 0]
    return sum(r[0] == 1 for r in good) / len(good), sum(r[0] == 0 for r in bad) / len(bad)


@pytest.mark.parametrize("op,label", [(toxicity.op7, "toxic"), (quality.op5, "quality")])
def test_held_out(spark, op, label):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = op(spark, docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in rows if r.held_out} == {r[0] for r in docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).select("doc_id").collect()}
    hit, clean = held_out_accuracy(out, label)
    assert hit >= (0.8 if label == "toxic" else 0.98) and clean >= 0.95


@pytest.mark.parametrize("op,columns", [(toxicity.op7, ["passages"]), (quality.op5, [])])
def test_odd_rows(spark, op, columns):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "x y", 1.0), (3, "x y", 1.0), (None, "z", 1.0), (5, "long " * 40_000, 1.0)],
                                 "doc_id bigint, text string, score double")
    for labels in ([(1, 0, 0), (3, 1, 1), (5, 1, 0), (None, 1, 1), (9, None, None)], []):
        out = op(spark, docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
        rows = out.collect()
        assert out.columns == ["doc_id", "held_out", "score", "predicted", *columns]
        assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1
        assert not next(r for r in rows if r.doc_id is None).held_out
    assert op(spark, docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0


def test_toxic_passages_are_cut_out(spark):
    model = toxicity.Model({"foul": 6.0, "rude*": 5.0}, (4,), 0.4, 1.0, 1e-2, 1.0, -2.0, 0.3)
    clean = "plain words go here " * 30
    text = clean + "Foul! a rudeness, FOUL" + " " + clean
    x, passages = toxicity.evidence(text, model)
    assert x > 0 and [text[a:b] for a, b, _ in passages] == ["Foul! a rudeness, FOUL"]
    assert toxicity.evidence(clean, model) == (toxicity.NONE, [])
    docs = spark.createDataFrame([(1, text, 5), (2, clean, 6)], "doc_id bigint, text string, predicted int")
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def all_maximal(scores):
    """Maximal scoring segments by the recursive definition: the best segment (shortest), then
    the rest left and right of it."""
    def go(lo, hi):
        best = None
        for a, b in itertools.combinations(range(lo, hi + 1), 2):
            s = sum(scores[a:b])
            if s > 1e-9 and (best is None or s > best[0] + 1e-9 or abs(s - best[0]) <= 1e-9 and b - a < best[2] - best[1]):
                best = (s, a, b)
        return [] if best is None else [*go(lo, best[1]), best, *go(best[2], hi)]
    return [(a, b - 1, s) for s, a, b in go(0, len(scores))]


def test_segments_equal_the_definition():
    rnd = random.Random(8)
    for _ in range(300):
        n = rnd.randint(1, 16)
        hits = [(i, rnd.choice([0.7, 1.3, 2.9])) for i in range(n) if rnd.random() < 0.4]
        scores = [-0.45] * n
        for i, s in hits:
            scores[i] = s
        got = toxicity.maximal_segments(hits, 0.45)
        want = all_maximal(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_trees_walk_like_plain_recursion():
    rng = np.random.default_rng(0)
    x = rng.random((600, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    f = quality.boost(x, y, quality.Params(rounds=20))
    assert ((f.probability(x) >= 0.5) == y).mean() > 0.95
    b = quality.binning(x, f.edges)
    for i in range(50):
        total = f.base
        for t in range(len(f.statistic)):
            node = 0
            for _ in range(f.depth):
                node = 2 * node + (2 if b[i, f.statistic[t, node]] > f.bin[t, node] else 1)
            total += f.value[t, node - (2**f.depth - 1)]
        assert abs(1 / (1 + np.exp(-total)) - f.probability(x[i:i + 1])[0]) < 1e-12


def test_passages_where_lower_case_is_longer():
    model = toxicity.Model({"foul": 6.0}, (4,), 0.4, 1.0, 1e-2, 1.0, -2.0, 0.3)
    plain = "words before it foul foul foul and after"
    for text in (plain, "İ " + plain, plain.replace("before", "beİore İİ")):
        assert [text[a:b] for a, b, _ in toxicity.evidence(text, model)[1]] == ["foul foul foul"]
