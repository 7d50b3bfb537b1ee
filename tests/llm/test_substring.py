"""Repeated passages against a brute-force window table."""

import hashlib
import random

import numpy as np
import pytest

from alertlens.llm import substring as S


def brute(docs):
    """[(doc_id, n_words, n_removed, sha)] of (doc_id, text) rows."""
    least = {}
    split = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - 49):
                k = tuple(w[i:i + 50])
                least[k] = min(least.get(k, d), d)
    out = []
    for d, w in split:
        gone = np.zeros(len(w), bool)
        if d is not None:
            for i in range(len(w) - 49):
                if least[tuple(w[i:i + 50])] < d:
                    gone[i:i + 50] = True
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def check(spark, docs):
    df = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id bigint, text string, row int, parts int")
    got = sorted((tuple(r) for r in S.deduplicated(spark, df).collect()), key=str)
    assert got == brute(docs)


def corpus(seed, n=120, vocab=400):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocab)}"
    passages = [[word() for _ in range(rnd.randint(40, 130))] for _ in range(6)]
    docs = []
    for i in range(n):
        w = []
        for _ in range(rnd.randint(1, 5)):
            w += [word() for _ in range(rnd.randint(0, 60))]
            if rnd.random() < 0.5:
                p = rnd.choice(passages)
                a = rnd.randrange(len(p) // 2)
                w += p[a: rnd.randint(a, len(p))]
        if rnd.random() < 0.2 and docs:  # a near copy
            w = docs[rnd.randrange(len(docs))][1].split()
            if w:
                w[rnd.randrange(len(w))] = "edit"
        docs.append((i, " ".join(w)))
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_random_corpus(spark, seed):
    check(spark, corpus(seed))


def test_full_length_prefixes(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 1)
    check(spark, corpus(3))
    check(spark, log_like())


def test_odd_rows(spark):
    p = " ".join(f"p{i}" for i in range(60))
    rows = [(1, p), (2, p), (2, p), (2, "x " + p + " y"), (None, p), (3, None), (4, ""), (5, " \n"), (0, "a " * 300), (7, "a " * 49),
            (8, "b " * 10 + "a " * 55), (9, p.replace(" ", "\t\n")), (10, "é" * 50_000 + " " + p), (-4, p[:-4])]
    check(spark, rows)
    assert S.deduplicated(spark, spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def log_like():
    """A passage p repeated in one text (and in texts that share an id), with three tails, and
    smaller and greater documents that hold parts of it."""
    p = [f"p{i}" for i in range(70)]
    q = [*p[:60], *(f"q{i}" for i in range(30))]
    own = lambda k: [f"o{k}.{i}" for i in range(55)]
    many = [w for k in range(200) for w in [*p, *own(k % 3)]]
    return [(3, " ".join(q)), (5, " ".join(many)), (5, " ".join([*own(900), *many[:4000]])), (5, " ".join(many)), (5, " ".join(many)),
            (7, " ".join([*own(901), *q, *own(902)])), (8, " ".join([*p, *p, *p])), (2, " ".join([*own(903), *p[5:58]]))]


@pytest.mark.parametrize("again", [True, False])
def test_a_class_is_sent_once(spark, again):
    docs = log_like() if again else [r for k, r in enumerate(log_like()) if k not in (2, 3, 4)]
    check(spark, docs)
    sent = S.group_rows(S.sent_spans(spark.createDataFrame(docs, "doc_id bigint, text string"))[3])
    n = sent.count()
    assert 0 < n == sent.select("h", "c").distinct().count() < 50


def test_whole_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    check(spark, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_texts(spark):
    p = " ".join(f"p{i}" for i in range(50))
    df = spark.createDataFrame([(1, p), (2, "one " + p + " two"), (3, "three")], "doc_id bigint, text string")
    assert {r.doc_id: r.kept for r in S.deduplicated(spark, df, texts=True).collect()} == {1: None, 2: "one two", 3: None}
