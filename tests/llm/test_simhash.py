"""SimHash: the index against all pairs, the fingerprint against its definition."""

import random

import numpy as np
import xxhash

from alertlens.llm import simhash


def brute_fp(text):
    words = []
    for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" "):
        if w:
            words.append(w)
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_components(rows):
    """rows: (doc_id, fp)."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    fp = np.array([f for _, f in rows], np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= 2) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return {rows[i][0]: min(d for d in groups[find(i)]) for i in range(len(rows))}


def test_fingerprint():
    for t in [None, "", " \n", "One", "One two", "A b c", "A b c d É é\x85x", "x " * 500, "The the THE the"]:
        assert simhash.fingerprint(t) == brute_fp(t)


def test_hierarchy_finds_every_pair():
    rng = np.random.default_rng(3)
    for _ in range(20):
        base = rng.integers(0, 2**64, 3, dtype=np.uint64)
        codes = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 20, (150, 3)).astype(np.uint64)).sum(1, dtype=np.uint64) for b in base]))
        rank = codes.copy()
        for s in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(s)
        codes = codes[np.argsort(rank)]
        got = {(int(a), int(b)) for x, y in simhash.node_links(codes, chunk=7) for a, b in zip(x, y, strict=True)}
        n = len(codes)
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if int(codes[i] ^ codes[j]).bit_count() <= 2}
        assert got == want


def test_documents(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(1, 120)))) for i in range(300)]
    for i in range(300, 500):  # near copies
        w = docs[rnd.randrange(300)][1].split()
        w[rnd.randrange(len(w))] = "changed"
        docs.append((i, " ".join(w)))
    docs += [(600 + i, "one short text") for i in range(50)] + [(700, None), (701, ""), (702, "")]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in docs], "doc_id bigint, text string, fp int, component_id string")
    got = {r.doc_id: r for r in simhash.near_duplicates(spark, df).collect()}
    want = brute_components([(i, brute_fp(t)) for i, t in docs])
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.fingerprint == f"{brute_fp(dict(docs)[d]):016x}" for d, r in got.items())
    kept = simhash.one_of_each(spark, df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_odd_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "quite another text here"), (9, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = simhash.near_duplicates(spark, df).collect()
    assert len(got) == 5
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 5), (5, 5), (5, 5), (9, 9)]
    assert sorted((r.doc_id or -1) for r in simhash.one_of_each(spark, df).collect()) == [-1, -1, 5, 9]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(spark, empty).count() == 0


def test_rows_that_repeat_an_id(spark):
    """Different texts under one id are different documents; the choice doesn't depend on how rows
    are dealt out; rows equal in every column leave one."""
    a, b = "the quick brown fox jumps over the lazy dog again and again", "eine ganz andere kleine Geschichte ohne jeden Bezug dazu"
    rows = [(5, a, "x"), (5, b, "x"), (9, a, "y"), (5, a, "w"), (7, "some third text of its own here", "x")] + [(7, "some third text of its own here", "x")] * 40
    got = set()
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, row string").repartition(parts)
        out = sorted(tuple(r) for r in simhash.one_of_each(spark, df).collect())
        assert [(d, t) for d, t, _ in out] == sorted([(5, a), (5, b), (7, rows[4][1])])
        got.add(tuple(out))
    assert len(got) == 1
