"""The Merkle manifest against a plain recursive build."""

import hashlib
import zlib

import pytest

from alertlens.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, pos int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(d, source, lang, n, text):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, at):
    out = []
    for level in tree[:-1]:
        run = list(range(at // 8 * 8, min(len(level), at // 8 * 8 + 8)))
        out.append([(level[i], i == at) for i in run])
        at //= 8
    return out


def brute(rows):
    """rows (doc_id, text, lang, source, n_chars) -> sorted result tuples."""
    low = str.maketrans(merkle.UPPER, merkle.LOWER)
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, of = {}, {}
    for g in langs:
        mine = sorted((r for r in rows if r[2] == g),
                      key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1])))
        of[g] = mine
        trees[g] = levels([leaf(r[0], r[3], r[2], r[4], r[1]) for r in mine])
    top = levels([trees[g][-1][0] for g in langs])
    root = top[-1][0] if langs else None
    out = []
    for t, g in enumerate(langs):
        for i, r in enumerate(of[g]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            cur = leaf(r[0], r[3], r[2], r[4], r[1].translate(low) if hit else r[1])
            path = siblings(trees[g], i) + siblings(top, t)
            for run in path:
                cur = h(*(cur if own else x for x, own in run))
            proof = h(*(x for run in path for x, own in run if not own))
            out.append((r[0], trees[g][0][i], trees[g][-1][0], root, proof, cur, cur == root))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in merkle.verified(spark, df).collect()), key=repr)


def test_languages_ties_nulls_and_odd_texts(spark):
    rows = [(i, f"Text {i} ÄÖ İ end", ("en", "de", None, "é")[i % 7 % 4], "s", i) for i in range(700)]
    rows += [(None, "no id", "en", None, None), (None, None, "en", None, 3), (3, None, None, None, None), (3, "", "en", "", 0)]
    rows += [(9, "Same", "fr", "s", 1)] * 70 + [(10, "Alone", "zz", "s", 1), (12, "ABC" * 40000, "en", "s", 120000)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(r[6] for r in got) and any(not r[6] for r in got)


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_sizes_around_a_full_run(spark, n):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(n)]
    assert run(spark, rows) == brute(rows)


def test_every_row_its_own_language(spark):
    rows = [(i, f"T{i}", f"l{i}", "s", i) for i in range(100)]
    assert run(spark, rows) == brute(rows)


def test_row_limit_of_the_session_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    run(spark, [(1, "a", "en", "s", 1), (2, "b", "en", "s", 1)])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
