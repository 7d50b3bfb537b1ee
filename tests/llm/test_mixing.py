"""Mixing against its SQL twin and against plain arithmetic."""

import duckdb
import pytest

from alertlens.llm import mixing


@pytest.mark.parametrize("params", [
    mixing.Params(), mixing.Params(budget_percent=30, epochs=1), mixing.Params(budget_percent=500, epochs=3, seed=5),
    mixing.Params(weights={"lang": {"fr": 90}, "domain": {}, "source": {"src0": 50}}),
])
def test_equals_sql(spark, sf_small, params):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = sorted(map(tuple, mixing.op3(spark, docs, params).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf_small}/documents.parquet')")
    assert got == sorted(con.execute(mixing.oracle_sql(params)).fetchall())
    total = docs.selectExpr("sum(regexp_count(text, '[^ \\\\t-\\\\r]+'))").first()[0]
    spent = sum(r[4] * r[5] for r in got)
    assert spent <= total * min(params.budget_percent, 100 * params.epochs) // 100
    assert all(1 <= r[5] <= params.epochs for r in got)


def test_shortage_goes_to_siblings_first(spark):
    # d0 has a small and a large source; d1 is large.  Each domain gets half; the small source's
    # shortage must be made up inside d0.
    rows = [(i, "w " * 10, "en", "src0") for i in range(2)] + [(10 + i, "w " * 10, "en", "src4") for i in range(100)]
    rows += [(500 + i, "w " * 10, "en", "src1") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    p = mixing.Params(budget_percent=50, epochs=1, weights={})
    plan = {r.source: r.budget for r in mixing.budgets(mixing.leaves_of(docs).groupBy(*mixing.LEVELS).agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "available"), p).collect()}
    assert plan == {"=src0": 20, "=src4": 485, "=src1": 505}


def test_odd_rows(spark):
    rows = [(1, None, None, None, 9), (2, "", "en", "src1", 9), (3, "a b", None, "x", 9), (3, "a b", None, "x", 9), (None, "c", "de", "src2", 9), (4, "w " * 50_000, "en", "src1", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, copies int")
    out = mixing.op3(spark, docs, mixing.Params(budget_percent=100, epochs=1, weights={})).collect()
    assert {(r.doc_id, r.tokens) for r in out} == {(2, 0), (3, 4), (None, 1), (4, 50_000)}
    back = mixing.mixed(spark, docs, mixing.Params(budget_percent=200, epochs=2, weights={}))
    assert back.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in back.collect()) == [0, 0, 2, 2, 3, 3, 3, 3, 4, 4]
    assert mixing.op3(spark, docs.limit(0)).count() == 0
