"""The driver contract, and every registered query against its DuckDB twin at sf 0.001."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from alertlens.plans import queries as Q
from alertlens.plans.queries import QUERIES
from alertlens.session import materialize as write
from tests.conftest import SF001


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["alert_time", "decision_count"]
    assert sum(r.decision_count for r in rows) == 33


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert len(QUERIES) >= 55


@pytest.fixture()
def written_once(monkeypatch):
    """Many queries start from the same two tables: compute each once (the queries ``final`` and
    ``effective_preference`` still run their whole plan)."""
    final, joined, cache = Q.final_table, Q._pre_exclusion, {}
    monkeypatch.setattr(Q, "final_table", lambda spark, sf, opts=Q.FIX, materialize=False: cache.setdefault(
        ("final", opts), None) or cache.update({("final", opts): final(spark, sf, opts, True)}) or cache["final", opts])
    monkeypatch.setattr(Q, "_pre_exclusion", lambda spark, sf: cache.setdefault(
        "joined", None) or cache.update({"joined": write(joined(spark, sf), "joined")}) or cache["joined"])


def test_queries_match_oracle(spark, written_once):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF001}/events.parquet')")
    bad = []
    for name, fn in QUERIES.items():
        df = fn(spark, SF001)
        s = _canon(df.columns, [tuple(r) for r in df.collect()])
        cur = con.execute(E.oracle_sql()[name])
        d = _canon([c[0] for c in cur.description], cur.fetchall())
        if s != d:
            bad.append(name)
    assert bad == []
