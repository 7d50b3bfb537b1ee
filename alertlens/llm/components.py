"""Connected components of an edge table, by alternating star contractions.

A large star hooks every larger neighbour of a node onto the least node around it, a small star
every smaller one; each keeps components as they are, and a few rounds leave stars around the
least node.  Only minima are aggregated (with partial aggregation, so a hub costs a row a task),
the minima are written before they are joined, so both sides of the join are plain exchanges
that adaptive execution may split at a hub, and every round is a written table: lineage stays
short and a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import materialize


def _largest_first(a, b) -> list:
    return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]


def _star(e: DataFrame, large: bool) -> DataFrame:
    """``e``: distinct edges a > b."""
    if large:
        around = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = e
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = materialize(least.select("a", F.least("a", "m").alias("m")), "star-least")
    joined = around.join(least.hint("merge"), "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (two long columns a, b): the label is the least
    node reachable.  Nulls and self-links are ignored."""
    e = materialize(
        edges.where("a is not null and b is not null and a <> b").select(*_largest_first("a", "b")).distinct(), "edges"
    )
    mark = _mark(e)
    while mark[0]:
        e = materialize(_star(materialize(_star(e, large=True), "star-large"), large=False), "star-small")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).union(e.select("b", "b").distinct())
