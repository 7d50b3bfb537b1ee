"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree: domain, language, source.  A token budget enters at the root; every node
shares its budget among its children in proportion to their weights, none getting more than the
tokens it can give (its leaves' tokens times the most epochs allowed).  What a child cannot take
goes to its siblings by weight; since a node never gets more than its whole subtree can give,
only a shortage of all siblings together reaches their parent's siblings.  Shares are exact
integers (filling by water level over the children ordered by capacity a weight); fewer tokens
than a node has children stay unspent by rounding.

A leaf with budget b and a tokens is read b div a times in full, and of the next epoch the
prefix that fits the rest: documents in the order of a seeded hash of epoch and id, as long as
their running token count stays within the rest.  The running count is taken in two levels (sums
per hash slice, then inside a slice), so a source with a third of all rows is spread over 4096
slices.  Tokens here are words: runs other than white space (space and 9 to 13).

Null lang or source is a node of its own.  A null or empty text has no tokens: it fits every
prefix it falls in and is repeated with its leaf; a leaf without tokens gives nothing.  Rows that
repeat an id are one document (their tokens add up; it lies in the least of their leaves); rows
without an id together are one document too.  Equal hashes are taken together or not at all.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertlens.llm.common import materialize

LEVELS = ("domain", "lang", "source")
WORDS = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Params:
    budget_percent: int = 100  # of the corpus' tokens
    epochs: int = 2  # a document is repeated so many times at most
    seed: int = 17
    #: Weights by level and value; a value that is not listed weighs 1.
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=lambda: {
        "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
        "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
        "source": {},
    })


def default_domain() -> Column:
    """``documents`` has no domain: d0 to d3 by the number in the source's name, else other."""
    n = F.regexp_extract(F.col("source"), "[0-9]+", 0)
    return F.when(n != "", F.concat(F.lit("d"), F.pmod(n.cast("bigint"), F.lit(4)).cast("string"))).otherwise(F.lit("other"))


def _weight(level: str, params: Params) -> Column:
    w = F.lit(1).cast("bigint")
    for value, weight in params.weights.get(level, {}).items():
        w = F.when(F.col(level) == f"={value}", F.lit(weight).cast("bigint")).otherwise(w)
    return w


def _node(value: Column) -> Column:
    """A value as a key without nulls."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def leaves_of(docs: DataFrame, domain: Column | None = None) -> DataFrame:
    """(key, domain, lang, source, tokens), one row a document."""
    tokens = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORDS)), F.lit(0)).cast("bigint")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("key"),
        F.struct(
            _node(default_domain() if domain is None else domain).alias("domain"),
            _node(F.col("lang")).alias("lang"), _node(F.col("source")).alias("source"),
        ).alias("leaf"),
        tokens.alias("tokens"),
    )
    one = rows.groupBy("key").agg(F.min("leaf").alias("leaf"), F.sum("tokens").alias("tokens"))
    return one.select("key", "leaf.domain", "leaf.lang", "leaf.source", "tokens")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split each parent's ``budget`` over its children: ``nodes`` has the parent's columns, the
    child's ``name``, ``weight``, ``cap`` and the parent's ``budget``; the result has the child's
    own ``budget``."""
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    zero = F.lit(0).cast("bigint")
    t = nodes.withColumns({
        "all_w": F.sum("weight").over(whole),
        "w": F.coalesce(F.sum("weight").over(before), zero),
        "c": F.coalesce(F.sum("cap").over(before), zero),
    })
    t = t.withColumn("full", F.expr("cap * (all_w - w) <= weight * (budget - c)"))
    t = t.withColumns({
        "full_w": F.sum(F.when(F.col("full"), F.col("weight")).otherwise(zero)).over(whole),
        "full_c": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(zero)).over(whole),
    })
    got = F.expr("CASE WHEN full THEN cap ELSE (weight * (budget - full_c)) div (all_w - full_w) END")
    return t.withColumn("share", got).drop("budget", "all_w", "w", "c", "full", "full_w", "full_c").withColumnRenamed("share", "budget")


def budgets(leaves: DataFrame, params: Params) -> DataFrame:
    """(domain, lang, source, available, budget) per leaf, from (domain, lang, source, available)."""
    level = leaves.withColumn("cap", F.col("available") * params.epochs)
    total = leaves.agg(F.expr(f"(sum(available) * {params.budget_percent}) div 100").alias("budget"), F.lit("all").alias("root"))
    top = total.select("root", "budget")
    parent = ["root"]
    for k, name in enumerate(LEVELS):
        keys = list(LEVELS[: k + 1])
        nodes = level.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.sum("available").alias("available"))
        nodes = nodes.withColumn("weight", _weight(name, params)).withColumn("root", F.lit("all"))
        nodes = nodes.join(top, parent)
        top = materialize(share_out(nodes, parent, name).select("root", *keys, "available", "budget"), f"mix-{name}")
        parent = ["root", *keys]
        if k < len(LEVELS) - 1:
            top = top.drop("available")
    return top.select(*LEVELS, "available", "budget")


def mix(spark: SparkSession, docs: DataFrame, params: Params = Params(), domain: Column | None = None) -> DataFrame:
    """(key, domain, lang, source, tokens, copies) of every document taken at least once."""
    rows = materialize(leaves_of(docs, domain), "mix-rows")
    plan = budgets(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("available")), params).where("available > 0").selectExpr(
        *LEVELS, "budget div available AS epochs", "budget - (budget div available) * available AS rest"
    )
    h = F.md5(F.concat(F.lit(f"{params.seed}:"), F.col("epochs").cast("string"), F.lit(":"), F.col("key")).cast("binary"))
    rows = rows.join(plan, list(LEVELS)).withColumn("h", h).withColumn("slice", F.substring("h", 1, 3))
    at = [*LEVELS, "slice"]
    sums = rows.groupBy(*at).agg(F.sum("tokens").alias("n"))
    running = Window.partitionBy(*LEVELS).orderBy("slice")
    before = materialize(sums.select(*at, (F.sum("n").over(running) - F.col("n")).alias("before")), "mix-slices")
    upto = F.col("before") + F.sum("tokens").over(Window.partitionBy(*at).orderBy("h"))
    taken = rows.join(before, at).withColumn("upto", upto)
    copies = F.col("epochs") + F.when(F.col("upto") <= F.col("rest"), 1).otherwise(0)
    return taken.select("key", *LEVELS, "tokens", copies.cast("bigint").alias("copies")).where("copies > 0")


def op3(spark: SparkSession, docs: DataFrame, params: Params = Params()) -> DataFrame:
    value = lambda c: F.when(F.col(c) != "null", F.substr(F.col(c), F.lit(2))).alias(c)
    out = mix(spark, docs, params)
    return out.select(F.when(F.col("key") != "null", F.col("key")).cast("bigint").alias("doc_id"), *map(value, LEVELS), "tokens", "copies")


def mixed(spark: SparkSession, docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``docs`` itself, each row as many times as its document is taken."""
    taken = materialize(mix(spark, docs, params).select(F.col("key").alias("_mix_key"), F.col("copies").alias("_mix_copies")), "mix-taken")
    joined = docs.join(taken, F.coalesce(F.col("doc_id").cast("string"), F.lit("null")) == F.col("_mix_key"))
    repeated = joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_mix_copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle_sql(params: Params = Params()) -> str:
    """DuckDB SQL of ``op3``."""
    def weight(level: str) -> str:
        cases = " ".join(f"WHEN '={v}' THEN {w}" for v, w in params.weights.get(level, {}).items())
        return f"CASE {level} {cases} ELSE 1 END" if cases else "1"

    def level(k: int) -> str:
        keys = ", ".join(LEVELS[: k + 1])
        parent = ", ".join(("root", *LEVELS[:k]))
        up = f"b{k}"
        on = " AND ".join(f"n.{c} = p.{c}" for c in LEVELS[:k]) or "true"
        return f"""
n{k} AS (SELECT 'all' AS root, {keys}, SUM(available * {params.epochs})::BIGINT AS cap, SUM(available)::BIGINT AS available, ({weight(LEVELS[k])})::BIGINT AS weight FROM leaves GROUP BY {keys}),
s{k} AS (SELECT n.*, p.budget,
  SUM(weight) OVER (PARTITION BY {parent_cols(k, 'n')})::BIGINT AS all_w,
  COALESCE(SUM(weight) OVER (PARTITION BY {parent_cols(k, 'n')} ORDER BY cap / weight, n.{LEVELS[k]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS w,
  COALESCE(SUM(cap) OVER (PARTITION BY {parent_cols(k, 'n')} ORDER BY cap / weight, n.{LEVELS[k]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
  FROM n{k} n JOIN {up} p ON {on}),
f{k} AS (SELECT *, cap * (all_w - w) <= weight * (budget - c) AS is_full FROM s{k}),
g{k} AS (SELECT *, SUM(CASE WHEN is_full THEN weight ELSE 0 END) OVER (PARTITION BY {parent})::BIGINT AS full_w, SUM(CASE WHEN is_full THEN cap ELSE 0 END) OVER (PARTITION BY {parent})::BIGINT AS full_c FROM f{k}),
b{k + 1} AS (SELECT {keys}, available, CASE WHEN is_full THEN cap ELSE (weight * (budget - full_c)) // (all_w - full_w) END AS budget FROM g{k})"""

    def parent_cols(k: int, t: str) -> str:
        return ", ".join(f"{t}.{c}" for c in ("root", *LEVELS[:k]))

    return f"""
WITH raw AS (SELECT COALESCE(doc_id::VARCHAR, 'null') AS key,
  COALESCE('=' || CASE WHEN regexp_extract(source, '[0-9]+') <> '' THEN 'd' || (regexp_extract(source, '[0-9]+')::BIGINT % 4)::VARCHAR ELSE 'other' END, 'null') AS domain,
  COALESCE('=' || lang, 'null') AS lang, COALESCE('=' || source, 'null') AS source,
  COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens FROM documents),
rows_ AS (SELECT key, m.domain AS domain, m.lang AS lang, m.source AS source, tokens FROM (SELECT key, MIN({{'domain': domain, 'lang': lang, 'source': source}}) AS m, SUM(tokens)::BIGINT AS tokens FROM raw GROUP BY key)),
leaves AS (SELECT domain, lang, source, SUM(tokens)::BIGINT AS available FROM rows_ GROUP BY ALL),
b0 AS (SELECT 'all' AS root, (SUM(available)::BIGINT * {params.budget_percent}) // 100 AS budget FROM leaves),{",".join(level(k) for k in range(3))},
plan AS (SELECT domain, lang, source, budget // available AS epochs, budget % available AS rest FROM b3 WHERE available > 0),
hashed AS (SELECT r.*, epochs, rest, md5('{params.seed}:' || epochs::VARCHAR || ':' || key) AS h FROM rows_ r JOIN plan USING (domain, lang, source)),
ran AS (SELECT *, SUM(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h) AS upto FROM hashed),
got AS (SELECT key, domain, lang, source, tokens, epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS copies FROM ran)
SELECT CASE WHEN key <> 'null' THEN key::BIGINT END AS doc_id,
  CASE WHEN domain <> 'null' THEN substr(domain, 2) END AS domain, CASE WHEN lang <> 'null' THEN substr(lang, 2) END AS lang,
  CASE WHEN source <> 'null' THEN substr(source, 2) END AS source, tokens, copies::BIGINT AS copies FROM got WHERE copies > 0
"""
