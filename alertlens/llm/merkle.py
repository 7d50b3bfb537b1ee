"""A Merkle manifest of a table: built level by level as written node rows, checked by a recursive
query that climbs from every leaf.

H is the lowercase hex SHA-256 of the concatenated inputs; a digest enters as its hex text (the
tables hold its 32 bytes).  A row's leaf is H of its fields, each ``-`` if null, else its UTF-8
byte count, ``:`` and its value.  Leaves are ordered by id in one tree for each language; every
``FAN`` consecutive nodes (the last run may be shorter, even one) become their H until one is
left, the language's subroot.  The subroots, ordered by language, are the leaves of the top tree,
which ends in the root.

Building: positions come from ranges of (language, id), so a language may hold any share of the
rows; a level groups runs of ``FAN`` positions and is written as node rows: key (tree, level,
pos), digest, the digests of its children, and the key of its own parent.  The top tree has number
-1 and a language's tree its rank; a subroot carries its place in the top tree as well.

Checking: a recursive query starts with every leaf's digest (of the tampered row, where the check
tampers) and its parent's key.  A step joins the parent's node row, cuts the own place out of the
children's digests (what is left are the siblings, appended to the proof as a row of the step),
folds own digest and siblings into the parent's digest and goes on with that node's parent.
It ends at the root, which has none.  A step moves about 100 bytes a leaf; one aggregate at the
end puts the steps' siblings together.

Rows with a null language form a tree of their own (first), rows without an id come first in
their tree, in the order of their leaf digests, and are never tampered with.  Repeated rows and
rows that repeat an id are leaves of their own (ties by leaf digest).  Texts are hashed whole.
A lone leaf is its tree's subroot, a lone subroot the root; with no sibling at all the proof is H
of nothing.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.llm.common import materialize
from alertlens.operators.ranges import with_running

FAN = 8
TOP = -1  # the top tree's number
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ("tree", "level", "pos")


def _hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def _leaf(text: Column) -> Column:
    return _hashed(F.concat(*[_field(text if f == "text" else F.col(f)) for f in FIELDS]))


def leaves(docs: DataFrame, tampered_every: int = 3) -> DataFrame:
    """(rid, doc_id, lang, leaf, start) of every row: its digest, and the digest that the check
    starts with: of the row with A-Z of its text in lower case where ``tampered_every`` divides
    the CRC-32 of the id's decimal text, else the same."""
    named = docs.select(*FIELDS)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    hit = F.coalesce(crc % tampered_every == 0, F.lit(False))
    low = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    rows = named.select("doc_id", "lang", _leaf(F.col("text")).alias("leaf"), F.when(hit, _leaf(low)).alias("other"))
    return rows.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("lang").cast("string").alias("lang"), "leaf", F.coalesce("other", "leaf").alias("start"))


def _climb_up(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, pos, rows, digest), until every tree has one node:
    written tables of (tree, level, pos, kids, digest, rows), ``rows`` the nodes of that level."""
    out, level = [], 0
    while True:
        nodes = nodes.where(F.col("rows") > 1)
        if nodes.isEmpty():
            return out
        level += 1
        runs = nodes.groupBy("tree", "rows", F.expr(f"pos div {FAN}").alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("run"))
        kids = F.aggregate(F.col("run"), F.lit(b""), lambda a, x: F.concat(a, x["digest"]))
        nodes = materialize(runs.select(
            "tree", F.lit(level).alias("level"), F.col("up").alias("pos"), kids.alias("kids"),
            F.expr(f"(rows + {FAN - 1}) div {FAN}").alias("rows"),
        ).withColumn("digest", _hashed(_hex(F.col("kids")))), f"merkle-{name}-{level}")
        out.append(nodes)


def _stacked(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for df in levels[1:]:
        out = out.unionByName(df)
    return out


def _linked(levels: list[DataFrame], top: bool) -> DataFrame:
    """Node rows with the key of their parent: the next level of the tree, the subroot's place in
    the top tree, or none for the root."""
    last = F.col("rows") == 1
    up = {"up_tree": F.when(~last | F.lit(top), F.col("tree")).otherwise(F.lit(TOP).cast("bigint")),
          "up_level": F.when(last, 1).otherwise(F.col("level") + 1),
          "up_pos": F.when(last, F.expr(f"tree div {FAN}")).otherwise(F.expr(f"pos div {FAN}")),
          "slot": F.when(last, F.expr(f"tree % {FAN}")).otherwise(F.expr(f"pos % {FAN}")).cast("int")}
    if top:  # nothing above the root
        up = {k: F.when(~last, c) for k, c in up.items()}
    return _stacked(levels).withColumns(up)


class Manifest:
    """Written tables: ``rows`` (rid, doc_id, leaf, start, tree, pos, rows), ``nodes`` (the node
    rows of all levels, linked to their parents) and ``subroots`` (tree, digest)."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, subroots: DataFrame, root: DataFrame) -> None:
        self.rows, self.nodes, self.subroots, self.root = rows, nodes, subroots, root


def build(docs: DataFrame, tampered_every: int = 3) -> Manifest:
    rows = materialize(leaves(docs, tampered_every), "merkle-leaves")
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("rid").asc()]
    placed = with_running(rows, order, ["lang"]).select(
        "rid", "doc_id", "lang", "leaf", "start", (F.col("position") - 1).alias("pos"), F.col("group_rows").alias("rows"))
    # trees by language: the null one first, then by the bytes of the name
    langs = with_running(rows.select("lang").distinct(), [F.col("lang").cast("binary").asc_nulls_first()]).select(
        F.col("lang").alias("_lang"), (F.col("position") - 1).alias("tree"), F.col("group_rows").alias("trees"))
    placed = materialize(placed.join(materialize(langs, "merkle-trees"), F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang"),
                         "merkle-places")
    below = _climb_up(placed.select("tree", "pos", "rows", F.col("leaf").alias("digest")), "lang")
    ends = [df.where(F.col("rows") == 1).select("tree", "digest") for df in below]
    alone = placed.where(F.col("rows") == 1).select("tree", F.col("leaf").alias("digest"))
    subroots = materialize(_stacked([alone, *ends]), "merkle-subroots")
    trees = placed.select("tree", "trees").distinct()
    first = subroots.join(trees, "tree").select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"),
                                                F.col("trees").alias("rows"), "digest")
    above = _climb_up(first, "top")
    linked = [_linked(levels, top) for levels, top in ((below, False), (above, True)) if levels]
    empty = docs.sparkSession.createDataFrame(
        [], "tree bigint, level int, pos bigint, kids binary, rows bigint, digest binary, up_tree bigint, up_level int, up_pos bigint, slot int")
    nodes = materialize(_stacked([empty, *linked]), "merkle-nodes")
    root = above[-1].select("digest") if above else subroots.select("digest")
    return Manifest(placed, nodes, subroots, root)


#: One row a leaf and step: the leaf's folded digest, the siblings it met, and the node to ascend to.
CLIMB = f"""
WITH RECURSIVE climb (rid, step, folded, siblings, slot, up_tree, up_level, up_pos) AS (
  SELECT rid, 0, start, CAST(X'' AS BINARY), slot, up_tree, up_level, up_pos FROM {{start}}
  UNION ALL
  SELECT c.rid, c.step + 1,
         unhex(sha2(CAST(lower(hex(concat(substring(n.kids, 1, 32 * c.slot), c.folded, substring(n.kids, 32 * c.slot + 33, 32 * {FAN})))) AS BINARY), 256)),
         concat(substring(n.kids, 1, 32 * c.slot), substring(n.kids, 32 * c.slot + 33, 32 * {FAN})),
         n.slot, n.up_tree, n.up_level, n.up_pos
  FROM climb c JOIN {{nodes}} n ON n.tree = c.up_tree AND n.level = c.up_level AND n.pos = c.up_pos
)
SELECT rid, step, folded, siblings FROM climb
"""


def climbed(spark: SparkSession, m: Manifest) -> DataFrame:
    """(rid, step, folded, siblings): every step of every leaf, written.  The recursion's limit on
    all rows together is lifted for this one query; its depth is that of the tree."""
    lone = F.col("rows") == 1
    start = m.rows.select(
        "rid", "start", F.when(lone, F.expr(f"tree % {FAN}")).otherwise(F.expr(f"pos % {FAN}")).cast("int").alias("slot"),
        F.when(lone, F.lit(TOP).cast("bigint")).otherwise(F.col("tree")).alias("up_tree"), F.lit(1).alias("up_level"),
        F.when(lone, F.expr(f"tree div {FAN}")).otherwise(F.expr(f"pos div {FAN}")).alias("up_pos"))
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return materialize(spark.sql(CLIMB, start=start, nodes=m.nodes), "merkle-climb")
    finally:
        spark.conf.set(limit, before) if before is not None else spark.conf.unset(limit)


def verified(spark: SparkSession, docs: DataFrame, tampered_every: int = 3) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    m = build(docs, tampered_every)
    proof = F.aggregate(F.sort_array(F.collect_list(F.struct("step", "siblings"))), F.lit(b""), lambda a, x: F.concat(a, x["siblings"]))
    per = climbed(spark, m).groupBy("rid").agg(
        F.sha2(_hex(proof).cast("binary"), 256).alias("proof_sha256"), F.max_by("folded", "step").alias("folded"))
    rows = m.rows.join(per, "rid").join(m.subroots.withColumnRenamed("digest", "subroot"), "tree")
    rows = rows.join(F.broadcast(m.root.limit(1)).withColumnRenamed("digest", "root"))
    return rows.select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        "proof_sha256", _hex(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def oracle_sql(levels: int = 9, top_levels: int = 5, tampered_every: int = 3) -> str:
    """The same rows by plain grouping and joins, level by level (up to 8^levels rows a language,
    8^top_levels languages)."""
    def field(c: str) -> str:
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if f == "text" else f) for f in FIELDS) + ")"

    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    byte = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {byte}), lambda c, b: {bits}), 4294967295)"
    ctes = [
        f"""rows0 AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc} % {tampered_every} = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM documents)""",
        """leaves AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, leaf, coalesce(other, leaf) AS start,
  dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows0)""",
        "a0 AS MATERIALIZED (SELECT tree, pos, n, leaf AS digest FROM leaves)"]
    up = "SELECT tree, pos // 8 AS pos, (n + 7) // 8 AS n, sha256(string_agg(digest, '' ORDER BY pos)) AS digest FROM {0} WHERE n > 1 GROUP BY tree, pos // 8, n"
    ctes += [f"a{k} AS MATERIALIZED ({up.format(f'a{k - 1}')})" for k in range(1, levels + 1)]
    ctes.append("sub AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT tree, digest FROM a{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    ctes.append("b0 AS MATERIALIZED (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, digest FROM sub)")
    ctes += [f"b{k} AS MATERIALIZED ({up.format(f'b{k - 1}')})" for k in range(1, top_levels + 1)]
    ctes.append("root AS (" + " UNION ALL ".join(f"SELECT digest FROM b{k} WHERE n = 1" for k in range(top_levels + 1)) + ")")
    ctes.append("fa0 AS MATERIALIZED (SELECT rid, tree, pos, start AS cur, '' AS proof FROM leaves)")

    def fold(old: str, nodes: str, tree: str) -> str:
        own = f"s.pos = {old}.pos"
        return f"""SELECT {old}.rid, {old}.tree, {old}.pos // 8 AS pos,
  CASE WHEN max(s.n) IS NULL THEN any_value({old}.cur) ELSE sha256(string_agg(CASE WHEN {own} THEN {old}.cur ELSE s.digest END, '' ORDER BY s.pos)) END AS cur,
  any_value({old}.proof) || coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (NOT ({own})), '') AS proof
  FROM {old} LEFT JOIN {nodes} s ON s.tree = {tree} AND s.pos // 8 = {old}.pos // 8 AND s.n > 1 GROUP BY {old}.rid, {old}.tree, {old}.pos"""

    ctes += [f"fa{k + 1} AS MATERIALIZED ({fold(f'fa{k}', f'a{k}', f'fa{k}.tree')})" for k in range(levels)]
    ctes.append(f"fb0 AS MATERIALIZED (SELECT rid, tree, tree AS pos, cur, proof FROM fa{levels})")
    ctes += [f"fb{k + 1} AS MATERIALIZED ({fold(f'fb{k}', f'b{k}', '0')})" for k in range(top_levels)]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT l.doc_id, l.leaf, sub.digest AS subroot, root.digest AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root,
       f.cur = root.digest AS verified
FROM leaves l JOIN fb{top_levels} f ON f.rid = l.rid JOIN sub ON sub.tree = l.tree CROSS JOIN root"""
