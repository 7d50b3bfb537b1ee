"""Keep-first, rejected duplicates, keep-latest and the stratified sample.

Keep-first / keep-latest / top-n are ``row_number() <= n`` filters: Spark plans them with a
partial ``WindowGroupLimit`` *before* the shuffle, so a hot key (say a decision id that holds
a third of all rows) arrives at its reducer as at most n rows per map task.  Rejected
duplicates are counted per distinct row and compared with the kept row, column by column: that
needs no unique id, and spreads evenly whatever the skew of the dedup key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlens.options import RECORD, Options

Order = Sequence[tuple[str, str]]  # (column, 'asc' | 'desc')


def sort_keys(order: Order, opts: Options = RECORD) -> list[Column]:
    """D5: 'sas' -> nulls first ascending, last descending; 'last' -> nulls last both ways."""
    out = []
    for name, direction in order:
        c = F.col(name)
        if direction == "desc":
            out.append(c.desc_nulls_last())
        elif opts.null_order == "sas":
            out.append(c.asc_nulls_first())
        else:
            out.append(c.asc_nulls_last())
    return out


JK, JN = "_jk", "_jn"
REPEAT = 10_000  # rows one array repeats at most


def with_null_safe_key(df: DataFrame, name: str) -> DataFrame:
    """Add (coalesce(c, ''), isnull(c)) as columns: equality on both is null-safe equality on c,
    and a frame partitioned by them can meet another one in an equi-join without a re-shuffle.
    Columns that are there already (a bucketed stage) stay, and so does its partitioning."""
    if JK in df.columns:
        return df
    c = F.col(name)
    return df.withColumns({JK: F.coalesce(c, F.lit("")), JN: c.isNull()})


def _ranked(df: DataFrame, keys, order: Order, tiebreak: str | None, opts: Options) -> Column:
    """Row number in key order; rows that tie on everything named are told apart by all their
    columns, so which one is kept does not depend on the order of arrival."""
    full = list(order) + ([(tiebreak, "asc")] if tiebreak else [])
    rest = F.struct(*[F.col(c) for c in sorted(df.columns)])
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_keys(full, opts), rest))


def top_n(df: DataFrame, keys, order: Order, n: int, tiebreak: str | None = None,
          opts: Options = RECORD) -> DataFrame:
    rn = "__rn"
    return df.withColumn(rn, _ranked(df, keys, order, tiebreak, opts)).where(F.col(rn) <= n).drop(rn)


def dedup_first(df: DataFrame, keys, order: Order, tiebreak: str | None = None,
                opts: Options = RECORD) -> DataFrame:
    """First row per key under a mixed-direction order, with a unique final tie-break."""
    return top_n(df, keys, order, 1, tiebreak, opts)


def dedup_rejects(df: DataFrame, keys: Sequence[str], order: Order, row_id: str,
                  opts: Options = RECORD) -> DataFrame:
    """Every row that ``dedup_first`` does not keep, as a multiset: of n equal rows n - 1 are
    rejected if the row is kept, else all n.  ``row_id`` is only the order's tie-break; it may
    repeat or be NULL."""
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols]).alias("__r")  # one key: nulls inside compare as equal
    kept = dedup_first(df, keys, order, row_id, opts).select(row, F.lit(1).alias("__kept"))
    counted = df.groupBy(row).agg(F.count(F.lit(1)).alias("__n"))
    left = counted.join(kept, "__r", "left").withColumn("__n", F.col("__n") - F.coalesce("__kept", F.lit(0)))
    # repeat a row __n times, by blocks so that no array grows with the count
    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(__n - 1) div {REPEAT}"))
    left = left.where(F.col("__n") > 0).withColumn("__b", F.explode(blocks))
    rows = F.least(F.lit(REPEAT).cast("bigint"), F.col("__n") - F.col("__b") * REPEAT)
    return left.withColumn("__i", F.explode(F.array_repeat(F.lit(0), rows.cast("int")))).select("__r.*")


def dedup_latest(df: DataFrame, key: str, ts: str, tiebreak: str, opts: Options = RECORD) -> DataFrame:
    """One row per key, the latest by ``ts`` (NULL times last), ties by ``tiebreak``.

    With ``null_keys='match'`` the window is partitioned by the null-safe key columns of
    ``key`` (the same groups; see ``with_null_safe_key``), which stay in the output so that
    the decision-delivery join that follows needs no second shuffle of this side."""
    if opts.null_keys == "match":
        return dedup_first(with_null_safe_key(df, key), [JK, JN], [(ts, "desc")], tiebreak, opts)
    return dedup_first(df, [key], [(ts, "desc")], tiebreak, opts)


# decision keep-first: decision time, account, customer (the decision columns of W1's order)
DECISION_ORDER: Order = (("event_ts", "asc"), ("account_id", "asc"), ("customer_id", "asc"))


def dedup_decisions(dec: DataFrame, opts: Options = RECORD, keep_key: bool = False) -> DataFrame:
    """W1.  With ``keep_key`` (and null-safe keys) the window is partitioned by the null-safe key
    columns, which stay in the output: the join with deliveries then needs no second shuffle."""
    if keep_key and opts.null_keys == "match":
        return dedup_first(with_null_safe_key(dec, "decision_id"), [JK, JN], DECISION_ORDER, "source_event_id", opts)
    return dedup_first(dec, ["decision_id"], DECISION_ORDER, "source_event_id", opts)


def decision_rejects(dec: DataFrame, opts: Options = RECORD) -> DataFrame:
    return dedup_rejects(dec, ["decision_id"], DECISION_ORDER, "source_event_id", opts)


def dedup_deliveries(deliv: DataFrame, opts: Options = RECORD) -> DataFrame:
    return dedup_latest(deliv, "decision_id_a", "event_ts_a", "source_event_id_a", opts)


def delivery_rejects(deliv: DataFrame, opts: Options = RECORD) -> DataFrame:
    return dedup_rejects(deliv, ["decision_id_a"], [("event_ts_a", "desc")], "source_event_id_a", opts)


def guard_unique(df: DataFrame, keys: Sequence[str], shown: str) -> DataFrame:
    """The rows as they are; the job fails, naming the value of ``shown``, at a second row of
    one key.  No second pass: on rows already partitioned by ``keys`` it is a running number within
    the partition, without an exchange."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(k) for k in keys]))
    text = F.concat(F.lit(f"more than one row for {shown} = "), F.coalesce(F.col(shown).cast("string"), F.lit("NULL")))
    once = F.when(F.col("__n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("__n", n).where(once).drop("__n")


def sample_order(id_col: str, seed: int) -> Column:
    """Reproducible pseudo-random order: md5 of '<seed>|<id>' (the same text in any SQL engine)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col)))


def stratified_sample(df: DataFrame, stratum: str = "decision_date", id_col: str = "decision_id",
                      n: int | None = None, seed: int | None = None, opts: Options = RECORD) -> DataFrame:
    """Simple random sample without replacement, ``n`` per stratum; a smaller stratum is
    taken whole (D20) and a NULL stratum is a stratum of its own (D19).  Exact size, unlike
    ``sampleBy`` (Bernoulli)."""
    n = opts.sample_size if n is None else n
    seed = opts.sample_seed if seed is None else seed
    w = Window.partitionBy(stratum).orderBy(sample_order(id_col, seed).asc_nulls_first(),
                                            F.col(id_col).asc_nulls_first())
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
