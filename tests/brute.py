"""Test-only brute force for J3: the plain form (many-to-many join, flag, sort,
keep first).  It forms every (decision, preference) pair of a key, so it only ever runs on
small fixtures."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertlens.functions import scalars as S
from alertlens.operators.aggregates import _with_cumulative


def brute_effective_preference(d1, pref, opts):
    if opts.null_keys == "match":
        cond = d1["account_id"].eqNullSafe(pref["external_account_p"]) & d1["customer_id"].eqNullSafe(pref["cust_id_p"])
    else:
        cond = (d1["account_id"] == pref["external_account_p"]) & (d1["customer_id"] == pref["cust_id_p"])
    j = d1.join(pref, cond, "left")
    flag = S.yn(S.gt(F.col("event_ts"), F.col("event_ts_p"), opts.nulls)).alias("dec_tm_ge_pref_tm")
    j = j.select("*", flag)
    sid = F.col("source_event_id_p")
    w = Window.partitionBy("source_event_id").orderBy(
        F.col("dec_tm_ge_pref_tm").desc(), F.col("event_ts_p").desc_nulls_last(),
        sid.asc_nulls_first() if opts.null_order == "sas" else sid.asc_nulls_last())
    return j.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def freq_oneway_separate(df: DataFrame, cols: Sequence[str], labels: dict[str, callable] | None = None) -> DataFrame:
    """A6 as one aggregate per column, unioned (the straightforward plan; kept to measure the
    grouping-sets pass against it).  Same output as ``freq_oneway``."""
    labels = labels or {}
    parts = []
    for c in cols:
        col = labels[c](F.col(c)) if c in labels else F.col(c)
        parts.append(df.groupBy(col.cast("string").alias("level")).agg(F.count(F.lit(1)).alias("frequency"))
                     .select(F.lit(c).alias("variable"), "level", "frequency"))
    agg = parts[0]
    for p in parts[1:]:
        agg = agg.unionByName(p)
    return _with_cumulative(agg, ["variable"], [F.col("level").asc_nulls_first()])
