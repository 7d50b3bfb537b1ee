"""Equi-joins of the job: decisions to deliveries (J2) and history survival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.operators.dedup import JK, JN, guard_unique, with_null_safe_key
from alertlens.options import RECORD, Options


def key_equal(left, right, opts: Options = RECORD):
    """D2: 'match' -> NULL keys are equal (null-safe, still a hash/merge key); 'drop' -> never."""
    return left.eqNullSafe(right) if opts.null_keys == "match" else left == right


def join_deliveries(dec: DataFrame, deliv: DataFrame, opts: Options = RECORD, guard: bool = False) -> DataFrame:
    """One row per decision LEFT JOIN one row per decision id of the deliveries.

    Both sides are unique on the key, so the sort-merge join has no hot key.  Null-safe
    matching joins on the key columns of ``with_null_safe_key``; deliveries that come from
    ``dedup_deliveries`` (and decisions from ``dedup_decisions`` with ``keep_key``) already carry
    them and are already partitioned by them.  ``guard`` fails the job where a decision id comes out twice (W5)."""
    if opts.null_keys != "match":
        j = dec.join(deliv, dec["decision_id"] == deliv["decision_id_a"], "left")
        return guard_unique(j, ["decision_id"], "decision_id") if guard else j
    if JK not in deliv.columns:
        deliv = with_null_safe_key(deliv, "decision_id_a")
    d = dec if JK in dec.columns else with_null_safe_key(dec, "decision_id")
    j = d.join(deliv, (d[JK] == deliv[JK]) & (d[JN] == deliv[JN]), "left").drop(deliv[JK]).drop(deliv[JN])
    return (guard_unique(j, [JK, JN], "decision_id") if guard else j).drop(JK, JN)


def surviving_history(hist: DataFrame, new: DataFrame, col: str = "SnapDate") -> DataFrame:
    """History rows whose snapshot date is not among the new rows' dates.

    Written as a null-safe anti join: ``NOT IN`` would return no row at all once the list
    holds a NULL.  The right side is the distinct dates of one run (a handful of rows)."""
    dates = new.select(F.col(col).alias("__d")).distinct()
    return hist.join(dates, hist[col].eqNullSafe(dates["__d"]), "left_anti")


def replace_history(hist: DataFrame, new: DataFrame, col: str = "SnapDate", distinct: bool = False) -> DataFrame:
    """The new week plus the surviving history (query form; ``sinks.write_history``
    is the write form, which rewrites only the touched partitions)."""
    out = new.unionByName(surviving_history(hist, new, col))
    return out.distinct() if distinct else out
