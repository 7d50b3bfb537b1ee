"""Positions and running totals over an ordered table of any size.

A plain window without a partition (or with one hot partition) sorts everything in one task.
Here the rows are dealt by ranges of (group, order), each range is written with its number, the
ranges' counts and sums are added up per group (a group has at most one row a range there), and a
row's position is its place inside its range plus what lies in the ranges before.  A task sees one
range, whatever the number of groups and however large one of them is.

``order`` should tell the rows of a group apart: rows that tie on all of it fall into one range
and get consecutive positions in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlens.session import materialize

PART, PLACE = "__range", "__place"


def with_running(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Add ``position`` (from 1 in each group, in ``order``) and ``group_rows``; with ``value`` (a
    column of whole numbers) also ``running`` (its sum up to and with the row) and ``group_total``.
    A NULL group is a group, a NULL value counts as 0."""
    ranged = df.repartitionByRange(*[F.col(b).asc_nulls_first() for b in by], *order)
    rows = materialize(ranged.withColumn(PART, F.spark_partition_id()), "ranges")
    sums = {"n": F.count(F.lit(1)), **({"v": F.coalesce(F.sum(value), F.lit(0))} if value else {})}
    per = rows.groupBy(*by, PART).agg(*[c.alias(k) for k, c in sums.items()])
    group = Window.partitionBy(*by)
    earlier = group.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(
        *[F.col(b).alias(f"__{b}") for b in by], F.col(PART).alias("__r"),
        *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"__before_{k}") for k in sums],
        *[F.sum(k).over(group).alias(f"__all_{k}") for k in sums],
    )
    here = Window.partitionBy(PART, *by).orderBy(*order)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn(PLACE, F.row_number().over(here).cast("bigint"))
    if value:
        placed = placed.withColumn("__upto", F.coalesce(F.sum(value).over(upto), F.lit(0)))
    same = F.col(PART) == F.col("__r")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__{b}"))
    out = placed.join(offsets, same).select(
        *df.columns,
        (F.col("__before_n") + F.col(PLACE)).alias("position"), F.col("__all_n").alias("group_rows"),
        *([(F.col("__before_v") + F.col("__upto")).cast("bigint").alias("running"),
           F.col("__all_v").cast("bigint").alias("group_total")] if value else []),
    )
    return out
