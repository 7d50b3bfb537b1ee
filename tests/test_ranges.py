"""Positions and running totals by ranges."""

import random

from pyspark.sql import functions as F

from alertlens.operators.aggregates import freq_crosstab, freq_oneway
from alertlens.operators.ranges import PART, with_running


def brute(rows):
    """(g, k, v) -> (position, group_rows, running, group_total), NULL first."""
    key = lambda x: (x is not None, x)
    out = {}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: key(r[1]))
        run, total = 0, sum(r[2] or 0 for r in mine)
        for i, r in enumerate(mine, 1):
            run += r[2] or 0
            out[r] = (i, len(mine), run, total)
    return out


def test_positions_and_sums_of_a_hot_and_many_small_groups(spark):
    rnd = random.Random(3)
    rows = [("hot", k, rnd.randrange(9)) for k in range(4000)] + [(None, k, 1) for k in range(50)]
    rows += [(f"g{i}", k, i) for i in range(300) for k in range(i % 4)] + [("hot", None, None)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(7)
    got = {(r.g, r.k, r.v): (r.position, r.group_rows, r.running, r.group_total)
           for r in with_running(df, [F.col("k").asc_nulls_first()], ["g"], "v").collect()}
    assert got == brute(rows)


def test_no_task_holds_a_whole_hot_group(spark):
    """The hot group's rows lie in many ranges: no window partition is the group."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id").alias("k"))
        rows = df.repartitionByRange(F.col("g"), F.col("k")).withColumn(PART, F.spark_partition_id())
        assert rows.groupBy(PART).count().agg(F.max("count")).first()[0] < 20000 / 4
        got = with_running(df, [F.col("k")], ["g"]).agg(F.sum((F.col("position") == F.col("k") + 1).cast("int"))).first()[0]
        assert got == 20000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_and_single_tables(spark):
    none = spark.createDataFrame([], "g string, k int")
    assert with_running(none, [F.col("k")], ["g"]).count() == 0
    one = spark.createDataFrame([(None, None)], "g string, k int")
    assert [tuple(r) for r in with_running(one, [F.col("k")], ["g"]).collect()] == [(None, None, 1, 1)]
    assert [tuple(r) for r in with_running(one, [F.col("k")]).collect()] == [(None, None, 1, 1)]


def test_frequency_tables_in_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("b", 2), (None, 1)], "x string, y int")
    got = [tuple(r) for r in freq_oneway(df, ("x", "y")).orderBy("variable", "position").collect()]
    assert [(r[0], r[1], r[2], r[3], r[5]) for r in got] == [
        ("x", None, 2, 1, 2), ("x", "a", 2, 2, 4), ("x", "b", 1, 3, 5),
        ("y", None, 1, 1, 1), ("y", "1", 2, 2, 3), ("y", "2", 2, 3, 5)]
    got = [tuple(r) for r in freq_crosstab(df, ("x", "y")).orderBy("position").collect()]
    assert [(r[0], r[1], r[2], r[5]) for r in got] == [
        (None, 1, 1, 1), (None, 2, 1, 2), ("a", None, 1, 3), ("a", 1, 1, 4), ("b", 2, 1, 5)]
