"""A key that holds a third of all rows, spread over time or at one instant."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from alertlens.operators import asof
from alertlens.options import RECORD
from tests.brute import brute_effective_preference

N = 6000
T0 = dt.datetime(2024, 1, 1)
KEYS = ["source_event_id", "source_event_id_p", "dec_tm_ge_pref_tm"]


def _frames(spark, same_instant):
    step = F.when((F.col("id") % 3 == 0) & F.lit(same_instant), F.lit(0)).otherwise(F.col("id") * 997)
    base = spark.range(N).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 499).cast("string")).alias("acct"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=step)).alias("t"),
    )
    dec = base.where("id % 2 = 0").select(
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("decision_id"), F.col("id").cast("string").alias("source_event_id"),
        F.col("acct").alias("account_id"), F.lit("C").alias("customer_id"), F.col("t").alias("event_ts"))
    pref = base.where("id % 2 = 1").select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("source_event_id_p"), F.col("acct").alias("external_account_p"),
        F.lit("C").alias("cust_id_p"), F.col("t").alias("event_ts_p"), F.lit("false").alias("is_business_p"))
    return dec, pref


@pytest.mark.parametrize("same_instant", [False, True])
def test_hot_key_equals_brute_force(spark, same_instant):
    dec, pref = _frames(spark, same_instant)
    if same_instant:  # the brute force forms every pair of the hot key
        dec, pref = (df.where(F.col(c).cast("bigint") % 7 < 2) for df, c in ((dec, "source_event_id"), (pref.withColumn("n", F.substring("source_event_id_p", 2, 9)), "n")))
        pref = pref.drop("n")
    got = asof.effective_preference(dec, pref, RECORD).select(*KEYS)
    want = brute_effective_preference(dec, pref, RECORD).select(*KEYS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("same_instant", [False, True])
def test_no_window_partition_holds_a_hot_key(spark, same_instant):
    """What one window of the as-of step sees: an hour of one key, and one row per instant."""
    dec, pref = _frames(spark, same_instant)
    d = asof._keyed(dec, "account_id", "customer_id", "event_ts")
    p = asof._keyed(pref, "external_account_p", "cust_id_p", "event_ts_p").withColumn("_id", F.col("source_event_id_p"))
    assert d.groupBy(*asof.KEY).count().agg(F.max("count")).first()[0] >= N // 6
    rows = d.select(*asof.KEY, "_m").distinct().unionByName(p.select(*asof.KEY, "_m").distinct())
    worst = rows.groupBy(*asof.KEY, F.expr(f"_m div {asof.BUCKET}")).count().agg(F.max("count")).first()[0]
    assert worst <= 8  # of 2,000 rows of the hot key
    assert asof.chosen_at(d.select(*asof.KEY, "_m").distinct(), p, RECORD).count() == d.select(*asof.KEY, "_m").distinct().count()


def test_no_action_and_no_broadcast_hint(spark):
    dec, pref = _frames(spark, False)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("asof-plan", "as-of planning")
    out = asof.effective_preference(dec, pref, RECORD)
    assert not jobs.getJobIdsForGroup("asof-plan")
    plan = out._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in plan and "UnresolvedHint" not in plan
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
