"""Staging, publishing, exporting and guarding: the mechanisms around the job's tables."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from alertlens.operators import dedup as W
from alertlens.operators.aggregates import control_summaries, control_summary
from alertlens.operators.joins import join_deliveries
from alertlens.options import RECORD, STRICT, THIRD
from alertlens.plans import queries as Q
from alertlens.plans.scorecard import build_scorecard
from alertlens.plans.weekly import run_weekly, stage_feeds
from alertlens.sinks import writers as K
from alertlens.sources import envelope as EN
from alertlens.sources import fixture as FX
from alertlens.sources.history import read_history, scorecard_schema
from tests.conftest import SF001

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 8, 15))


def week(spark, dates, tag):
    schema = scorecard_schema()
    rows = [tuple({"SnapDate": d, "ControlRisk": tag, "Volume": 1}.get(c.name) for c in schema) for d in dates]
    return spark.createDataFrame(rows, schema)


def shown(spark, path):
    return sorted(((r.SnapDate, r.ControlRisk) for r in read_history(spark, path).collect()), key=repr)


def test_failure_between_partitions_leaves_the_old_weeks(spark, tmp_out):
    path = f"{tmp_out}/h"
    K.write_history(week(spark, [D1, D2, None], "old"), path)
    before = shown(spark, path)
    bad = week(spark, [D1, D2, None], "new").withColumn(
        "ControlRisk", F.when(F.col("SnapDate") == D2, F.raise_error(F.lit("lost"))).otherwise(F.col("ControlRisk")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        K.write_history(bad.repartition(3, "SnapDate"), path)
    assert shown(spark, path) == before


def test_failure_before_and_while_publishing(spark, tmp_out, monkeypatch):
    path = f"{tmp_out}/h"
    K.write_history(week(spark, [D1], "old"), path)
    before = shown(spark, path)

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(K, "publish", stop)
    with pytest.raises(RuntimeError):
        K.write_history(week(spark, [D1, D2], "new"), path)
    monkeypatch.undo()
    assert shown(spark, path) == before  # the new weeks are on disk, but no manifest names them
    os.makedirs(f"{path}/manifest/{2:012d}")  # a manifest whose job did not end
    assert shown(spark, path) == before
    K.write_history(week(spark, [D1, D3], "newer"), path)
    assert shown(spark, path) == [(D1, "newer"), (D3, "newer")]
    assert K.manifests(spark, path) == [1, 3]
    assert len(K.remove_superseded(spark, path)) == 2 and shown(spark, path) == [(D1, "newer"), (D3, "newer")]


def test_history_of_plain_folders_is_taken_over(spark, tmp_out):
    path = f"{tmp_out}/h"
    week(spark, [D1, D2, None], "plain").write.partitionBy("SnapDate").parquet(path)
    assert len(shown(spark, path)) == 3
    K.write_history(week(spark, [D2], "new"), path)
    assert sorted(shown(spark, path), key=repr) == sorted([(D1, "plain"), (D2, "new"), (None, "plain")], key=repr)


def test_a_first_run_that_never_published_shows_nothing(spark, tmp_out):
    path = f"{tmp_out}/h"
    week(spark, [D1], "x").write.partitionBy("SnapDate").parquet(f"{path}/data/run=a")
    assert shown(spark, path) == []


@pytest.mark.parametrize("opts", [RECORD, THIRD])
def test_bucketed_stage_needs_no_exchange(spark, tmp_out, opts):
    db = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_out}/{db}'")
    src = FX.envelope_sources(FX.read_events(spark, SF001))
    staged = stage_feeds(spark, src, None, opts, tmp_out, "x", db, buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dec = W.dedup_decisions(staged["stage_decisions"], opts, keep_key=True)
        j = join_deliveries(dec, W.dedup_deliveries(staged["stage_deliveries"], opts), opts, guard=True)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        plain = join_deliveries(W.dedup_decisions(EN.scan_decisions(src.decisions, None, opts), opts),
                                W.dedup_deliveries(EN.scan_deliveries(src.deliveries, None, opts), opts), opts)
        assert sorted(map(repr, j.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_weekly_run_on_bucketed_stages(spark, tmp_out):
    db = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_out}/{db}'")
    src = FX.envelope_sources(FX.read_events(spark, SF001))
    res = run_weekly(spark, src, Q.REPORT_DT, tmp_out, f"{tmp_out}/history", Q.FIX, window=False, stage_db=db)
    assert res["metrics"]["final"]["rows"] == 33 and spark.read.parquet(res["final"]).count() == 33
    assert res["metrics"]["scorecard"]["rows"] == spark.read.parquet(res["scorecard"]).count()
    assert not {W.JK, W.JN} & set(spark.read.parquet(res["rejects"]["decision_rejects"]).columns)


@pytest.mark.parametrize("opts", [RECORD, STRICT])
def test_guard_names_the_offending_id(spark, opts):
    dec = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "decision_id string, x int")
    dl = spark.createDataFrame([("a", 1)], "decision_id_a string, y int")
    with pytest.raises(Exception, match="more than one row for decision_id = b"):
        join_deliveries(dec, dl, opts, guard=True).collect()
    assert join_deliveries(dec.where("x <> 3"), dl, opts, guard=True).count() == 3
    # the guard stays where nothing but a count is asked for
    with pytest.raises(Exception, match="decision_id = b"):
        join_deliveries(dec, dl, opts, guard=True).count()


def test_catalog_tables_prune_partitions(spark):
    df = Q.q_catalog_scan(spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan
    files = df.inputFiles()
    assert files and min(f.split("partition_date=")[1][:8] for f in files) >= Q.WINDOW.partition_cutoff


def rows_a_task(table):
    """Rows that each task wrote of a table: by the number in its files' names."""
    part = F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1)
    return [r["count"] for r in table.groupBy(part).count().collect()]


def test_catalog_tables_cut_a_heavy_partition(spark, monkeypatch):
    """The initial load is one partition with a fifth of all events: several tasks write it."""
    monkeypatch.setattr(K, "TABLE_ROWS", 50, raising=False)
    known = {d.name for d in spark.catalog.listDatabases()}
    Q.q_catalog_scan(spark, SF001)
    (db,) = {d.name for d in spark.catalog.listDatabases()} - known
    src = FX.envelope_sources(FX.read_events(spark, SF001))
    for name in ("decisions", "preferences_initial", "preferences_incremental", "deliveries"):
        want, got = getattr(src, name), spark.table(f"{db}.{name}")
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        assert max(rows_a_task(got)) <= 100, name
    initial = spark.table(f"{db}.preferences_initial").where(F.col("partition_date") == FX.C.INITIAL_LOAD_PARTITION)
    assert initial.count() > 100 and len(rows_a_task(initial)) > 2


def test_partitioned_write_of_odd_tables(spark, tmp_out):
    """A missing partition value, a partition a row, rows that nothing tells apart, no rows."""
    db = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_out}/{db}'")
    i = F.col("id")
    df = spark.range(0, 1000, 1, 8).select(
        i, F.create_map(F.lit("k"), i.cast("string")).alias("m"),
        F.when(i < 500, F.lit("a")).when(i < 970, F.lit(None)).otherwise(i.cast("string")).alias("p"))
    got = K.write_partitioned(df, f"{db}.t", "p", ["id"], 100)
    assert sorted(map(repr, got.select(*df.columns).collect())) == sorted(map(repr, df.collect()))
    assert max(rows_a_task(got)) <= 150 and len(got.inputFiles()) <= 10 + 32
    copies = df.select(F.lit(7).alias("id"), "p")
    got = K.write_partitioned(copies, f"{db}.copies", "p", ["id"], 100)
    assert sorted(map(repr, got.select("id", "p").collect())) == sorted(map(repr, copies.collect()))
    assert len(rows_a_task(got.where("p = 'a'"))) > 1
    none = K.write_partitioned(df.where("id < 0"), f"{db}.none", "p", ["id"])
    assert none.count() == 0 and none.columns == df.columns


def test_export_parts_are_ordered_and_bounded(spark, tmp_out):
    df = spark.range(0, 1003).select((1002 - F.col("id")).alias("k"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('a,"'), "id")).alias("t"))
    path = K.write_ordered_csv(df.repartition(7), f"{tmp_out}/e", "list", [F.col("k")], 100)
    names = sorted(n for n in os.listdir(path) if n.endswith(".csv"))
    assert names == [f"list-{k:05d}.csv" for k in range(1, 12)]
    seen = []
    for n in names:
        lines = open(f"{path}/{n}", encoding="utf-8").read().splitlines()
        assert lines[0] == "k,t" and len(lines) <= 101
        seen += [int(x.split(",")[0]) for x in lines[1:]]
    assert seen == list(range(1003))
    back = spark.read.schema(df.schema).options(**K.CSV_OPTIONS).csv(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()), key=lambda r: r[0])
    K.write_ordered_csv(df.limit(0), path, "list", [F.col("k")])  # replaces the parts
    assert [n for n in os.listdir(path) if n.endswith(".csv")] == ["list-00001.csv"]
    assert open(f"{path}/list-00001.csv", encoding="utf-8").read().strip() == "k,t"


def test_three_controls_in_one_scan(spark):
    f = Q.final_table(spark, SF001, materialize=True)
    sample = Q.materialize_table(Q._sample(f), "sample")
    got = control_summaries(f, sample, Q.REPORT_DT)
    want = control_summary(sample, "accuracy", Q.REPORT_DT).unionByName(control_summary(f, "timeliness", Q.REPORT_DT)).unionByName(
        control_summary(f, "completeness", Q.REPORT_DT))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = build_scorecard(f, sample, Q.REPORT_DT)._jdf.queryExecution().optimizedPlan().toString()
    final_scans = [x for x in plan.split("\n") if "Relation" in x and "sla_ind" in x]
    assert plan.count("Relation [") == 2 and len(final_scans) <= 2 and plan.count("Aggregate [") == 1


def test_variant_payload_paths(spark):
    docs = [('{"customerID":"a","accountId":"1","alertType":"AVAIL_CREDIT_REMAINING","alertAmount":1.50}', "a"),
            ('{"customerId":"b","accountId":2,"alertType":"AVAIL_CREDIT_REMAINING"}', "b"),
            ('{"customerID":null,"customerId":"c","alertType":"AVAIL_CREDIT_REMAINING"}', "c"),
            ('{"customerID":"d","customerId":"e","alertType":"AVAIL_CREDIT_REMAINING"}', "d"),
            ("not json", None), (None, None)]
    env = FX.envelope_sources(FX.read_events(spark, SF001)).decisions
    base = env.limit(1).drop("eventAttributes").crossJoin(spark.createDataFrame(docs, "doc string, want string"))
    rows = base.withColumn("eventAttributes", F.create_map(F.lit("eventPayload"), F.col("doc")))
    got = EN.scan_decisions(rows.select(*env.columns), None, THIRD).select("customer_id", "account_id", "alert_amount").collect()
    assert sorted(r.customer_id for r in got) == ["a", "b", "c", "d"]
    assert {r.customer_id: r.account_id for r in got}["b"] == "2" and {str(r.alert_amount) for r in got} == {"1.50", "None"}


def test_envelope_without_a_column_is_refused(spark):
    env = FX.envelope_sources(FX.read_events(spark, SF001)).decisions
    with pytest.raises(ValueError, match="event_timestamp"):
        EN.scan_decisions(env.drop("event_timestamp"))
    other = env.withColumnRenamed("event_activity_type", "EventActivityType")
    assert EN.scan_decisions(other, Q.WINDOW).count() == EN.scan_decisions(env, Q.WINDOW).count()
