import datetime as dt

from pyspark.sql import functions as F

from alertlens.operators.joins import replace_history, surviving_history
from alertlens.plans import queries as Q
from alertlens.plans.weekly import run_weekly
from alertlens.sinks.writers import write_history
from alertlens.sources import fixture as FX
from alertlens.sources.history import read_history, scorecard_schema
from tests.conftest import SF001


def _rows(spark, dates, tag):
    schema = scorecard_schema()
    vals = []
    for d in dates:
        r = {c.name: None for c in schema}
        r.update(SnapDate=d, ControlRisk=tag, Volume=1)
        vals.append(tuple(r[c.name] for c in schema))
    return spark.createDataFrame(vals, schema)


def test_replace_is_null_safe(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    hist = _rows(spark, [d1, d2, None], "old")
    new = _rows(spark, [d2, None], "new")
    out = replace_history(hist, new).collect()
    assert sorted((r.SnapDate, r.ControlRisk) for r in out if r.SnapDate) == [(d1, "old"), (d2, "new")]
    assert [r.ControlRisk for r in out if r.SnapDate is None] == ["new"]
    # NOT IN with a NULL in the list would keep nothing; the anti join keeps d1
    assert surviving_history(hist, new).count() == 1


def test_absent_history_and_dynamic_overwrite(spark, tmp_out):
    path = f"{tmp_out}/history"
    assert read_history(spark, path).count() == 0
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    write_history(_rows(spark, [d1, d2], "old"), path)
    write_history(_rows(spark, [d2], "new"), path)
    got = sorted((r.SnapDate, r.ControlRisk) for r in read_history(spark, path).collect())
    assert got == [(d1, "old"), (d2, "new")]
    write_history(_rows(spark, [d2], "new"), path)          # running twice equals once
    assert sorted((r.SnapDate, r.ControlRisk) for r in read_history(spark, path).collect()) == got


def test_weekly_run_end_to_end(spark, tmp_out):
    src = FX.envelope_sources(FX.read_events(spark, SF001))
    hist = f"{tmp_out}/history"
    res = run_weekly(spark, src, Q.REPORT_DT, tmp_out, hist, Q.FIX, window=False)
    assert res["metrics"]["final"]["rows"] == 33
    flags = {(r.dec_tm_ge_pref_tm, r.is_business_p): r.frequency
             for r in spark.read.parquet(res["reports"]["freq_flags_crosstab"]).collect()}
    assert flags == {("N", "false"): 1, ("N", "true"): 3, ("Y", "false"): 29, ("Y", "true"): 36}   # FIXTURES.md
    final = spark.read.parquet(res["final"])
    assert final.count() == 33
    n_sc = spark.read.parquet(res["scorecard"]).count()
    h1 = read_history(spark, hist)
    assert h1.count() == n_sc
    fail_rows = (spark.read.option("header", True).csv(res["fail_lists"]["timeliness_fail"] + "_csv").count(),
                 spark.read.parquet(res["fail_lists"]["timeliness_fail"]).count())
    assert fail_rows[0] == fail_rows[1] == 28
    h1_rows = sorted(h1.collect())
    run_weekly(spark, src, Q.REPORT_DT, tmp_out, hist, Q.FIX, window=False)
    assert sorted(read_history(spark, hist).collect()) == h1_rows
    # the weekly (windowed) run touches only its own snapshot date
    res2 = run_weekly(spark, src, Q.REPORT_DT, tmp_out, hist, Q.FIX, window=True)
    snap = {r[0] for r in spark.read.parquet(res2["scorecard"]).select("SnapDate").distinct().collect()}
    assert snap <= {dt.date(2024, 1, 29), dt.date(2024, 2, 5)}
    h2 = read_history(spark, hist)
    own = dt.date(2024, 1, 29)  # midnight rows of the next week don't replace that week
    assert sorted(h2.where(F.col("SnapDate") != own).collect()) == sorted(r for r in h1_rows if r.SnapDate != own)
    ordered = [(r.SnapDate, r.ControlRisk, r.Segment10, r.CommentCode) for r in read_history(spark, hist, ordered=True).collect()]
    assert ordered == sorted(ordered)


def test_weekly_run_removes_its_scratch_tables(spark, tmp_out):
    import os

    src = FX.envelope_sources(FX.read_events(spark, SF001))
    res = run_weekly(spark, src, Q.REPORT_DT, tmp_out, f"{tmp_out}/history", Q.FIX, window=False)
    assert os.listdir(f"{tmp_out}/_scratch") == []
    assert spark.read.parquet(res["rejects"]["decision_rejects"]).count() == 133
    assert spark.read.parquet(res["rejects"]["delivery_rejects"]).count() == 124


def test_job_entry_point(spark, tmp_out):
    """The spark-submit entry reads envelope tables from paths and runs the weekly job."""
    from alertlens.plans.job import main

    src = FX.envelope_sources(FX.read_events(spark, SF001))
    paths = {}
    for name in ("decisions", "preferences_initial", "preferences_incremental", "deliveries"):
        paths[name] = f"{tmp_out}/in/{name}"
        getattr(src, name).write.partitionBy("partition_date").parquet(paths[name])
    argv = ["--report-date", "2024-01-31", "--no-initial-partition", "--whole-table", "--partition-cutoff", "20240101",
            "--decisions", paths["decisions"], "--preferences-initial", paths["preferences_initial"],
            "--preferences-incremental", paths["preferences_incremental"], "--deliveries", paths["deliveries"],
            "--out", f"{tmp_out}/out", "--history", f"{tmp_out}/history"]
    res = main(argv, spark)
    assert res["metrics"]["final"]["rows"] == 33
    assert spark.read.parquet(res["final"]).count() == 33


def test_job_entry_point_with_table_names(spark, tmp_out):
    from alertlens.plans.job import main

    src = FX.envelope_sources(FX.read_events(spark, SF001))
    for name in ("decisions", "preferences_initial", "preferences_incremental", "deliveries"):
        getattr(src, name).createOrReplaceGlobalTempView(f"job_{name}")
    argv = ["--report-date", "2024-01-31", "--no-initial-partition",
            "--decisions", "global_temp.job_decisions", "--preferences-initial", "global_temp.job_preferences_initial",
            "--preferences-incremental", "global_temp.job_preferences_incremental",
            "--deliveries", "global_temp.job_deliveries", "--out", f"{tmp_out}/out", "--history", f"{tmp_out}/history"]
    res = main(argv, spark)                      # the scheduled window: report date 2024-01-31
    assert res["window"] == ["2024-01-23", "2024-01-29"]
    final = spark.read.parquet(res["final"])
    assert final.count() == final.select("decision_id").distinct().count() > 0
    assert final.agg(F.min("event_ts"), F.max("event_ts")).first()[0] >= dt.datetime(2024, 1, 23)
