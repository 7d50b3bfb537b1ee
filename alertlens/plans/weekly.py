"""The weekly run: one call, one write of the final table, then its consumers.

1. scan the four envelope inputs for the reporting window (filters reach the Parquet scan);
2. stage the week-sized extracted feeds (decisions, deliveries) as Parquet (K5), for audit and
   re-runs; the preference history is not copied;
3. join decisions and deliveries (a scratch table, since the as-of step reads its decisions
   twice), build the decisions with their preference and delivery (before the business
   exclusion) and write that once (K5); derive the final table from it and write it once (K1);
4. read it back for the consumers: bucket counts, totals, sample, scorecard, failure lists,
   frequency tables (each reads only its columns); the rejected duplicates of both feeds;
5. replace this week's snapshot dates in the history (K7, dynamic partition overwrite).

Everything is written under ``out/report_dt=<yyyyMMdd>/``; the history lives at one stable
path (D24).  Row counts of the final table and the scorecard come from ``observe()``
metrics on the writes (A9), not from extra jobs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from alertlens.functions import scalars as S
from alertlens.functions.calendar import own_snap_dates, reporting_window
from alertlens.operators import aggregates as A
from alertlens.operators.dedup import JK, JN, decision_rejects, delivery_rejects, stratified_sample
from alertlens.options import RECORD, Options
from alertlens.plans.details import fail_accuracy, fail_completeness, fail_timeliness
from alertlens.operators import derive
from alertlens.plans.final import decisions_with_deliveries
from alertlens.plans.scorecard import build_scorecard, in_order
from alertlens.session import materialize, scratch
from alertlens.sinks import writers as K
from alertlens.sources import envelope as EN

# columns of the two one-way requests on the final table (duplicates requested twice are listed once)
ONEWAY_COLUMNS = ("partition_date", "src_event_date", "process_date", "event_date", "decision_date",
                  "threshold_limit_check", "alert_type", "decision_id_a", "found_missing",
                  "event_activity_type", "is_business_p", "alert_time")
CROSSTAB7 = ("partition_date", "src_event_date", "process_date", "event_date", "decision_date",
             "sla_ind", "alert_time")


# What the log of a run counts, taken while the tables are written


def final_metrics() -> dict:
    return {"rows": F.count(F.lit(1)), "with_delivery": F.count(F.col("event_ts_a")),
            "with_preference": F.count(F.col("source_event_id_p"))}


def scorecard_metrics() -> dict:
    return {"rows": F.count(F.lit(1)), "volume": F.sum("Volume")}


def stage_feeds(spark: SparkSession, sources: EN.Sources, window, opts: Options, out: str, label: str,
                stage_db: str | None = None, buckets: int | None = None):
    """K5: parse the week's decisions and deliveries once and keep them as Parquet; with ``stage_db``
    as catalog tables of that database, ``stage_decisions_<label>`` and ``stage_deliveries_<label>``,
    bucketed by the decision key (``buckets``: one a shuffle partition unless given), so that both
    keep-first steps and their join need no exchange."""
    feeds = {
        "stage_decisions": (EN.scan_decisions(sources.decisions, window, opts), "decision_id"),
        "stage_deliveries": (EN.scan_deliveries(sources.deliveries, window, opts), "decision_id_a"),
    }
    staged = {}
    for name, (df, key) in feeds.items():
        path = K.dated_path(out, label, name)
        if stage_db is None:
            staged[name] = spark.read.parquet(K.write_parquet(df, path))
        else:
            n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            staged[name] = K.write_bucketed(df, f"{stage_db}.{name}_{label}", path, key, n)
    staged["stage_preferences"] = EN.scan_preferences(sources, window, opts, distinct=False)
    return staged


def run_weekly(spark: SparkSession, sources: EN.Sources, report_dt: dt.date, out: str, history_path: str,
               opts: Options = RECORD, window: bool = True, comments=None, stage_db: str | None = None) -> dict:
    """The whole run (``stage_db``: see ``stage_feeds``).  Its scratch tables live in a folder of its own below ``out`` (a shared
    folder, like all outputs), which is deleted at the end."""
    rw = reporting_window(report_dt, opts)
    with scratch(spark, f"{out.rstrip('/')}/_scratch"):
        return _run(spark, sources, report_dt, rw, rw.label, out, history_path, opts, window, comments, stage_db)


def _run(spark, sources, report_dt, rw, label, out, history_path, opts, window, comments, stage_db) -> dict:
    staged = stage_feeds(spark, sources, rw if window else None, opts, out, label, stage_db)
    # one row per decision with its preference and delivery, before the business exclusion (K5);
    # the flag listings read it, the final table is derived from it
    joined = decisions_with_deliveries(staged["stage_decisions"], staged["stage_preferences"],
                                       staged["stage_deliveries"], opts, lambda df: materialize(df, "joined"),
                                       lambda keep: EN.scan_preferences(sources, rw if window else None, opts, distinct=False, keep=keep))
    joined = spark.read.parquet(K.write_parquet(joined, K.dated_path(out, label, "decisions_with_deliveries")))
    final = derive.with_measures(derive.with_dates(derive.exclude_business(joined, opts)), opts)

    final_path = K.dated_path(out, label, "final")
    final, of_final = K.write_observed(final, final_path, "final", final_metrics())

    sample = stratified_sample(final, opts=opts)
    sample_path = K.write_parquet(sample, K.dated_path(out, label, "sample"))
    sample = spark.read.parquet(sample_path)

    scorecard = build_scorecard(final, sample, report_dt, opts, comments)
    sc_path = K.dated_path(out, label, "scorecard")
    _, of_scorecard = K.write_observed(in_order(scorecard), sc_path, "scorecard", scorecard_metrics())
    metrics = of_final.unionByName(of_scorecard)
    K.write_parquet(metrics, K.dated_path(out, label, "run_metrics"))
    counted: dict = {}
    for r in metrics.collect():
        counted.setdefault(r.output, {})[r.metric] = r.value

    lists = {
        "completeness_fail": fail_completeness(final, report_dt, opts),
        "timeliness_fail": fail_timeliness(final, report_dt, opts),
        "accuracy_fail": fail_accuracy(sample, report_dt, opts),
    }
    list_paths = K.write_fail_lists(lists, out, label)

    reports = {
        "freq_flags": A.freq_oneway(joined, ("dec_tm_ge_pref_tm", "is_business_p")),
        "freq_flags_crosstab": A.freq_crosstab(joined, ("dec_tm_ge_pref_tm", "is_business_p")),
        "latency_counts": A.latency_counts(final),
        "totals": A.totals(final),
        "freq_oneway": A.freq_oneway(final, ONEWAY_COLUMNS, {"decision_id_a": S.blank_label}),
        "freq_crosstab": A.freq_crosstab(final, CROSSTAB7),
    }
    report_paths = {n: K.write_parquet(df, K.dated_path(out, label, n)) for n, df in reports.items()}

    rejects = {
        "decision_rejects": decision_rejects(staged["stage_decisions"].drop(JK, JN), opts),
        "delivery_rejects": delivery_rejects(staged["stage_deliveries"].drop(JK, JN), opts),
    }
    reject_paths = {n: K.write_parquet(df, K.dated_path(out, label, n)) for n, df in rejects.items()}

    K.write_history(spark.read.parquet(sc_path), history_path, own=own_snap_dates(rw, opts) if window else None)
    return {
        "label": label,
        "window": (rw.start, rw.end),
        "final": final_path,
        "scorecard": sc_path,
        "history": history_path,
        "fail_lists": list_paths,
        "reports": report_paths,
        "rejects": reject_paths,
        "metrics": counted,
    }
