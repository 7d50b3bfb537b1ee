"""The registered queries: one per operator of SURVEY §2, each a function (spark, sf_dir) -> DataFrame.

Every query reads the driver's ``events`` table (through the fixture adapter, and for the
composite outputs through the envelope form and the production scans) over the whole table.
The fixture runs use the record preset without a reporting window, except where the window *is* the
operator (``scan_*``, ``reporting_window``, ``history_replace``, ``final_week``).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.functions import calendar as CAL
from alertlens.functions import constants as C
from alertlens.functions import scalars as S
from alertlens.operators import aggregates as A
from alertlens.operators import dedup as W
from alertlens.operators.asof import effective_preference, fanout_size
from alertlens.operators.derive import exclude_business
from alertlens.operators.joins import join_deliveries, replace_history
from alertlens.options import PORT, RECORD, STRICT, THIRD
from alertlens.plans.details import fail_accuracy, fail_completeness, fail_timeliness
from alertlens.plans.final import build_final, decisions_with_deliveries
from alertlens.plans.scorecard import attach_comment, build_scorecard, union_controls
from alertlens.plans.weekly import CROSSTAB7, ONEWAY_COLUMNS, final_metrics, scorecard_metrics, stage_feeds
from alertlens.session import application_scratch
from alertlens.session import materialize as materialize_table
from alertlens.sinks.writers import (CSV_OPTIONS, write_final, write_history, write_observed, write_ordered_csv, write_partitioned,
                                     write_scorecard)
from alertlens.sources import envelope as EN
from alertlens.sources import fixture as FX
from alertlens.sources.history import read_history

FIX, FIX_PORT, FIX_STRICT, FIX_THIRD = RECORD, PORT, STRICT, THIRD
REPORT_DT = FX.FIXTURE_REPORT_DATE
HISTORY_DT = dt.date(2024, 1, 24)
CUTOFF_OVERRIDE = "20240126"
FIRST_RUN_SHIFT = 545  # days
EXPORT_PART = 250  # rows of an export part in the round trip
WINDOW = CAL.reporting_window(REPORT_DT, FIX)


def _ev(spark: SparkSession, sf: str) -> DataFrame:
    return FX.read_events(spark, sf)


def _write(name):
    """Write a shared intermediate once, under the session's scratch folder."""
    return lambda df: materialize_table(df, name)


def _flat(spark, sf):
    ev = _ev(spark, sf)
    return FX.decisions(ev), FX.preferences(ev), FX.deliveries(ev)


def _env(spark, sf) -> EN.Sources:
    return FX.envelope_sources(_ev(spark, sf))


def final_table(spark, sf, opts=FIX, materialize: bool = False) -> DataFrame:
    """R1 through the production path: envelope tables -> scans -> final.

    With ``materialize`` the final table is written once (a Parquet table under the session's
    ``spark.checkpoint.dir``) so that a query with several consumers of it (the three controls
    of the scorecard, the two scorecards of ``history_replace``) does not recompute the whole
    plan per consumer; the weekly run does the same with its own write."""
    src = _env(spark, sf)
    f = build_final(
        EN.scan_decisions(src.decisions, None, opts),
        EN.scan_preferences(src, None, opts, distinct=False),
        EN.scan_deliveries(src.deliveries, None, opts),
        opts,
        _write("joined"),
        lambda keep: EN.scan_preferences(src, None, opts, distinct=False, keep=keep),
    )
    return materialize_table(f, "final") if materialize else f


def _pre_exclusion(spark, sf):
    dec, pref, dl = _flat(spark, sf)
    return decisions_with_deliveries(dec, pref, dl, FIX, _write("joined"))


def _sample(final):
    return W.stratified_sample(final, opts=FIX)


# ---- scans / sources -----------------------------------------------------------------------

def q_extract_envelope(spark, sf):
    return EN.scan_decisions(_env(spark, sf).decisions, None, FIX)


def q_json_scalars(spark, sf):
    return EN.scan_deliveries(_env(spark, sf).deliveries, None, FIX)


def q_scan_decisions(spark, sf):
    d = EN.scan_decisions(_env(spark, sf).decisions, WINDOW, FIX)
    return d.select("decision_id", "source_event_id", "partition_date", "event_ts", "account_id",
                    "customer_id", "alert_amount", "threshold_amount")


def q_scan_preferences(spark, sf):
    p = EN.scan_preferences(_env(spark, sf), WINDOW, FIX, distinct=True)
    return p.select("source_event_id_p", "event_activity_type_p", "event_ts_p", "external_account_p",
                    "cust_id_p", "is_business_p", "threshold_p")


def q_scan_deliveries(spark, sf):
    a = EN.scan_deliveries(_env(spark, sf).deliveries, WINDOW, FIX)
    return a.select("source_event_id_a", "decision_id_a", "event_ts_a", "alert_amount_a", "threshold_amount_a")


def q_union_preferences(spark, sf):
    ev = _ev(spark, sf)
    return EN.union_preferences(FX.preferences_initial(ev), FX.preferences_incremental(ev), distinct=True)


def q_partition_cutoff(spark, sf):
    d = EN.partition_cutoff(EN.scan_decisions(_env(spark, sf).decisions, None, FIX), after=WINDOW.partition_cutoff)
    return d.select("source_event_id", "partition_date",
                    S.partition_to_date(F.col("partition_date")).alias("partition_day"))


# ---- scalar functions -----------------------------------------------------------------------

def _ts_text():
    t = F.col("ts")
    return (F.when(F.col("event_type") == "purchase", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(F.col("event_type") == "view", F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .when(F.col("event_type") == "click", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(F.col("event_type") == "signup", F.date_format(t, "yyyy-MM-dd"))
            .otherwise(F.concat(F.lit("ts-"), F.col("event_id").cast("string"))))


def q_safe_timestamp(spark, sf):
    ev = _ev(spark, sf).select("event_id", _ts_text().alias("ts_text"))
    return ev.select("event_id", "ts_text", S.safe_ts(F.col("ts_text")).alias("parsed_ts"))


def _num_text():
    k = F.get_json_object(F.col("props"), "$.k")
    et = F.col("event_type")
    return (F.when(et == "purchase", k)
            .when(et == "view", F.concat(k, F.lit(".5")))
            .when(et == "click", F.concat(F.lit("9999999999"), k))
            .when(et == "signup", F.concat(F.lit("-"), k, F.lit(".25")))
            .otherwise(F.lit("n/a")))


def q_safe_decimal(spark, sf):
    ev = _ev(spark, sf).select("event_id", _num_text().alias("num_text"))
    return ev.select("event_id", "num_text", S.safe_decimal(F.col("num_text")).alias("amount"))


def _key_text():
    et = F.col("event_type")
    return (F.when(et == "error", F.lit("   ")).when(et == "click", F.lit(""))
            .otherwise(F.col("user_id").cast("string")))


def q_blank_keys(spark, sf):
    ev = _ev(spark, sf).select("event_id", _key_text().alias("raw_key"))
    return ev.select("event_id", "raw_key", S.blank_to_null(F.col("raw_key")).alias("clean_key"))


def q_resolve_keys(spark, sf):
    dl = FX.deliveries(_ev(spark, sf))
    dec_key = EN.pick_column(dl, ["decisionId_a", "decision_id_a"])
    ts_key = EN.pick_column(dl, ["eventTimestamp_a", "event_ts_a"])
    return dl.select(F.col("source_event_id_a"), S.blank_to_null(F.col(dec_key)).alias("decision_key"),
                     F.col(ts_key).alias("sent_ts"))


def q_exclude_business(spark, sf):
    return exclude_business(_pre_exclusion(spark, sf), FIX).select(
        "decision_id", "source_event_id", "is_business_p", "dec_tm_ge_pref_tm")


def q_date_parts(spark, sf):
    return final_table(spark, sf).select("decision_id", "src_event_date", "process_date", "event_date", "decision_date")


def q_threshold_check(spark, sf):
    dec = FX.decisions(_ev(spark, sf))
    return dec.select("source_event_id", "alert_amount", "threshold_amount",
                      S.threshold_check(F.col("alert_amount"), F.col("threshold_amount"), FIX).alias("threshold_limit_check"),
                      S.threshold_check(F.col("alert_amount"), F.col("threshold_amount"), PORT).alias("threshold_check_port"))


def _latency_base(spark, sf):
    return _pre_exclusion(spark, sf).select(
        "decision_id", "event_ts", "event_ts_a",
        S.latency_seconds(F.col("event_ts_a"), F.col("event_ts")).alias("time_diff"))


def q_found_missing(spark, sf):
    return _latency_base(spark, sf).select(
        "decision_id", S.found_missing(F.col("event_ts_a"), F.col("event_ts")).alias("found_missing"))


def q_latency(spark, sf):
    return _latency_base(spark, sf)


def q_sla_flag(spark, sf):
    return _latency_base(spark, sf).select("decision_id", "time_diff", S.sla_flag(F.col("time_diff"), FIX).alias("sla_ind"))


def q_latency_bucket(spark, sf):
    return _latency_base(spark, sf).select(
        "decision_id", "time_diff",
        S.latency_bucket(F.col("time_diff"), FIX).alias("alert_time"),
        S.latency_bucket(F.col("time_diff"), PORT).alias("alert_time_port"))


def q_mask_id(spark, sf):
    dec = FX.decisions(_ev(spark, sf)).select("customer_id").distinct()
    return dec.select("customer_id", S.mask_id(F.col("customer_id"), FIX).alias("custid_mask"),
                      S.mask_id(F.col("customer_id"), PORT).alias("custid_mask_port"))


def q_snap_date(spark, sf):
    d = FX.decisions(_ev(spark, sf)).select(F.to_date("event_ts").alias("decision_date")).distinct()
    return d.select("decision_date", CAL.snap_date(F.col("decision_date"), FIX).alias("snap_date"),
                    CAL.snap_date(F.col("decision_date"), PORT).alias("snap_date_port"))


def q_reporting_window(spark, sf):
    d = _ev(spark, sf).select(F.to_date("ts").alias("report_dt")).distinct()
    r = F.col("report_dt")
    start = CAL.window_start(r, FIX)
    return d.select(
        "report_dt", start.alias("week_start"), CAL.window_end(r, FIX).alias("week_end"),
        F.date_format(F.date_sub(start, 7), "yyyyMMdd").alias("partition_cutoff"),
        CAL.window_start(r, PORT).alias("week_start_port"), CAL.window_end(r, PORT).alias("week_end_port"),
    )


# ---- joins, windows -------------------------------------------------------------------------

def q_effective_preference(spark, sf):
    dec, pref, _ = _flat(spark, sf)
    e = effective_preference(materialize_table(W.dedup_decisions(dec, FIX), "decisions"), pref, FIX, _write("chosen"))
    return e.select("decision_id", "source_event_id", "source_event_id_p", "event_ts_p", "is_business_p",
                    "dec_tm_ge_pref_tm")


def q_preference_fanout_size(spark, sf):
    dec, pref, _ = _flat(spark, sf)
    return fanout_size(dec, pref, FIX)


def q_join_deliveries(spark, sf):
    dec, _, dl = _flat(spark, sf)
    j = join_deliveries(W.dedup_decisions(dec, FIX), W.dedup_deliveries(dl, FIX), FIX)
    return j.select("decision_id", "source_event_id", "decision_id_a", "source_event_id_a", "event_ts_a")


def q_dedup_first(spark, sf):
    return W.dedup_decisions(FX.decisions(_ev(spark, sf)), FIX).select(
        "decision_id", "source_event_id", "event_ts", "alert_amount")


def q_dedup_rejects(spark, sf):
    return W.decision_rejects(FX.decisions(_ev(spark, sf)), FIX).select(
        "decision_id", "source_event_id", "event_ts")


def q_dedup_latest(spark, sf):
    return W.dedup_deliveries(FX.deliveries(_ev(spark, sf)), FIX).select(
        "decision_id_a", "source_event_id_a", "event_ts_a")  # (drops the null-safe key columns)


def q_stratified_sample(spark, sf):
    return _sample(final_table(spark, sf)).select("decision_date", "decision_id", "threshold_limit_check")


# ---- aggregates and composite outputs -------------------------------------------------------

def q_latency_counts(spark, sf):
    return A.latency_counts(final_table(spark, sf))


def q_totals(spark, sf):
    return A.totals(final_table(spark, sf))


def q_control_accuracy(spark, sf):
    return A.control_summary(_sample(final_table(spark, sf)), "accuracy", REPORT_DT, FIX)


def q_control_timeliness(spark, sf):
    return A.control_summary(final_table(spark, sf), "timeliness", REPORT_DT, FIX)


def q_control_completeness(spark, sf):
    return A.control_summary(final_table(spark, sf), "completeness", REPORT_DT, FIX)


def q_code_comment(spark, sf):
    f = final_table(spark, sf, materialize=True)
    u = union_controls(A.control_summary(f, "timeliness", REPORT_DT, FIX),
                       A.control_summary(f, "completeness", REPORT_DT, FIX))
    return attach_comment(u).select("ControlRisk", "Segment10", "SnapDate", "CommentCode", "Comments", "Volume")


def q_scorecard(spark, sf):
    f = final_table(spark, sf, materialize=True)
    return build_scorecard(f, materialize_table(_sample(f), "sample"), REPORT_DT, FIX)


def q_freq_oneway(spark, sf):
    return A.freq_oneway(final_table(spark, sf), ONEWAY_COLUMNS, {"decision_id_a": S.blank_label})


def q_freq_decision_ids(spark, sf):
    """W8 on variables with as many levels as the feed has ids."""
    return A.freq_oneway(FX.decisions(_ev(spark, sf)), ("decision_id", "source_event_id"))


def q_summary_order(spark, sf):
    """O1: the three control summaries with their published row order as a column."""
    f = final_table(spark, sf, materialize=True)
    return A.ordered_summary(union_controls(
        A.control_summary(_sample(f), "accuracy", REPORT_DT, FIX), A.control_summary(f, "timeliness", REPORT_DT, FIX),
        A.control_summary(f, "completeness", REPORT_DT, FIX)))


def q_freq_flags(spark, sf):
    return A.freq_oneway(_pre_exclusion(spark, sf), ("dec_tm_ge_pref_tm", "is_business_p"))


def q_freq_crosstab(spark, sf):
    return A.freq_crosstab(_pre_exclusion(spark, sf), ("dec_tm_ge_pref_tm", "is_business_p"))


def q_freq_crosstab7(spark, sf):
    return A.freq_crosstab(final_table(spark, sf), CROSSTAB7)


def q_fail_completeness(spark, sf):
    return fail_completeness(final_table(spark, sf), REPORT_DT, FIX)


def q_fail_timeliness(spark, sf):
    return fail_timeliness(final_table(spark, sf), REPORT_DT, FIX)


def q_fail_accuracy(spark, sf):
    return fail_accuracy(_sample(final_table(spark, sf)), REPORT_DT, FIX)


def q_history_replace(spark, sf):
    f = final_table(spark, sf, materialize=True)
    hist = build_scorecard(f, _sample(f), HISTORY_DT, FIX)
    week = f.where(F.col("decision_date").between(F.lit(WINDOW.start), F.lit(WINDOW.end)))
    new = materialize_table(build_scorecard(week, _sample(week), REPORT_DT, FIX), "new-week")  # its rows and its dates
    return replace_history(hist, new)


FINAL_COLUMNS = ("decision_id", "source_event_id", "account_id", "customer_id", "event_ts", "alert_amount",
                 "threshold_amount", "source_event_id_p", "event_ts_p", "is_business_p", "dec_tm_ge_pref_tm",
                 "decision_id_a", "source_event_id_a", "event_ts_a", "decision_date", "threshold_limit_check",
                 "found_missing", "time_diff", "sla_ind", "alert_time")


def q_final(spark, sf):
    return final_table(spark, sf).select(*FINAL_COLUMNS)


def q_final_week(spark, sf):
    """The weekly run as scheduled: report date 2024-01-31, record window Tue 2024-01-23 ..
    Mon 2024-01-29, partition cutoff, incremental preferences after the window (D13)."""
    src = _env(spark, sf)
    f = build_final(
        EN.scan_decisions(src.decisions, WINDOW, FIX),
        EN.scan_preferences(src, WINDOW, FIX, distinct=False),
        EN.scan_deliveries(src.deliveries, WINDOW, FIX),
        FIX,
        _write("joined"),
        lambda keep: EN.scan_preferences(src, WINDOW, FIX, distinct=False, keep=keep),
    )
    return f.select(*FINAL_COLUMNS)


def q_scorecard_port(spark, sf):
    """The scorecard under the ports' preset: Thu-Wed weeks, snapshot on Wednesday, comparisons
    with a missing operand false, nulls last."""
    f = final_table(spark, sf, FIX_PORT, materialize=True)
    return build_scorecard(f, W.stratified_sample(f, opts=FIX_PORT), REPORT_DT, FIX_PORT)


def q_final_week_strict(spark, sf):
    """The weekly run under the strict preset: half-open window end, incremental preferences
    up to the window end (so they can be in force), NULL keys never match."""
    src = _env(spark, sf)
    w = CAL.reporting_window(REPORT_DT, FIX_STRICT)
    f = build_final(
        EN.scan_decisions(src.decisions, w, FIX_STRICT),
        EN.scan_preferences(src, w, FIX_STRICT, distinct=False),
        EN.scan_deliveries(src.deliveries, w, FIX_STRICT),
        FIX_STRICT,
        _write("joined"),
        lambda keep: EN.scan_preferences(src, w, FIX_STRICT, distinct=False, keep=keep),
    )
    return f.select(*FINAL_COLUMNS)


def q_delivery_rejects(spark, sf):
    return W.delivery_rejects(FX.deliveries(_ev(spark, sf)), FIX).select(
        "decision_id_a", "source_event_id_a", "event_ts_a")


def q_scan_initial(spark, sf):
    """The fixed partition of the initial load."""
    p = EN.scan_preferences_initial(_env(spark, sf).preferences_initial, WINDOW, FIX)
    return p.select("source_event_id_p", "partition_date_p", "event_ts_p", "external_account_p", "cust_id_p")


def q_scan_deliveries_bounded(spark, sf):
    """F7 / F8 of the third preset: half-open window on the header time, id required."""
    w = CAL.reporting_window(REPORT_DT, FIX_THIRD)
    return EN.scan_deliveries(_env(spark, sf).deliveries, w, FIX_THIRD).select(
        "source_event_id_a", "decision_id_a", "event_ts_a")


def q_scorecard_third(spark, sf):
    """The weekly scorecard under the third preset."""
    src, w = _env(spark, sf), CAL.reporting_window(REPORT_DT, FIX_THIRD)
    f = materialize_table(build_final(
        EN.scan_decisions(src.decisions, w, FIX_THIRD),
        EN.scan_preferences(src, w, FIX_THIRD, distinct=False),
        EN.scan_deliveries(src.deliveries, w, FIX_THIRD),
        FIX_THIRD, _write("joined")), "final")
    return build_scorecard(f, W.stratified_sample(f, opts=FIX_THIRD), REPORT_DT, FIX_THIRD)


def q_partition_cutoff_override(spark, sf):
    """The run's own partition cutoff instead of window start - 7."""
    w = CAL.reporting_window(REPORT_DT, FIX.with_(partition_cutoff=CUTOFF_OVERRIDE))
    return EN.scan_decisions(_env(spark, sf).decisions, w, FIX).select("source_event_id", "partition_date")


def q_offset_timestamp(spark, sf):
    """P4 with offsets moved to UTC, beside the wall-clock reading."""
    t, et = F.col("ts"), F.col("event_type")
    zone = F.when(et == "purchase", F.lit("+05:30")).when(et == "view", F.lit("-0300")).otherwise(F.lit("Z"))
    text = F.when(et == "signup", F.date_format(t, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), zone))
    ev = _ev(spark, sf).select("event_id", text.alias("ts_text"))
    return ev.select("event_id", "ts_text", S.safe_ts(F.col("ts_text"), "utc").alias("utc_ts"), S.safe_ts(F.col("ts_text")).alias("wall_ts"))


def q_comment_dimension(spark, sf):
    """Comment texts from a dimension table."""
    f = final_table(spark, sf, materialize=True)
    dim = spark.createDataFrame(sorted(C.DEFAULT_COMMENTS.items()), "CommentCode string, Comments string")
    u = union_controls(A.control_summary(f, "timeliness", REPORT_DT, FIX),
                       A.control_summary(f, "completeness", REPORT_DT, FIX))
    return attach_comment(u, dim).select("ControlRisk", "Segment10", "SnapDate", "CommentCode", "Comments", "Volume")


def _final_with(spark, sf, preferences: bool = True, deliveries: bool = True):
    dec, pref, dl = _flat(spark, sf)
    return build_final(dec, pref if preferences else pref.where(F.lit(False)),
                       dl if deliveries else dl.where(F.lit(False)), FIX, _write("joined")).select(*FINAL_COLUMNS)


def q_final_without_preferences(spark, sf):
    """Nothing to join on the preference side."""
    return _final_with(spark, sf, preferences=False)


def q_final_without_deliveries(spark, sf):
    """Nothing to join on the delivery side."""
    return _final_with(spark, sf, deliveries=False)


def q_history_write(spark, sf):
    """Write an older history, replace the new week's snapshot dates in it
    through the writer, and read it back in order."""
    f = final_table(spark, sf, materialize=True)
    path = f"{application_scratch(spark)}/history-{uuid.uuid4().hex}"
    write_history(build_scorecard(f, _sample(f), HISTORY_DT, FIX), path)
    week = f.where(F.col("decision_date").between(F.lit(WINDOW.start), F.lit(WINDOW.end)))
    write_history(build_scorecard(week, _sample(week), REPORT_DT, FIX), path, own=CAL.own_snap_dates(WINDOW, FIX))
    return read_history(spark, path, ordered=True)


def q_history_first(spark, sf):
    """No history yet: a zero-row history of the right schema, replaced by the week,
    written and read back."""
    f = final_table(spark, sf, materialize=True)
    path = f"{application_scratch(spark)}/history-{uuid.uuid4().hex}"
    week = f.where(F.col("decision_date").between(F.lit(WINDOW.start), F.lit(WINDOW.end)))
    write_history(replace_history(read_history(spark, path), build_scorecard(week, _sample(week), REPORT_DT, FIX)), path)
    return read_history(spark, path)


def q_reporting_window_first(spark, sf):
    """C1's first runs: the dates of the feed moved back to summer 2022."""
    d = _ev(spark, sf).select(F.date_sub(F.to_date("ts"), FIRST_RUN_SHIFT).alias("report_dt")).distinct()
    r = F.col("report_dt")
    return d.select("report_dt", CAL.window_start(r, FIX).alias("week_start"), CAL.window_end(r, FIX).alias("week_end"),
                    CAL.window_start(r, PORT).alias("week_start_port"), CAL.window_end(r, PORT).alias("week_end_port"))


def _database(spark) -> str:
    """A database of this application; its tables lie in the scratch folder."""
    name = f"run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{application_scratch(spark)}/{name}'")
    return name


def q_bucketed_join(spark, sf):
    """Both feeds staged as bucketed tables, keep-first, keep-latest and join on them."""
    db, label = _database(spark), REPORT_DT.strftime("%Y%m%d")
    staged = stage_feeds(spark, _env(spark, sf), None, FIX, f"{application_scratch(spark)}/{db}-stage", label, db)
    dec = W.dedup_decisions(staged["stage_decisions"], FIX, keep_key=True)
    j = join_deliveries(dec, W.dedup_deliveries(staged["stage_deliveries"], FIX), FIX, guard=True)
    return j.select("decision_id", "source_event_id", "decision_id_a", "source_event_id_a", "event_ts_a")


def q_unique_decisions(spark, sf):
    """The join's output under the uniqueness guard."""
    dec, _, dl = _flat(spark, sf)
    j = join_deliveries(W.dedup_decisions(dec, FIX, keep_key=True), W.dedup_deliveries(dl, FIX), FIX, guard=True)
    return j.select("decision_id", "source_event_id", "source_event_id_a")


def q_catalog_scan(spark, sf):
    """The envelope tables saved as partitioned tables of the session's catalog, read by their
    qualified names; the partition cutoff prunes their partitions."""
    db, src = _database(spark), _env(spark, sf)
    names = {k: k for k in ("decisions", "preferences_initial", "preferences_incremental", "deliveries")}
    for k in names:
        write_partitioned(getattr(src, k), f"{db}.{k}", "partition_date", ("source_event_id", "event_timestamp"))
    tables = EN.Sources.from_tables(spark, None, db, names)
    return EN.scan_decisions(tables.decisions, WINDOW, FIX).select(
        "decision_id", "source_event_id", "partition_date", "event_ts", "account_id", "customer_id", "alert_amount", "threshold_amount")


def q_run_metrics(spark, sf):
    """Row counts taken while the final table and the scorecard are written."""
    path = f"{application_scratch(spark)}/metrics-{uuid.uuid4().hex}"
    f, of_final = write_observed(final_table(spark, sf), f"{path}/final", "final", final_metrics())
    _, of_card = write_observed(build_scorecard(f, _sample(f), REPORT_DT, FIX), f"{path}/scorecard", "scorecard", scorecard_metrics())
    return of_final.unionByName(of_card)


def q_ordered_export(spark, sf):
    """K3: a failure list exported as ordered CSV parts and read back, with the part of each row."""
    path = f"{application_scratch(spark)}/export-{uuid.uuid4().hex}"
    rows = fail_timeliness(final_table(spark, sf), REPORT_DT, FIX)
    write_ordered_csv(rows, path, "timeliness", [F.col("decisionid").asc_nulls_first()], EXPORT_PART)
    back = spark.read.schema(rows.schema).options(**CSV_OPTIONS).csv(path)
    part = F.regexp_extract(F.input_file_name(), r"timeliness-([0-9]+)\.csv", 1).cast("int")
    return back.select("*", part.alias("part"))


def q_outputs_round_trip(spark, sf):
    """K1 / K2 / K4: final table and scorecard written under the report date's folder and read back;
    rows and volume by segment from the files."""
    out, label = f"{application_scratch(spark)}/out-{uuid.uuid4().hex}", REPORT_DT.strftime("%Y%m%d")
    write_final(final_table(spark, sf), out, label)
    f = spark.read.parquet(f"{out}/report_dt={label}/final")
    write_scorecard(build_scorecard(f, _sample(f), REPORT_DT, FIX), out, label)
    back = spark.read.parquet(out + f"/report_dt={label}/scorecard")
    days = f.groupBy(F.date_format("decision_date", "yyyyMMdd").alias("segment")).agg(F.count(F.lit(1)).alias("rows"))
    card = back.where(F.col("ControlRisk") == C.CONTROL_TIMELINESS[0]).groupBy(F.col("Segment10").alias("segment")).agg(
        F.sum("Volume").alias("volume"))
    return days.join(card, "segment", "full")


def q_variant_decisions(spark, sf):
    """Documents of which every second one spells its keys the third preset's way."""
    src = FX.envelope_sources(_ev(spark, sf), own_keys=True)
    return EN.scan_decisions(src.decisions, None, FIX_THIRD)


def q_variant_preferences(spark, sf):
    src = FX.envelope_sources(_ev(spark, sf), own_keys=True)
    return EN.scan_preferences(src, None, FIX_THIRD, distinct=False).select(
        "source_event_id_p", "event_ts_p", "external_account_p", "cust_id_p", "masked_account_no_p", "product_type_p", "is_business_p", "threshold_p")


def q_variant_scorecard(spark, sf):
    """The third preset's scorecard over documents with mixed key names."""
    src, w = FX.envelope_sources(_ev(spark, sf), own_keys=True), CAL.reporting_window(REPORT_DT, FIX_THIRD)
    f = materialize_table(build_final(
        EN.scan_decisions(src.decisions, w, FIX_THIRD), EN.scan_preferences(src, w, FIX_THIRD, distinct=False),
        EN.scan_deliveries(src.deliveries, w, FIX_THIRD), FIX_THIRD, _write("joined"),
        lambda keep: EN.scan_preferences(src, w, FIX_THIRD, distinct=False, keep=keep)), "final")
    return build_scorecard(f, W.stratified_sample(f, opts=FIX_THIRD), REPORT_DT, FIX_THIRD)


def q_resolved_scan(spark, sf):
    """An envelope table whose columns are named otherwise."""
    env = _env(spark, sf).deliveries
    other = env.toDF("EventActivityType", "channel_type", "sourceEventId", "EVENT_TIMESTAMP", "partitionDate", "attributes")
    return EN.scan_deliveries(other, WINDOW, FIX).select(
        "source_event_id_a", "decision_id_a", "event_ts_a", "alert_amount_a", "threshold_amount_a")


QUERIES = {
    "extract_envelope": q_extract_envelope,
    "json_scalars": q_json_scalars,
    "scan_decisions": q_scan_decisions,
    "scan_preferences": q_scan_preferences,
    "scan_deliveries": q_scan_deliveries,
    "union_preferences": q_union_preferences,
    "partition_cutoff": q_partition_cutoff,
    "safe_timestamp": q_safe_timestamp,
    "safe_decimal": q_safe_decimal,
    "blank_keys": q_blank_keys,
    "resolve_keys": q_resolve_keys,
    "exclude_business": q_exclude_business,
    "date_parts": q_date_parts,
    "threshold_check": q_threshold_check,
    "found_missing": q_found_missing,
    "latency": q_latency,
    "sla_flag": q_sla_flag,
    "latency_bucket": q_latency_bucket,
    "mask_id": q_mask_id,
    "snap_date": q_snap_date,
    "reporting_window": q_reporting_window,
    "effective_preference": q_effective_preference,
    "preference_fanout_size": q_preference_fanout_size,
    "join_deliveries": q_join_deliveries,
    "dedup_first": q_dedup_first,
    "dedup_rejects": q_dedup_rejects,
    "dedup_latest": q_dedup_latest,
    "stratified_sample": q_stratified_sample,
    "latency_counts": q_latency_counts,
    "totals": q_totals,
    "control_accuracy": q_control_accuracy,
    "control_timeliness": q_control_timeliness,
    "control_completeness": q_control_completeness,
    "code_comment": q_code_comment,
    "scorecard": q_scorecard,
    "freq_oneway": q_freq_oneway,
    "freq_decision_ids": q_freq_decision_ids,
    "summary_order": q_summary_order,
    "freq_flags": q_freq_flags,
    "freq_crosstab": q_freq_crosstab,
    "freq_crosstab7": q_freq_crosstab7,
    "fail_completeness": q_fail_completeness,
    "fail_timeliness": q_fail_timeliness,
    "fail_accuracy": q_fail_accuracy,
    "history_replace": q_history_replace,
    "final": q_final,
    "final_week": q_final_week,
    "final_week_strict": q_final_week_strict,
    "scorecard_port": q_scorecard_port,
    "delivery_rejects": q_delivery_rejects,
    "scan_initial": q_scan_initial,
    "scan_deliveries_bounded": q_scan_deliveries_bounded,
    "scorecard_third": q_scorecard_third,
    "partition_cutoff_override": q_partition_cutoff_override,
    "offset_timestamp": q_offset_timestamp,
    "comment_dimension": q_comment_dimension,
    "final_without_preferences": q_final_without_preferences,
    "final_without_deliveries": q_final_without_deliveries,
    "history_write": q_history_write,
    "history_first": q_history_first,
    "reporting_window_first": q_reporting_window_first,
    "bucketed_join": q_bucketed_join,
    "unique_decisions": q_unique_decisions,
    "catalog_scan": q_catalog_scan,
    "run_metrics": q_run_metrics,
    "ordered_export": q_ordered_export,
    "outputs_round_trip": q_outputs_round_trip,
    "variant_decisions": q_variant_decisions,
    "variant_preferences": q_variant_preferences,
    "variant_scorecard": q_variant_scorecard,
    "resolved_scan": q_resolved_scan,
}
