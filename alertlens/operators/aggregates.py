"""Aggregations (A1-A9, W8): bucket counts, control summaries, totals, frequency tables.

All are hash aggregates with a partial (map-side) step, so a hot group never reaches one
task as raw rows.  Cumulative columns are windows over the *aggregated* rows only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions import scalars as S
from alertlens.functions.calendar import snap_date, yyyymm, yyyymmdd
from alertlens.operators.ranges import with_running
from alertlens.options import RECORD, Options

SUM_TYPE = "decimal(22,2)"


def latency_counts(final: DataFrame) -> DataFrame:
    """A1: decisions per latency bucket, ordered by bucket."""
    return final.groupBy("alert_time").agg(F.count(F.lit(1)).alias("decision_count")).orderBy("alert_time")


def totals(final: DataFrame) -> DataFrame:
    """A5: total rows and distinct decision ids (exact)."""
    return final.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("decision_id").alias("total_distinct_decision_id"),
    )


CONTROLS = {
    "accuracy": C.CONTROL_ACCURACY,
    "timeliness": C.CONTROL_TIMELINESS,
    "completeness": C.CONTROL_COMPLETENESS,
}


def control_passed(control: str) -> Column:
    if control == "accuracy":
        return F.col("threshold_limit_check") == "Y"
    if control == "timeliness":
        return F.col("sla_ind") == "Y"
    if control == "completeness":
        return ~S.is_blank(F.col("decision_id_a"))
    raise ValueError(control)


def control_summary(df: DataFrame, control: str, report_dt: dt.date, opts: Options = RECORD) -> DataFrame:
    """A2-A4: one control's summary rows: 7 group keys, count, two sums."""
    return _summed(df.select(_tagged(control, report_dt, opts).alias("k"), "alert_amount", "threshold_amount"))


def control_summaries(final: DataFrame, sample: DataFrame, report_dt: dt.date, opts: Options = RECORD) -> DataFrame:
    """A2-A4 and X2 in one pass: every final row is expanded to its timeliness and its completeness
    row, the sample's rows are their accuracy rows, and one aggregate sums all three controls.
    ``final`` is read once (the control's name is part of the key, so the union needs no distinct)."""
    both = F.explode(F.array(*[_tagged(c, report_dt, opts) for c in ("timeliness", "completeness")]))
    rows = final.select(both.alias("k"), "alert_amount", "threshold_amount")
    return _summed(rows.unionByName(sample.select(_tagged("accuracy", report_dt, opts).alias("k"), "alert_amount", "threshold_amount")))


KEYS = ("ControlRisk", "TestType", "RDE", "CommentCode", "Segment10", "DateCompleted", "SnapDate")


def _summed(tagged: DataFrame) -> DataFrame:
    return tagged.select("k.*", "alert_amount", "threshold_amount").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("Volume"),
        F.sum("alert_amount").cast(SUM_TYPE).alias("Bal"),
        F.sum("threshold_amount").cast(SUM_TYPE).alias("Amount"),
    )


def _tagged(control: str, report_dt: dt.date, opts: Options) -> Column:
    """The group key of a row under a control."""
    risk, test = CONTROLS[control]
    rde = opts.control_ids[list(CONTROLS).index(control)]
    monthly = control == "completeness" and opts.completeness_segment == "month"
    segment = yyyymm(F.col("decision_date")) if monthly else yyyymmdd(F.col("decision_date"))
    codes = (opts.pass_code, opts.fail_code)
    if control == "completeness":
        codes = (opts.completeness_pass_code or codes[0], opts.completeness_fail_code or codes[1])
    snapshot = F.lit(report_dt) if opts.snap_from_report else snap_date(F.col("decision_date"), opts)
    return F.struct(
        F.lit(risk).alias("ControlRisk"),
        F.lit(test).alias("TestType"),
        F.lit(rde).alias("RDE"),
        S.control_code(F.coalesce(control_passed(control), F.lit(False)), *codes).alias("CommentCode"),
        segment.alias("Segment10"),
        F.lit(report_dt).alias("DateCompleted"),
        snapshot.alias("SnapDate"),
    )


def _with_cumulative(agg: DataFrame, part: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Position, percent, cumulative frequency and cumulative percent over aggregated rows,
    by ranges of their order (see ``ranges``), so that no task holds all levels of a variable."""
    rows = with_running(agg, order, part, "frequency")
    total = F.col("group_total").cast("double")
    return rows.select(
        *agg.columns, "position",
        (F.col("frequency").cast("double") * F.lit(100.0) / total).alias("percent"),
        F.col("running").alias("cum_frequency"),
        (F.col("running").cast("double") * F.lit(100.0) / total).alias("cum_percent"),
    )


def freq_oneway(df: DataFrame, cols: Sequence[str], labels: dict[str, callable] | None = None) -> DataFrame:
    """One-way frequency tables for many columns in ONE grouping-sets pass.

    Missing is a level (A8).  ``labels`` maps a column to a Column -> Column formatter applied
    before counting (e.g. ``blank_label``).  Output in list form:
    (variable, level, frequency, position, percent, cum_frequency, cum_percent), levels ascending
    with the missing level first; ``position`` is that order, from 1."""
    labels = labels or {}
    names = [f"__v{i}" for i in range(len(cols))]
    exprs = []
    for c, n in zip(cols, names):
        col = labels[c](F.col(c)) if c in labels else F.col(c)
        exprs.append(col.cast("string").alias(n))
    base = df.select(*exprs)
    g = base.groupingSets([[n] for n in names], *names).agg(
        F.count(F.lit(1)).alias("frequency"), F.grouping_id().alias("__gid")
    )
    # exactly one column is grouped per set: its bit is 0 in the grouping id
    width = len(names)
    variable = F.lit(None).cast("string")
    level = F.lit(None).cast("string")
    for i, (c, n) in enumerate(zip(cols, names)):
        gid = ((1 << width) - 1) ^ (1 << (width - 1 - i))
        variable = F.when(F.col("__gid") == gid, F.lit(c)).otherwise(variable)
        level = F.when(F.col("__gid") == gid, F.col(n)).otherwise(level)
    agg = g.select(variable.alias("variable"), level.alias("level"), "frequency")
    return _with_cumulative(agg, ["variable"], [F.col("level").asc_nulls_first()])


def freq_crosstab(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """N-way crosstab in list form, missing levels kept, cumulative over sorted levels.

    The cumulative frequency needs one global order of the level combinations; it runs over
    ranges of that order."""
    agg = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("frequency"))
    return _with_cumulative(agg, (), [F.col(c).asc_nulls_first() for c in cols])


SUMMARY_ORDER = ("Segment10", "DateCompleted", "SnapDate", "RDE", "CommentCode")


def ordered_summary(summary: DataFrame) -> DataFrame:
    """O1: the row order of a control summary as a column, ``position`` from 1 in each control
    (segment, completion date, snapshot date, control id, result code; NULL first)."""
    rows = with_running(summary, [F.col(c).asc_nulls_first() for c in SUMMARY_ORDER], ["ControlRisk"])
    return rows.drop("group_rows")
