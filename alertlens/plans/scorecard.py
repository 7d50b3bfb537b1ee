"""R2: the weekly scorecard (27 columns) from the final table and its sample."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions.scalars import lookup
from alertlens.operators.aggregates import control_summaries
from alertlens.options import RECORD, Options

SCORECARD_COLUMNS = (
    "RegulatoryName", "LOB", "ReportName", "ControlRisk", "TestType", "TestPeriod", "ProductType",
    "RDE", "SubDE", "Segment", "Segment2", "Segment3", "Segment4", "Segment5", "Segment6", "Segment7",
    "Segment8", "Segment9", "Segment10", "HoldoutFlag", "CommentCode", "Comments", "Volume", "Bal",
    "Amount", "DateCompleted", "SnapDate",
)


def union_controls(*summaries: DataFrame) -> DataFrame:
    """The control name differs per branch and keys are unique in a branch, so a plain
    union equals the distinct union."""
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out


def attach_comment(df: DataFrame, comments: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """Code -> comment text.  A dict becomes a map literal (no join at all); a
    dimension DataFrame (CommentCode, Comments) is left-joined and AQE broadcasts it by size."""
    comments = C.DEFAULT_COMMENTS if comments is None else comments
    if isinstance(comments, dict):
        return df.withColumn("Comments", lookup(F.col("CommentCode"), comments))
    dim = comments.select("CommentCode", "Comments")
    return df.join(dim, "CommentCode", "left")


def scorecard_layout(df: DataFrame, opts: Options = RECORD) -> DataFrame:
    """Constant and padding columns, in the published order."""
    pad = {f"Segment{i}": F.lit(C.SEGMENT_PAD) for i in range(2, 10)}
    consts = {
        "RegulatoryName": F.lit(opts.regulatory_name),
        "LOB": F.lit(opts.lob),
        "ReportName": F.lit(opts.report_name),
        "TestPeriod": F.lit(C.TEST_PERIOD),
        "ProductType": F.lit(C.PRODUCT_TYPE_LABEL),
        "SubDE": F.lit(C.SEGMENT_PAD),
        "Segment": F.lit(C.SEGMENT_PAD),
        "HoldoutFlag": F.lit(C.HOLDOUT_FLAG),
        **pad,
    }
    return df.select(*[consts[c].alias(c) if c in consts else F.col(c) for c in SCORECARD_COLUMNS])


def build_scorecard(final: DataFrame, sample: DataFrame, report_dt: dt.date, opts: Options = RECORD,
                    comments: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """R2: accuracy (on the sample), timeliness and completeness (on all final rows), one pass."""
    u = control_summaries(final, sample, report_dt, opts)
    return scorecard_layout(attach_comment(u, comments), opts)


def in_order(scorecard: DataFrame) -> DataFrame:
    """O1 / O2: the published row order, for what is written or read by people."""
    return scorecard.orderBy("SnapDate", "ControlRisk", "Segment10", "CommentCode")
