"""Failure lists with masked customer ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlens.functions import constants as C
from alertlens.functions import scalars as S
from alertlens.functions.calendar import snap_date, yyyymm
from alertlens.options import RECORD, Options


def _head(report_dt: dt.date, opts: Options) -> list[Column]:
    return [
        yyyymm(F.col("decision_date")).alias("event_month"),
        F.lit(report_dt).alias("reporting_date"),
        snap_date(F.col("decision_date"), opts).alias("event_week_ending"),
        F.lit(opts.lob).alias("LOB"),
        F.lit(C.PRODUCT_TYPE_LABEL).alias("Product"),
        F.col("account_id").alias("account_number"),
    ]


def _amounts() -> list[Column]:
    return [
        F.col("threshold_amount").alias("thresholdamount"),
        F.col("alert_amount").alias("available_credit"),
        F.col("decision_id").alias("decisionid"),
        F.col("decision_date").alias("event_date"),
    ]


def _not_yes(c: str) -> Column:
    """SAS ``^= 'Y'``: a missing value is not 'Y'."""
    return F.coalesce(F.col(c), F.lit("")) != "Y"


def fail_completeness(final: DataFrame, report_dt: dt.date, opts: Options = RECORD) -> DataFrame:
    """Decisions with no delivery record (11 columns)."""
    return final.where(S.is_blank(F.col("decision_id_a"))).select(
        *_head(report_dt, opts), *_amounts(), S.mask_id(F.col("customer_id"), opts).alias("custid_mask"))


def fail_timeliness(final: DataFrame, report_dt: dt.date, opts: Options = RECORD) -> DataFrame:
    """Decisions outside the SLA, with the minutes taken (14 columns)."""
    return final.where(_not_yes("sla_ind")).select(
        *_head(report_dt, opts), *_amounts(),
        F.col("event_ts").alias("eventTimestamp"),
        F.col("event_ts_a").alias("sent_timestamp"),
        S.ceil_minutes(F.col("time_diff")).alias("total_minutes"),
        S.mask_id(F.col("customer_id"), opts).alias("custid_mask"),
    )


def fail_accuracy(sample: DataFrame, report_dt: dt.date, opts: Options = RECORD) -> DataFrame:
    """Sampled decisions that fail the threshold check (12 columns)."""
    return sample.where(_not_yes("threshold_limit_check")).select(
        *_head(report_dt, opts), F.lit(C.ACCURACY_DECISION_LABEL).alias("decision"), *_amounts(),
        S.mask_id(F.col("customer_id"), opts).alias("custid_mask"),
    )
