"""Row-wise derivations of the final table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.functions import scalars as S
from alertlens.operators.asof import FLAG
from alertlens.options import RECORD, Options


def exclude_business(df: DataFrame, opts: Options = RECORD) -> DataFrame:
    """drop business customers whose decision came after the preference.  NULL-safe:
    a NULL business flag never drops a row."""
    if not opts.exclude_business:
        return df
    business = F.coalesce(F.lower(F.col("is_business_p")) == "true", F.lit(False))
    after = F.coalesce(F.col(FLAG) == "Y", F.lit(False))
    return df.where(~(business & after))


def with_dates(df: DataFrame) -> DataFrame:
    """The four dates of the final table."""
    return df.select(
        "*",
        F.to_date("source_event_ts").alias("src_event_date"),
        F.to_date("process_ts").alias("process_date"),
        F.to_date("event_ts").alias("event_date"),
        F.to_date("event_ts").alias("decision_date"),
    )


def with_measures(df: DataFrame, opts: Options = RECORD) -> DataFrame:
    """Threshold check, missing indicator, latency, SLA flag, latency bucket."""
    secs = S.latency_seconds(F.col("event_ts_a"), F.col("event_ts"))
    out = df.select(
        "*",
        S.threshold_check(F.col("alert_amount"), F.col("threshold_amount"), opts).alias("threshold_limit_check"),
        S.found_missing(F.col("event_ts_a"), F.col("event_ts")).alias("found_missing"),
        secs.alias("time_diff"),
    )
    return out.select(
        "*",
        S.sla_flag(F.col("time_diff"), opts).alias("sla_ind"),
        S.latency_bucket(F.col("time_diff"), opts).alias("alert_time"),
    )
