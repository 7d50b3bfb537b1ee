"""Command-line entry for the weekly run (``spark-submit`` / ``python -m alertlens.plans.job``).

    spark-submit --py-files alertlens.zip alertlens/plans/job.py \\
        --report-date 2024-01-31 --preset record \\
        --decisions <path|table> --preferences-initial <path|table> \\
        --preferences-incremental <path|table> --deliveries <path|table> \\
        --out <folder> --history <folder>

Inputs are envelope tables, given as Parquet paths (anything with a '/' or a scheme) or as
catalog table names.  The session is taken from the cluster's configuration
(``getOrCreate``); only the time zone used for display is pinned to UTC.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from alertlens.options import PRESETS
from alertlens.plans.weekly import run_weekly
from alertlens.sources.envelope import Sources
from alertlens.sources.schemas import ENVELOPE_SCHEMA


def _source(spark: SparkSession, ref: str) -> DataFrame:
    if "/" in ref or ":" in ref:
        return spark.read.schema(ENVELOPE_SCHEMA).parquet(ref)
    return spark.table(ref)


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="alertlens.plans.job", description="weekly alert-control run")
    p.add_argument("--report-date", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--preset", choices=sorted(PRESETS), default="record")
    p.add_argument("--no-initial-partition", action="store_true",
                   help="read the whole initial preference load (no fixed partition filter)")
    for name in ("decisions", "preferences-initial", "preferences-incremental", "deliveries"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--history", required=True)
    p.add_argument("--whole-table", action="store_true", help="no reporting-window filters")
    p.add_argument("--partition-cutoff", default=None, help="yyyyMMdd; overrides the window's own partition cutoff")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    a = parse_args(argv)
    spark = spark or SparkSession.builder.appName("alertlens-weekly").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    opts = PRESETS[a.preset]
    if a.no_initial_partition:
        opts = opts.with_(initial_partition=None)
    if a.partition_cutoff:
        opts = opts.with_(partition_cutoff=a.partition_cutoff)
    src = Sources(
        decisions=_source(spark, a.decisions),
        preferences_initial=_source(spark, a.preferences_initial),
        preferences_incremental=_source(spark, a.preferences_incremental),
        deliveries=_source(spark, a.deliveries),
    )
    res = run_weekly(spark, src, a.report_date, a.out, a.history, opts, window=not a.whole_table)
    summary = {"label": res["label"], "window": [str(d) for d in res["window"]], "final": res["final"],
               "scorecard": res["scorecard"], "history": res["history"], "metrics": res["metrics"]}
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main()
