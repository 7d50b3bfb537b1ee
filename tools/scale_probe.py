"""How the plans scale: replicate sf0.1's events k times (new user ids per copy, same times)
into a scratch folder and time the main queries on each size.  Not a registered query.

Usage: python tools/scale_probe.py <scratch_dir> [k ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from alertlens.plans import queries as Q  # noqa: E402
from alertlens.plans.weekly import run_weekly  # noqa: E402
from alertlens.session import drop_scratch, get_spark  # noqa: E402
from alertlens.sources import fixture as FX  # noqa: E402

SRC = "/root/testdata/sf0.1"


def replicate(spark, k: int, out: str) -> str:
    path = f"{out}/x{k}"
    ev = spark.read.parquet(f"{SRC}/events.parquet")
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_c")).select(
        (F.col("event_id") + F.col("_c") * 10_000_000).alias("event_id"), "ts",
        (F.col("user_id") + F.col("_c") * 1_000_000).alias("user_id"), "event_type", "value", "props")
    rep.repartition(max(1, k)).write.parquet(f"{path}/events.parquet")
    return path


def timed(fn):
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 2)


def main():
    scratch = sys.argv[1]
    ks = [int(x) for x in sys.argv[2:]] or [1, 8, 32]
    spark = get_spark()
    out = {}
    for k in ks:
        d = replicate(spark, k, scratch)
        Q.q_final(spark, d).collect()  # warm
        res = {
            "events": spark.read.parquet(f"{d}/events.parquet").count(),
            "final_rows": Q.q_final(spark, d).count(),
            "final_s": timed(lambda: Q.q_final(spark, d).collect()),
            "scorecard_s": timed(lambda: Q.q_scorecard(spark, d).collect()),
            "weekly_run_s": timed(lambda: run_weekly(spark, FX.envelope_sources(FX.read_events(spark, d)), Q.REPORT_DT,
                                                      tempfile.mkdtemp(dir=scratch), os.path.join(scratch, f"h{k}"),
                                                      Q.FIX, window=False)),
        }
        drop_scratch(spark)
        out[f"x{k}"] = res
        print(json.dumps({f"x{k}": res}), flush=True)


if __name__ == "__main__":
    main()
