"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is run once and thrown away (JVM and code generation warm up), then ``BENCH_RUNS``
(default 3) times; the median wall time of planning, executing and writing to a no-op sink is
reported, with the rows written (counted on the way by an observed metric).  ``value`` is the sum
of the medians.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import tempfile
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from alertlens.plans import queries as Q  # noqa: E402
from alertlens.plans.weekly import run_weekly  # noqa: E402
from alertlens.session import drop_scratch, get_spark  # noqa: E402
from alertlens.sources import fixture as FX  # noqa: E402

HEADLINE = {
    "latency_counts": Q.q_latency_counts,
    "effective_preference": Q.q_effective_preference,
    "final": Q.q_final,
    "final_week": Q.q_final_week,
    "scorecard": Q.q_scorecard,
    "freq_oneway": Q.q_freq_oneway,
    "history_replace": Q.q_history_replace,
}


def cpu_model() -> str:
    try:
        with open("/proc/cpuinfo", encoding="utf-8") as f:
            return next(line.split(":", 1)[1].strip() for line in f if line.startswith("model name"))
    except (OSError, StopIteration):
        return platform.processor()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]")

    times, rows = {}, {}

    def once(name, fn) -> float:
        seen = Observation()
        t0 = time.perf_counter()
        fn(spark, sf).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        rows[name] = seen.get["n"]
        return time.perf_counter() - t0

    for name, fn in HEADLINE.items():
        once(name, fn)  # thrown away
        times[name] = round(statistics.median(once(name, fn) for _ in range(runs)), 3)
        drop_scratch(spark)
    # the weekly run end to end (staging, final written once, consumers, history)
    ts = []
    for _ in range(runs + 1):
        out = tempfile.mkdtemp(prefix="alertlens-bench-")
        t0 = time.perf_counter()
        run_weekly(spark, FX.envelope_sources(FX.read_events(spark, sf)), Q.REPORT_DT, out, f"{out}/history",
                   Q.FIX, window=False)
        ts.append(time.perf_counter() - t0)
    times["weekly_run"] = round(statistics.median(ts[1:]), 3)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "runs": runs,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "cpu_model": cpu_model(),
        "machine_cores": os.cpu_count(),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "pyspark": spark.version,
    }))


if __name__ == "__main__":
    main()
