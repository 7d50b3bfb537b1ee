"""Sinks (K1-K7).  Outputs are keyed by report date: ``<out>/report_dt=<yyyyMMdd>/<name>``."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from alertlens.operators.dedup import JK, JN, with_null_safe_key
from alertlens.operators.ranges import with_running
from alertlens.session import delete_folder


def dated_path(out: str, label: str, name: str) -> str:
    """K4."""
    return f"{out.rstrip('/')}/report_dt={label}/{name}"


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_final(df: DataFrame, out: str, label: str) -> str:
    """K1 (also K5: the one persisted intermediate every consumer reads back)."""
    return write_parquet(df, dated_path(out, label, "final"))


def write_scorecard(df: DataFrame, out: str, label: str) -> str:
    """K2."""
    return write_parquet(df, dated_path(out, label, "scorecard"))


def write_observed(df: DataFrame, path: str, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` and take its metrics on the way, without another job.  Returns what was
    written and one row (output, metric, value) a metric."""
    spark, seen = df.sparkSession, Observation(f"{name}-{uuid.uuid4().hex}")
    df = df.observe(seen, *[c.alias(k) for k, c in metrics.items()])
    written = spark.read.schema(df.schema).parquet(write_parquet(df, path))
    got = seen.get
    rows = spark.createDataFrame([(name, k, int(got[k] or 0)) for k in metrics], "output string, metric string, value bigint")
    return written, rows


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """K5: ``df`` as a catalog table bucketed and sorted by the null-safe form of ``key``, one file
    a bucket.  Keep-first, keep-latest and the join by that key then read it without an exchange."""
    keyed = with_null_safe_key(df, key)
    (keyed.repartition(buckets, JK, JN).write.format("parquet").mode("overwrite")
     .bucketBy(buckets, JK, JN).sortBy(JK, JN).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


TABLE_ROWS = 100_000  # rows of one task that writes a partitioned table


def write_partitioned(df: DataFrame, table: str, by: str, apart: Sequence[str], rows_a_task: int | None = None) -> DataFrame:
    """``df`` as a catalog table with a folder a value of ``by``, written by tasks of about
    ``rows_a_task`` rows (``TABLE_ROWS`` unless given).  The rows of each partition are counted first
    (one row a partition comes to the driver, which lists a table's partitions anyway) and the
    partitions laid end to end; a row's place is its partition's start plus a hash below its
    partition's row count, and a task writes one stretch of places.  A heavy partition thus becomes
    several files and light ones share a task: neither a task nor a file grows with the table.

    ``apart``: columns that tell rows apart.  Rows that agree in all of them part by the task that
    read them (its rows stay the same when it runs again)."""
    spark, size = df.sparkSession, rows_a_task or TABLE_ROWS
    places, total = [], 0
    for value, n in df.groupBy(by).count().orderBy(by).collect():
        places.append((value, total, n))
        total += n
    starts = spark.createDataFrame(places, StructType([
        StructField("__by", df.schema[by].dataType), StructField("__start", LongType()), StructField("__rows", LongType())]))
    place = F.col("__start") + F.pmod(F.xxhash64(*apart, F.spark_partition_id()), F.col("__rows"))
    dealt = df.join(F.broadcast(starts), F.col(by).eqNullSafe(F.col("__by")), "left").select(
        *df.columns, F.floor(place / size).cast("int").alias("__task"))
    dealt.repartitionById(max(1, -(-total // size)), "__task").drop("__task").write.partitionBy(by).saveAsTable(table)
    return spark.table(table)


EXPORT_ROWS = 500_000  # rows of one export part
#: How exports are written, and must be read to get the same values back.
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_ordered_csv(df: DataFrame, path: str, name: str, order: Sequence[Column], rows_a_part: int = EXPORT_ROWS) -> str:
    """K3: ``<path>/<name>-00001.csv`` and so on: parts of at most ``rows_a_part`` rows in one order
    over all parts, a header in each.  A part is one file of one task, so neither a task nor a
    file grows with the table; an empty table gives one part with the header alone.  ``order``
    should tell rows apart.  Parts are written below a staging folder and moved at the end."""
    spark = df.sparkSession
    stage = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex}"
    placed = with_running(df, order)
    part = F.expr(f"(position - 1) div {rows_a_part}")
    parts = placed.withColumn("__part", part).repartition("__part").sortWithinPartitions("__part", "position")
    parts.select(*df.columns, "__part").write.options(**CSV_OPTIONS).partitionBy("__part").csv(f"{stage}/parts")
    fs, root = _fs(spark, f"{stage}/parts")
    found = {int(s.getPath().getName().split("=")[1]): s.getPath() for s in fs.listStatus(root) if "=" in s.getPath().getName()}
    if not found:
        df.limit(0).coalesce(1).write.options(**CSV_OPTIONS).csv(f"{stage}/none")
        found = {0: _fs(spark, f"{stage}/none")[1]}
    delete_folder(spark, path)
    fs.mkdirs(_fs(spark, path)[1])
    for k, folder in sorted(found.items()):
        (file,) = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".csv")]
        fs.rename(file, _fs(spark, f"{path.rstrip('/')}/{name}-{k + 1:05d}.csv")[1])
    delete_folder(spark, stage)
    return path


def write_fail_lists(lists: dict[str, DataFrame], out: str, label: str, csv: bool = True) -> dict[str, str]:
    """K3: each failure list as Parquet and as a folder of ordered CSV parts."""
    paths = {}
    for name, df in lists.items():
        paths[name] = write_parquet(df, dated_path(out, label, name))
        if csv:
            written = df.sparkSession.read.schema(df.schema).parquet(paths[name])
            write_ordered_csv(written, dated_path(out, label, f"{name}_csv"), name, [F.col("decisionid").asc_nulls_first()])
    return paths


def _fs(spark: SparkSession, path: str):
    """The Hadoop FileSystem of a path (any scheme the cluster is configured for), and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Metadata-only existence check."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def manifests(spark: SparkSession, path: str, complete: bool = True) -> list[int]:
    """The numbers of a history's manifests.  One is complete once its job has left ``_SUCCESS``,
    the last file a writing job makes."""
    fs, p = _fs(spark, f"{path}/manifest")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit()
                  and (not complete or fs.exists(_fs(spark, f"{path}/manifest/{n}/_SUCCESS")[1])))


def manifest_rows(spark: SparkSession, path: str, number: int, col: str = "SnapDate") -> DataFrame:
    """(snapshot date, run): which run's folder holds each week of the history."""
    return spark.read.schema(f"{col} date, run string").parquet(f"{path}/manifest/{number:012d}")


def publish(spark: SparkSession, path: str, run: str, col: str = "SnapDate") -> int:
    """Make a run's weeks the current ones: a new manifest names the run for its own snapshot dates
    and leaves every other date with the run that held it.  Nothing is visible before."""
    written = spark.read.schema(f"{col} date").option("basePath", f"{path}/data/run={run}").parquet(f"{path}/data/run={run}")
    now = written.select(F.col(col)).distinct().withColumn("run", F.lit(run))
    known = manifests(spark, path)
    if known:
        old = manifest_rows(spark, path, known[-1], col)
        mine = now.select(F.col(col).alias("__d"))
        now = now.unionByName(old.join(mine, F.col(col).eqNullSafe(F.col("__d")), "left_anti"))
    number = max(manifests(spark, path, complete=False), default=0) + 1
    now.coalesce(1).write.parquet(f"{path}/manifest/{number:012d}")
    return number


def remove_superseded(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of runs that the current manifest no longer names (and of runs that never
    published).  Call it when no reader of an earlier manifest is left."""
    known = manifests(spark, path)
    if not known:
        return []
    named = {r.run for r in manifest_rows(spark, path, known[-1]).select("run").distinct().collect()}
    fs, p = _fs(spark, f"{path}/data")
    old = [n for s in fs.listStatus(p) if (n := s.getPath().getName()).startswith("run=") and n[4:] not in named]
    for n in old:
        delete_folder(spark, f"{path}/data/{n}")
    return [n[4:] for n in old]


def write_history(week: DataFrame, path: str, col: str = "SnapDate", own: list | None = None) -> str:
    """K7: replace the snapshot dates present in ``week``; other weeks are not read or rewritten
    (O(new week)).  Creates the table when absent (K6).

    The new weeks go to a folder of their own, ``data/run=<id>/SnapDate=<date>``, and become
    visible all at once through the next manifest: a run that fails anywhere before, between
    partitions too, leaves the old weeks as they are.  One writer at a time.  A history in plain
    ``SnapDate=`` folders is taken over as the first run.

    ``own``: the snapshot dates of the run's own window.  Rows of other dates (an inclusive
    window end lets midnight rows of the next week in) are then left to the run they belong to,
    so that running an old week again does not replace a newer week by a few rows."""
    spark = week.sparkSession
    path = path.rstrip("/")
    if not manifests(spark, path, complete=False) and _plain_layout(spark, path, col):
        _write_run(spark.read.schema(week.schema).parquet(path), path, col)
    _write_run(week if own is None else week.where(F.col(col).isin(own)), path, col)
    return path


def _plain_layout(spark: SparkSession, path: str, col: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(s.getPath().getName().startswith(f"{col}=") for s in fs.listStatus(p))


def _write_run(rows: DataFrame, path: str, col: str) -> None:
    run = uuid.uuid4().hex
    rows.write.partitionBy(col).parquet(f"{path}/data/run={run}")
    publish(rows.sparkSession, path, run, col)
