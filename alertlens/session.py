"""Session helpers: local settings for tests and benches; cluster code reads what is set."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "alertlens") -> SparkSession:
    """Local session (tests, bench).  On a cluster, build the session from the cluster's
    defaults instead; nothing in the library depends on these values except UTC display."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``; only when it is
    unset (local tests) make a scratch folder of our own."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(a machine-local folder does not survive the loss of that machine)")
        d = tempfile.mkdtemp(prefix="alertlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


#: Folder of the run that is being planned; None -> one folder per application.
_SCRATCH: ContextVar[str | None] = ContextVar("alertlens_scratch", default=None)


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` once as a Parquet table under the session's checkpoint
    folder (the shared folder the cluster names in ``spark.checkpoint.dir``), or under the
    folder of the surrounding ``scratch`` run, and reading it back.  One job (a reliable
    ``checkpoint()`` computes its input twice), columnar and prunable for every later reader,
    and it survives the loss of any executor."""
    spark = df.sparkSession
    base = _SCRATCH.get() or application_scratch(spark)
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def application_scratch(spark: SparkSession) -> str:
    """The folder of this application's tables; ``drop_scratch`` deletes it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/alertlens-{spark.sparkContext.applicationId}"


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables this application wrote outside ``scratch`` runs; call it once no
    DataFrame that reads them is used any more."""
    delete_folder(spark, application_scratch(spark))


@contextmanager
def scratch(spark: SparkSession, folder: str):
    """A run of its own: tables written inside go to a new folder below ``folder``, which is
    deleted at the end.  Runs in other threads have their own."""
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    token = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(token)
        delete_folder(spark, path)
