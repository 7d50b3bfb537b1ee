"""Read the scorecard history, or an empty frame of the right schema when absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlens.sinks.writers import manifest_rows, manifests, path_exists


def scorecard_schema() -> T.StructType:
    from alertlens.plans.scorecard import SCORECARD_COLUMNS

    types = {"Volume": T.LongType(), "Bal": T.DecimalType(22, 2), "Amount": T.DecimalType(22, 2),
             "DateCompleted": T.DateType(), "SnapDate": T.DateType()}
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in SCORECARD_COLUMNS])


def read_history(spark: SparkSession, path: str, schema: T.StructType | None = None, ordered: bool = False) -> DataFrame:
    from alertlens.plans.scorecard import in_order

    schema = schema or scorecard_schema()
    path = path.rstrip("/")
    known = manifests(spark, path)
    if known:
        # the weeks the last manifest names (one row a week): its runs prune the folders
        now = manifest_rows(spark, path, known[-1])
        runs = [r.run for r in now.select("run").distinct().collect()]
        df = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])).parquet(f"{path}/data")
        now = now.select(F.col("run").alias("__run"), F.col("SnapDate").alias("__d"))
        current = (F.col("run") == F.col("__run")) & F.col("SnapDate").eqNullSafe(F.col("__d"))
        df = df.where(F.col("run").isin(runs)).join(now, current, "left_semi").drop("run")
    elif path_exists(spark, path) and not manifests(spark, path, complete=False) and not path_exists(spark, f"{path}/data"):
        df = spark.read.schema(schema).parquet(path)
    else:
        return spark.createDataFrame([], schema)
    return in_order(df) if ordered else df
