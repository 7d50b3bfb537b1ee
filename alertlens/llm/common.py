"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.session import materialize

__all__ = ["arrow_map", "group_starts", "held_out", "labelled_sample", "materialize", "read_table", "whole_groups"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 4 is 2 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents outside the held-out fold, as (text, y).

    The sample is the ids with the smallest hash, so it does not depend on file order; its size
    bounds whatever a classifier gathers on the driver.  Rows with a null id or label take no
    part, and of equal texts with equal labels one stays, so that groups of copies don't
    dominate the fit.
    """
    picked = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
        .orderBy(F.xxhash64("_id"), "_id", "_y")
        .limit(rows)
    )
    joined = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_t")).join(F.broadcast(picked), "_id")
    return (
        joined.select(F.coalesce("_t", F.lit("")).alias("text"), F.col("_y").alias("y"))
        .dropDuplicates(["text", "y"])
    )


def arrow_map(df: DataFrame, fn: Callable[[list[list]], dict[str, list]], schema: str, rows: int = 256) -> DataFrame:
    """Map ``fn`` over slices of at most ``rows`` rows: it gets one Python list per input column
    and returns one list (or array) per output column.  Small slices keep a worker's memory
    bounded by a few hundred texts."""
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                out = fn([c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Regroup sorted batches into tables that hold only whole groups (equal values in the first
    ``keys`` columns): the last group of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []

    def same_as_last(batch: pa.RecordBatch, last: list) -> int:
        """Rows at the end of ``batch`` that belong to its last group."""
        differ = np.zeros(batch.num_rows, bool)
        for c, v in zip(batch.columns[:keys], last, strict=True):
            differ |= c.to_numpy(zero_copy_only=False) != v
        at = np.flatnonzero(differ)
        return batch.num_rows - (int(at[-1]) + 1 if len(at) else 0)

    for batch in batches:
        if not batch.num_rows:
            continue
        last = [c[batch.num_rows - 1].as_py() for c in batch.columns[:keys]]
        tail = same_as_last(batch, last)
        if tail < batch.num_rows or held and [c[0].as_py() for c in held[0].columns[:keys]] != last:
            yield pa.Table.from_batches([*held, batch.slice(0, batch.num_rows - tail)])
            held = []
        held.append(batch.slice(batch.num_rows - tail))
    if held:
        yield pa.Table.from_batches(held)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal keys starts."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)
