"""Vector rows as bytes: what the two embedding operators read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map


def prepared(vectors: DataFrame, *more: Column) -> DataFrame:
    """(vec_id, *more, dim, norm, raw) of every row.  ``raw`` holds the components as
    little-endian doubles, ``norm`` is taken in double precision; both are null where the vector
    takes no part: null, empty, all zero, or with a null or non-finite component."""
    narrow = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), *more, F.col("embedding").cast("array<double>").alias("embedding"))
    types = dict(narrow.dtypes)
    names = narrow.columns[:-1]

    def run(c: list[list]) -> dict[str, list]:
        out: dict[str, list] = dict(zip(names, c, strict=False))
        got = [describe(v) for v in c[-1]]
        for k, n in enumerate(("dim", "norm", "raw")):
            out[n] = [g[k] for g in got]
        return out

    schema = ", ".join([*(f"{n} {types[n]}" for n in names), "dim int", "norm double", "raw binary"])
    return arrow_map(narrow, run, schema, rows=1024)


def describe(components: list | None) -> tuple[int, float | None, bytes | None]:
    v = np.array([np.nan if x is None else x for x in components or ()], "<f8")
    top = float(np.abs(v).max()) if len(v) else 0.0
    if not (0 < top < np.inf):  # also false for NaN
        return len(v), None, None
    w = v / top
    return len(v), min(top * float(np.sqrt((w * w).sum())), np.finfo(float).max), v.tobytes()


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow on the way."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def matrix(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), dim)
