"""Quality by histogram gradient-boosted trees over document statistics.

Each whole text becomes a fixed vector of statistics (character classes, words, repetition,
lines).  Trees are boosted on a bounded sample of labelled documents outside the held-out fold:
statistics are cut into at most 64 bins once, each level adds gradient and Hessian histograms
per open node and takes the best split, and leaves hold shrunken Newton steps.  The trees are
complete, so the forest is three flat arrays (statistic, bin, leaf value) that numpy walks for
all rows of a batch at once, one step per level.

Null and empty texts have all-zero statistics and are scored like any other.  Rows are scored
one by one (repeated rows get equal scores); other columns are not read.  With no labelled row,
or only one class, the score is the share of label 1 among the labels seen (0.5 with none).
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map, held_out, labelled_sample


@dataclass(frozen=True)
class Params:
    fit_rows: int = 20_000  # labelled documents the fit uses at most
    rounds: int = 80
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    ridge: float = 1.0
    min_rows: int = 8  # least rows of a leaf
    threshold: float = 0.7


# Character classes by UTF-8 byte: 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 line feed,
# 6 sentence marks, 7 dashes and quotes, 8 brackets, 9 other symbols, 10 bytes beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
for _k, _set in enumerate((
    b"", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r",
    b".,;:?", b"-'\"", b"()[]{}<>", b"!#$%&*+/=@\\^_`|~",
)):
    _CLASS[list(_set)] = _k
_CLASS[128:] = 10

STATISTICS = (
    "log_bytes", "other", "upper", "lower", "digit", "space", "feed", "mark", "quote", "bracket", "symbol", "wide",
    "word_length", "word_deviation", "long_words", "short_words", "upper_words", "lower_words", "symbol_words",
    "distinct_words", "top_word", "repeated_next", "distinct_pairs", "top_pair", "lines", "distinct_lines",
    "words_a_line", "exclaims", "bars", "double_space", "at_signs", "equals",
)


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    n = len(raw)
    shares = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=11) / n
    words = raw.split()
    m = max(1, len(words))
    size = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    pairs = Counter(zip(words, words[1:]))  # noqa: B905
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    k = max(1, len(lines))
    return [
        math.log1p(n), *shares,
        size.mean(), size.std(), float((size > 15).mean()), float((size < 3).mean()),
        sum(map(bytes.isupper, words)) / m, sum(map(bytes.islower, words)) / m,
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / m,
        len(counts) / m, max(counts.values(), default=0) / m, sum(map(eq, words, words[1:])) / m,
        len(pairs) / m, max(pairs.values(), default=0) / m,
        math.log1p(k), len(set(lines)) / k, m / k,
        raw.count(b"!!") / m, raw.count(b" | ") / m, raw.count(b"  ") / m, raw.count(b"@") / m, raw.count(b"=") / m,
    ]


@dataclass(frozen=True)
class Forest:
    edges: np.ndarray  # statistic x cut
    statistic: np.ndarray  # tree x inner node, in heap order
    bin: np.ndarray  # go right if the statistic's bin is above this
    value: np.ndarray  # tree x leaf
    base: float
    depth: int
    threshold: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(self.statistic):
            binned = binning(x, self.edges)
            rows = np.arange(len(x))
            for t in range(len(self.statistic)):
                node = np.zeros(len(x), np.int64)
                for _ in range(self.depth):
                    node = 2 * node + 1 + (binned[rows, self.statistic[t, node]] > self.bin[t, node])
                total += self.value[t, node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def binning(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(x.shape[1])], axis=1)


def boost(x: np.ndarray, y: np.ndarray, p: Params = Params()) -> Forest:
    """Fit the forest.  A node without a split that gains sends all its rows left."""
    k = x.shape[1] if x.ndim == 2 else len(STATISTICS)
    edges = np.zeros((k, p.bins - 1))
    none = Forest(edges, np.zeros((0, 0), np.int64), np.zeros((0, 0), np.int64), np.zeros((0, 0)), 0.0, p.depth, p.threshold)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Forest(none.edges, none.statistic, none.bin, none.value, math.log(max(share, 1e-9) / max(1 - share, 1e-9)), p.depth, p.threshold)
    edges = np.stack([np.quantile(x[:, j], np.linspace(0, 1, p.bins + 1)[1:-1]) for j in range(k)])
    binned = binning(x, edges)
    base = math.log(y.mean() / (1 - y.mean()))
    inner, n = 2**p.depth - 1, len(y)
    total = np.full(n, base)
    stat, cut, value = (np.zeros((p.rounds, w), t) for w, t in ((inner, np.int64), (inner, np.int64), (inner + 1, float)))
    flat = binned + np.arange(k) * p.bins
    for t in range(p.rounds):
        q = 1 / (1 + np.exp(-total))
        g, h = q - y, q * (1 - q)
        node = np.zeros(n, np.int64)
        for level in range(p.depth):
            width, first = 2**level, 2**level - 1
            at = ((node - first) * (k * p.bins))[:, None] + flat
            gs, hs, cs = (
                np.bincount(at.ravel(), np.repeat(w, k), width * k * p.bins).reshape(width, k, p.bins).cumsum(2)
                for w in (g, h, np.ones(n))
            )
            ga, ha, ca = gs[:, :, -1:], hs[:, :, -1:], cs[:, :, -1:]
            gain = gs**2 / (hs + p.ridge) + (ga - gs) ** 2 / (ha - hs + p.ridge) - ga**2 / (ha + p.ridge)
            gain[(cs < p.min_rows) | (ca - cs < p.min_rows)] = -1
            best = gain.reshape(width, -1).argmax(1)
            gains = gain.reshape(width, -1).max(1)
            stat[t, first:first + width] = best // p.bins
            cut[t, first:first + width] = np.where(gains > 1e-6, best % p.bins, p.bins)
            node = 2 * node + 1 + (binned[np.arange(n), stat[t, node]] > cut[t, node])
        leaf = node - inner
        value[t] = -p.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + p.ridge)
        total += value[t, leaf]
    return Forest(edges, stat, cut, value, base, p.depth, p.threshold)


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Forest:
    """The driver gets one vector of statistics per sampled document, at most ``fit_rows``."""
    rows = arrow_map(
        labelled_sample(docs, labels, "quality", params.fit_rows),
        lambda c: {"x": [statistics(t) for t in c[0]], "y": c[1]}, "x array<double>, y int",
    ).toArrow()
    y = np.array(rows.column("y").to_pylist(), float)
    x = np.array(rows.column("x").to_pylist(), float).reshape(len(y), len(STATISTICS))
    order = np.lexsort([*x.T, y])  # the fit must not depend on the order of arrival
    return boost(x[order], y[order], params)


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    def run(c: list[list]) -> dict[str, list]:
        p = forest.probability(np.array([statistics(t) for t in c[1]]).reshape(len(c[1]), len(STATISTICS)))
        return {"doc_id": c[0], "score": p.tolist(), "predicted": (p >= forest.threshold).astype(int).tolist()}

    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
                     "doc_id bigint, score double, predicted int")


def op5(spark, docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    out = score(docs, fit(docs, labels, params))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
