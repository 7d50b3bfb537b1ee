"""Toxicity by maximum-scoring segments.

1. Token log-odds with an informative Dirichlet prior, from labelled documents outside the
   held-out fold: the toxic against the clean documents that hold a word or a word's stem (its
   leading letters), the prior being the pooled counts.  Tokens whose z-score passes the bound
   for so many tests form the lexicon.
2. A document's words become scores: a lexicon word its log-odds, any other word a small
   negative drift.  A linear-time scan (stack of disjoint segments) finds every maximal
   scoring segment: the toxic passages.
3. Extreme-value calibration: with the positive root L of sum p e^(L s) = 1 over the clean
   background, n e^(-L S) bounds the expected number of segments scoring S or more in n clean
   words; the best r segments are judged together by the sum statistic.  A logistic map fitted
   on the same sample turns -ln p into a score in 0..1.

Null and empty texts have no segment and get the score of no evidence.  Rows are scored one by
one, so repeated rows get equal scores; other columns are not read.  With no labelled row, or
labels of one class only (all clean or all toxic), there is no contrast to learn from: the lexicon
is empty, every score is 0 and nothing is rejected.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map, held_out, labelled_sample

WORD = re.compile(r"[^\W\d_]+")
NONE = 0.0  # the evidence of a text without a significant segment


@dataclass(frozen=True)
class Params:
    fit_rows: int = 20_000  # labelled documents the fit uses at most
    prior: float = 0.2  # the Dirichlet prior's weight, as a share of all counted tokens
    false_tokens: float = 10.0  # expected false tokens in the lexicon: sets the least z-score
    min_log_odds: float = 1.0
    min_documents: int = 3  # toxic documents that must hold a lexicon token
    stems: tuple[int, ...] = (4, 5, 6)  # lengths of the stems counted beside whole words
    drift: float = 0.4  # what a word outside the lexicon costs a segment
    max_p: float = 0.05  # segments, alone or together, are evidence up to this p-value
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    stems: tuple[int, ...] = ()
    drift: float = 0.4
    decay: float = 1.0  # the root L
    max_p: float = 0.05
    slope: float = 0.0
    intercept: float = -math.inf
    threshold: float = 0.3


def word_scores(words: list[str], model: Model) -> list[tuple[int, float]]:
    """(position, log-odds) of lexicon words; the most telling of a word's forms counts."""
    lex, found = model.lexicon, []
    seen: dict[str, float] = {}
    for i, w in enumerate(words):
        s = seen.get(w)
        if s is None:
            s = seen[w] = max([lex.get(w, 0.0), *(lex.get(w[:k] + "*", 0.0) for k in model.stems if len(w) >= k)])
        if s > 0:
            found.append((i, s))
    return found


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """Every maximal scoring segment as (first word, last word, score), in linear time.

    ``hits`` are the positive words; the words between cost ``drift`` each.  A stack holds
    disjoint candidates with the running totals before and after each.  A new positive run is
    merged with the nearest candidate that starts lower, if that candidate ends lower too.
    """
    stack: list[list[float]] = []  # first, last, total before, total after
    total, at = 0.0, 0
    for pos, s in hits:
        total -= drift * (pos - at)
        cur = [pos, pos, total, total + s]
        total, at = total + s, pos + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= cur[2]:
                j -= 1
            if j < 0 or stack[j][3] >= cur[3]:
                stack.append(cur)
                break
            cur = [stack[j][0], cur[1], stack[j][2], cur[3]]
            del stack[j:]
    return [(int(a), int(b), after - before) for a, b, before, after in stack]


def evidence(text: str | None, model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """-ln p of the most telling set of segments (``NONE`` if above ``max_p``) and the
    significant passages as (start, end, score) in code points of the text."""
    if not text or not model.lexicon:
        return NONE, []
    low = text.lower()
    words = WORD.findall(low)
    hits = word_scores(words, model)
    if not hits:
        return NONE, []
    segments = maximal_segments(hits, model.drift)
    ln_n = math.log(max(2, len(words)))
    best, total = -math.inf, 0.0
    for r, x in enumerate(sorted((model.decay * s - ln_n for _, _, s in segments), reverse=True), 1):
        if r > 1 and x <= 0:
            break
        total += x
        # sum statistic of the r best: p ~ e^-T T^(r-1) / (r! (r-1)!)
        best = max(best, total - ((r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r) if r > 1 else 0.0))
    if best < -math.log(model.max_p):
        return NONE, []
    spans = [m.span() for m in WORD.finditer(low)]
    # lower case may be longer than the text: the character that each of its positions comes from
    of = range(len(text)) if len(low) == len(text) else [i for i, c in enumerate(text) for _ in c.lower()]
    return best, [(of[spans[a][0]], of[spans[b][1] - 1] + 1, s) for a, b, s in segments
                  if model.decay * s - ln_n >= -math.log(model.max_p)]


def _count(batches: Iterator[pa.RecordBatch], stems: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each form, by label: a word that one text repeats counts once."""
    for batch in batches:
        forms: tuple[Counter, Counter] = (Counter(), Counter())
        for text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = set(WORD.findall(text.lower()))
            forms[1 if y else 0].update(words.union(w[:k] + "*" for w in words for k in stems if len(w) >= k))
        names = list(forms[0].keys() | forms[1].keys())
        yield pa.RecordBatch.from_pydict({
            "form": pa.array(names, pa.string()),
            "clean": pa.array([forms[0][f] for f in names], pa.int64()),
            "toxic": pa.array([forms[1][f] for f in names], pa.int64()),
        })


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratio and z-score of each token under a Dirichlet prior made of the pooled
    counts, of the weight ``prior`` x all counts."""
    pooled = toxic + clean
    a = prior * pooled
    a0 = prior * (n_toxic + n_clean)
    delta = np.log((toxic + a) / np.maximum(n_toxic + a0 - toxic - a, 1e-9)) - np.log((clean + a) / np.maximum(n_clean + a0 - clean - a, 1e-9))
    return delta, delta / np.sqrt(1 / (toxic + a) + 1 / (clean + a))


def decay_root(p: np.ndarray, s: np.ndarray, drift: float) -> float:
    """The positive root of sum p e^(L s) + (1 - sum p) e^(-L drift) = 1, by bisection."""
    rest = max(1e-12, 1 - p.sum())
    f = lambda x: float((p * np.exp(np.minimum(x * s, 600.0))).sum() + rest * math.exp(-x * drift) - 1)
    hi = 1e-3
    while f(hi) < 0 and hi < 60:
        hi *= 2
    lo = 0.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return max(hi, 1e-3)


def logistic_1d(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of a logistic map, by Newton steps with a small ridge."""
    w = np.zeros(2)
    z = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (q - y) + ridge * w
        h = (z * (q * (1 - q))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """Lexicon, decay and logistic map from at most ``params.fit_rows`` labelled documents.  The
    driver gets the significant tokens and one evidence value per sampled document; both are
    bounded by the sample."""
    sample = labelled_sample(docs, labels, "toxic", params.fit_rows)
    stems = params.stems
    counts = (
        sample.select("text", "y")
        .mapInArrow(lambda it: _count(it, stems), "form string, clean bigint, toxic bigint")
        .groupBy("form").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ).persist()
    word, tested = ~F.col("form").endswith("*"), F.col("toxic") >= params.min_documents
    whole = counts.agg(*[F.sum(F.when(word, F.col(c))) for c in ("clean", "toxic")], F.sum(tested.cast("long"))).first()
    n_clean, n_toxic, n_tested = (float(x or 0) for x in whole)
    if not n_toxic or not n_clean:
        counts.unpersist()
        return Model(threshold=params.threshold)
    # a token can pass only if its toxic count beats its share, which prunes before the driver
    cand = counts.where(F.col("toxic") * n_clean > F.col("clean") * n_toxic * math.exp(params.min_log_odds / 2)).where(tested).collect()
    counts.unpersist()
    tox = np.array([r["toxic"] for r in cand], float)
    cln = np.array([r["clean"] for r in cand], float)
    delta, z = log_odds(tox, cln, n_toxic, n_clean, params.prior)
    least_z = NormalDist().inv_cdf(1 - min(0.5, params.false_tokens / max(1.0, n_tested)))
    keep = (z >= least_z) & (delta >= params.min_log_odds)
    lexicon = {r["form"]: float(d) for r, d, k in zip(cand, delta, keep, strict=True) if k}
    if not lexicon:
        return Model(threshold=params.threshold)
    whole_words = np.array([k and not r["form"].endswith("*") for r, k in zip(cand, keep, strict=True)], bool)
    a0 = params.prior * (n_toxic + n_clean)
    p = (cln + params.prior * (tox + cln)) / (n_clean + a0)
    decay = decay_root(p[whole_words], delta[whole_words], params.drift) if whole_words.any() else 1.0
    model = Model(lexicon, stems, params.drift, decay, params.max_p, threshold=params.threshold)
    pairs = arrow_map(
        sample.select("text", "y"),
        lambda c: {"x": [evidence(t, model)[0] for t in c[0]], "y": [float(y) for y in c[1]]},
        "x double, y double",
    ).collect()
    slope, intercept = logistic_1d(squash(np.array([r["x"] for r in pairs])), np.array([r["y"] for r in pairs]))
    return Model(lexicon, stems, params.drift, decay, params.max_p, slope, intercept, params.threshold)


def squash(x):
    """Evidence on a scale for the logistic map: slower than linear far out."""
    return np.log1p(np.asarray(x, float))


def probability(x: float, model: Model) -> float:
    if model.intercept == -math.inf:
        return 0.0
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * float(squash(x)) + model.intercept))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, passages) of every row; ``passages`` are the significant
    segments as structs (start, end, score)."""

    def run(c: list[list]) -> dict[str, list]:
        found = [evidence(t, model) for t in c[1]]
        s = [probability(x, model) for x, _ in found]
        return {
            "doc_id": c[0], "score": s, "predicted": [int(v >= model.threshold) for v in s],
            "passages": [[{"start": a, "end": b, "score": v} for a, b, v in p] for _, p in found],
        }

    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run,
                     "doc_id bigint, score double, predicted int, passages array<struct<start:int,end:int,score:double>>")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` scored under the threshold, with all their columns."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("int")
    def toxic(text):
        import pandas as pd

        return pd.Series([int(probability(evidence(t, model)[0], model) >= model.threshold) for t in text], dtype="int32")

    return docs.where(toxic(F.col("text").cast("string")) == 0)


def op7(spark, docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    model = fit(docs, labels, params)
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "passages")
