"""Removing passages that an earlier document has: prefix-partitioned suffix trees over words.

A window is ``WINDOW`` consecutive words.  A word goes if a window that covers it starts, word
for word, in a document with a smaller id too.  Windows are judged on the input.

1. Suffixes are sampled by content.  Every window picks the 8-word prefix with the least hash
   among those that start in it (the first, if several have it): its anchor.  Equal windows pick
   equal anchors, so only suffixes that start at an anchor need to meet.  An anchor's span is all
   words of the windows that picked it; spans of one anchor and one content form a class.
2. The 8-word prefix partitions the suffixes.  Prefixes of one document only drop out.  In a
   class, all documents but the least lose the whole span.
3. What is left are prefixes with several classes, where spans agree in part.  The least
   document of each class sends its span to its prefix's group, once however often it repeats
   the passage; what is found goes to all its places.  A group is a subtree: the
   windows in it are suffixes cut at WINDOW words, sorted, with the common prefix of neighbours;
   nodes at depth WINDOW are the repeats, and all documents in a node but the least lose the
   window.  The prefixes have variable length so that a subtree fits in memory: a prefix with
   more than ``GROUP`` classes is extended to all WINDOW words, where a subtree is one node and
   plain partial aggregation finds its least document.

Texts are shuffled once, and those with a repeat once more.  No group is gathered beyond GROUP
classes; hot prefixes and classes meet only in partial aggregates and in joins that adaptive
execution may split.

Words are runs of bytes other than white space (space and 9 to 13).  Null and empty texts have
none; very long texts are read whole.  Rows without an id neither cause nor suffer removal.  Rows
that repeat an id are each judged against smaller ids only.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.llm.common import _arrow_schema, arrow_map, group_starts, materialize, whole_groups

WINDOW = 50
PREFIX = 8
GROUP = 4096
REACH = WINDOW - PREFIX + 1  # prefixes that start in a window
_BASE = np.uint64(0x9E3779B97F4A7C15)  # any odd number with mixed bits
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words; each distinct word is hashed once until the cache is full."""

    def __init__(self, most: int = 500_000):
        self.most, self.index, self.pool = most, {}, np.zeros(1 << 12, np.uint64)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.index) > self.most:
            self.index = {}
        index = self.index
        for w in set(words).difference(index):
            k = len(index)
            if k == len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[k] = xxhash.xxh64_intdigest(w, 7)
            index[w] = k
        return self.pool[np.fromiter(map(index.__getitem__, words), np.int64, len(words))]


def running(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of h[i] * BASE^i and the powers of 1/BASE: what ``spans`` needs."""
    power = np.concatenate([[np.uint64(1)], np.full(len(h), _BASE)]).cumprod(dtype=np.uint64)
    back = np.concatenate([[np.uint64(1)], np.full(len(h), _BACK)]).cumprod(dtype=np.uint64)
    return np.concatenate([[np.uint64(0)], (h * power[:-1]).cumsum(dtype=np.uint64)]), back


def spans(total: np.ndarray, back: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences [lo, hi)."""
    return mix((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64))


def least_in_reach(x: np.ndarray, reach: int) -> np.ndarray:
    """Position of the first least value in every run of ``reach`` values."""
    pos, best, done = np.arange(len(x)), x.copy(), 1
    while done < reach:
        step = min(done, reach - done)  # the runs of ``done`` values at i and i + step cover one of done + step
        a, b = best[: len(best) - step], best[step:]
        left = a <= b
        pos = np.where(left, pos[: len(a)], pos[step:])
        best = np.where(left, a, b)
        done += step
    return pos


def anchors(h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(prefix hash, class hash, first word, windows) of the anchors of a document."""
    n = len(h)
    if n < WINDOW:
        e = np.zeros(0, np.uint64)
        return e, e, np.zeros(0, np.int64), np.zeros(0, np.int64)
    total, back = running(h)
    at = np.arange(n - PREFIX + 1)
    prefix = spans(total, back, at, at + PREFIX)
    picked = least_in_reach(prefix, REACH)  # one per window
    first = group_starts(picked)
    count = np.diff(np.append(first, len(picked)))
    return prefix[picked[first]], spans(total, back, first, first + count + WINDOW - 1), first, count


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scan(rows: DataFrame) -> DataFrame:
    """(doc_id, row, n_words, sha, anchors...) of every row; the lists are parallel."""
    state: list = []

    def run(c: list[list]) -> dict[str, list]:
        if not state:
            state.append(WordHashes())
        out: dict[str, list] = {k: [] for k in ("doc_id", "row", "n_words", "sha", "h", "c", "at")}
        for doc, row, text in zip(*c, strict=True):
            words = words_of(text)
            h, k, first, count = anchors(state[0](words)) if doc is not None and len(words) >= WINDOW else ((),) * 4
            for name, v in zip(out, (
                doc, row, len(words), digest(words), *(np.asarray(x, np.uint64).view(np.int64) for x in (h, k)),
                np.asarray(first, np.int64) * 64 + np.asarray(count, np.int64),  # count is at most REACH
            ), strict=True):
                out[name].append(v)
        return out

    return arrow_map(rows, run, "doc_id bigint, row bigint, n_words bigint, sha string, h array<bigint>, c array<bigint>, at array<bigint>")


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text); doc_id and row name a row up to rows that are equal.  ``row`` is a
    hash of the text for ids that repeat and 0 for all others, which costs next to nothing to
    shuffle beside each anchor."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    again = rows.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("again"))
    rows = rows.join(materialize(again, "sub-repeated"), "doc_id", "left")
    return rows.select("doc_id", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0)).cast("bigint").alias("row"), "text")


def _contexts(candidates: DataFrame) -> DataFrame:
    """(h, h2, doc_id, row, first, count, words) of the spans that go to subtrees, h2 being the
    class, one span a class and text; ``big`` ones one row a window, with h and h2 the window's
    own hashes."""
    schema = "big boolean, h bigint, h2 bigint, doc_id bigint, row bigint, first bigint, count bigint, words binary"
    arrow = _arrow_schema(candidates.sparkSession, schema)
    state: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(WordHashes())
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                out: list[list] = [[] for _ in arrow]
                for doc, row, text, parts in zip(*(x.to_pylist() for x in batch.slice(lo, 128).columns), strict=True):
                    words = words_of(text)
                    total = back = None
                    sent: set[tuple[int, int]] = set()
                    for p in parts:
                        first, count = p["at"] >> 6, p["at"] & 63
                        if not p["big"]:
                            if (p["h"], p["c"]) in sent:
                                continue
                            sent.add((p["h"], p["c"]))
                            values = [(False, p["h"], p["c"], doc, row, first, count, b" ".join(words[first:first + count + WINDOW - 1]))]
                        else:
                            if total is None:
                                h = state[0](words)
                                total, back = running(h)
                                total2, _ = running(mix(h))
                            at = np.arange(first, first + count)
                            k = spans(total, back, at, at + WINDOW).view(np.int64).tolist()
                            k2 = spans(total2, back, at, at + WINDOW).view(np.int64).tolist()
                            values = [(True, a, b, doc, row, i, 1, b"") for a, b, i in zip(k, k2, at.tolist(), strict=True)]
                        for v in values:
                            for col, x in zip(out, v, strict=True):
                                col.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow)

    return candidates.select("doc_id", "row", "text", "parts").mapInArrow(run, schema)


def subtrees(table: pa.Table) -> tuple[np.ndarray, ...]:
    """The repeats of whole groups (h, c, doc_id, row, count, words), one row a class: (doc_id,
    row, h, c, first, end) of the windows that a smaller document of the group has, as runs of
    words counted from the span's start.

    Per group: the suffixes cut at WINDOW words in sorted order with the length of the prefix
    each shares with its neighbour; a node at depth WINDOW is a run of neighbours that share all.
    """
    h, c, doc, row, count = (table.column(n).to_numpy() for n in ("h", "c", "doc_id", "row", "count"))
    group = np.cumsum(np.append(0, h[1:] != h[:-1])) if len(h) else h
    number: dict[bytes, int] = {}
    flat = [number.setdefault(w, len(number)) for s in table.column("words").to_pylist() for w in s.split()]
    flat = np.array(flat, ">i4")  # big-endian, so that byte order is word-number order
    start = np.append(0, (count + WINDOW - 1).cumsum())[:-1]
    context = np.repeat(np.arange(len(h)), count)
    inside = np.arange(len(context)) - np.repeat(np.append(0, count.cumsum())[:-1], count)
    suffix = flat[(start[context] + inside)[:, None] + np.arange(WINDOW)]
    keyed = np.concatenate([group[context].astype(">i4")[:, None], suffix], axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"V{4 * (WINDOW + 1)}").ravel(), kind="stable")
    s = keyed[order]
    differ = s[1:] != s[:-1]
    shared = np.where(differ.any(1), differ.argmax(1) - 1, WINDOW)  # words shared with the next; -1: another group
    node = np.append(0, (shared < WINDOW).cumsum())
    d = doc[context[order]]
    least = np.full(int(node[-1]) + 1 if len(node) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, node, d)
    hit = np.zeros(len(order), bool)
    hit[order] = d > least[node]
    # windows that follow each other in a span become one run
    at = np.flatnonzero(hit)
    if not len(at):
        return tuple(doc[:0] for _ in range(6))
    new = np.append(True, (at[1:] != at[:-1] + 1) | (context[at[1:]] != context[at[:-1]]))
    lo, hi = at[new], at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    of = context[lo]
    return doc[of], row[of], h[of], c[of], inside[lo], inside[hi] + WINDOW


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "row", "h", "c", "first", "end"]
    for table in whole_groups(batches, 1):
        cuts = group_starts(table.column("h").to_numpy())
        lo = 0
        for k, cut in enumerate([*cuts[1:].tolist(), table.num_rows]):  # some thousand spans at a time
            if cut - lo >= GROUP or k == len(cuts) - 1:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in subtrees(table.slice(lo, cut - lo))], names=names)
                lo = cut


def group_rows(found: DataFrame) -> DataFrame:
    """What subtrees get: one row a class.  Texts that share an id share their classes; one sends."""
    small = found.where("not big").withColumnRenamed("h2", "c").select("h", "c", "doc_id", "row", "count", "words")
    return small.where("row = 0").unionByName(small.where("row != 0").dropDuplicates(["h", "c"]))


def sent_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(every row's scan, candidates with their texts and spans, the span lists, spans for subtrees)."""
    texts = _rows(docs)
    scan = materialize(_scan(texts), "sub-scan")
    rows = scan.select("doc_id", "row", F.explode(F.arrays_zip("h", "c", "at")).alias("x")).select("doc_id", "row", "x.h", "x.c", "x.at")
    shared = rows.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h")
    rows = materialize(rows.join(materialize(shared, "sub-shared"), "h"), "sub-anchors")
    classes = materialize(rows.groupBy("h", "c").agg(F.min("doc_id").alias("least")), "sub-classes")
    several = classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", (F.col("n") > GROUP).alias("big"))
    rows = rows.join(classes, ["h", "c"]).withColumn("whole", F.col("doc_id") > F.col("least"))
    rows = rows.join(materialize(several, "sub-several"), "h", "left").where("whole or big is not null")
    part = F.struct("whole", F.coalesce("big", F.lit(False)).alias("big"), *(F.when(~F.col("whole"), F.col(x)).alias(x) for x in ("h", "c")), "at")
    lists = materialize(rows.groupBy("doc_id", "row").agg(F.collect_set(part).alias("parts")), "sub-lists")
    lists = lists.select(
        "doc_id", "row", F.transform(F.filter("parts", lambda p: p.whole), lambda p: p["at"]).alias("spans"),
        F.filter("parts", lambda p: ~p.whole).alias("parts"),
    )
    candidates = materialize(texts.join(lists, ["doc_id", "row"]), "sub-candidates")
    found = materialize(_contexts(candidates.where(F.size("parts") > 0)), "sub-contexts")
    return scan, candidates, lists, found


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(every row's scan, candidates with their texts and spans, runs found in subtrees: relative
    to every span of their class, or to the text where h is null)."""
    scan, candidates, lists, found = sent_spans(docs)
    small = group_rows(found).repartition("h").sortWithinPartitions("h")
    runs = materialize(small.mapInArrow(_subtrees, "doc_id bigint, row bigint, h bigint, c bigint, first bigint, end bigint"), "sub-subtrees")
    # all texts of the id that hold the class get its runs
    holders = lists.where("row != 0").select("doc_id", "row", F.explode("parts").alias("x")).where("not x.big").select("doc_id", "row", "x.h", "x.c").distinct()
    runs = runs.where("row = 0").unionByName(runs.where("row != 0").drop("doc_id", "row").join(holders, ["h", "c"]))
    windows = found.where("big").select("h", "h2", "doc_id", "row", "first")
    least = materialize(windows.groupBy("h", "h2").agg(F.min("doc_id").alias("least")), "sub-nodes")
    more = windows.join(least, ["h", "h2"]).where("doc_id > least")
    null = F.lit(None).cast("bigint")
    more = more.select("doc_id", "row", null.alias("h"), null.alias("c"), "first", (F.col("first") + WINDOW).alias("end"))
    runs = runs.unionByName(more).groupBy("doc_id", "row").agg(F.collect_set(F.struct("h", "c", "first", "end")).alias("runs"))
    return scan, candidates, materialize(runs, "sub-runs")


def kept_words(words: list[bytes], whole: list[int], parts: list[dict], runs: list[dict] | None) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    for at in whole:
        change[at >> 6] += 1
        change[(at >> 6) + (at & 63) + WINDOW - 1] -= 1
    places: dict[tuple, list[int]] = {(None, None): [0]}
    for p in parts if runs else ():
        if not p["big"]:
            places.setdefault((p["h"], p["c"]), []).append(p["at"] >> 6)
    for r in runs or ():
        start = np.array(places[r["h"], r["c"]])
        np.add.at(change, start + r["first"], 1)
        np.add.at(change, start + r["end"], -1)
    return [w for w, gone in zip(words, change.cumsum()[:-1].tolist(), strict=True) if not gone]


def deduplicated(spark: SparkSession, docs: DataFrame, texts: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; with ``texts`` the kept words
    joined by spaces too, as ``kept`` (null: nothing was removed)."""
    scan, candidates, runs = repeats(docs)

    def run(c: list[list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "row", "n_words", "n_removed", "kept_sha256", "kept")}
        for doc, row, text, whole, parts, found in zip(*c, strict=True):
            words = words_of(text)
            kept = kept_words(words, whole, parts, found)
            for name, v in zip(out, (doc, row, len(words), len(words) - len(kept), digest(kept),
                                     b" ".join(kept).decode() if texts and len(kept) < len(words) else None), strict=True):
                out[name].append(v)
        return out

    schema = "doc_id bigint, row bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    named = candidates.select("doc_id", "row", "text", "spans", "parts")
    # only rows that sent spans to subtrees can have runs; the others need no join
    cut = named.where(F.size("parts") > 0).join(runs, ["doc_id", "row"], "left")
    cut = cut.unionByName(named.where(F.size("parts") == 0).withColumn("runs", F.lit(None).cast(runs.schema["runs"].dataType)))
    cut = arrow_map(cut.select("doc_id", "row", "text", "spans", "parts", "runs"), run, schema)
    ids = candidates.select("doc_id", "row").distinct()
    whole = scan.join(ids, ["doc_id", "row"], "left_anti").select(
        "doc_id", "row", "n_words", F.lit(0).cast("bigint").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept"))
    out = cut.unionByName(whole).drop("row")
    return out if texts else out.drop("kept")
