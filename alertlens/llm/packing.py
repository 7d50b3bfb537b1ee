"""Packing token sequences by multiway differencing.

Every row's text becomes token ids plus an end id.  A document gives full windows while it has
``window`` ids left and its rest is cut into pieces of at most ``piece`` ids.  A task collects
pieces into blocks of about ``block`` windows and splits each block over m windows by
Karmarkar-Karp differencing: the pieces, largest first, form partial partitions of one piece a
window; the two partitions with the largest spread are merged again and again, the heaviest
window of one onto the lightest of the other, until one partition is left.  m starts at the
least count that could hold the block and rises by one while a window exceeds the capacity.

Blocks hold a bounded number of ids, so a task's memory does not grow with its input, and ids
are never shuffled.  A sequence id is the task's number and a count within it, so a task that is
run again on the same split gives the same rows.

A null text counts as empty: such a document is its end id alone.  Every row is packed as a
document of its own, also if rows or ids repeat; doc_id may be null; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertlens.llm.common import _arrow_schema

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


@dataclass(frozen=True)
class Params:
    window: int = 2048
    piece: int = 512
    block: int = 64  # windows a block is meant to fill
    end_id: int = 1
    cache: int = 600_000  # distinct words a task remembers; beyond, it starts anew


#: A pre-token of an ASCII-lowered word: what the tokenizer's own split pattern gives when every
#: character beyond ASCII is a letter.
PIECE = r"('(?:s|t|re|ve|m|ll|d)|[a-z\x{80}-\x{10ffff}]+|[0-9]|[^\sa-z0-9\x{80}-\x{10ffff}]+)"


def _plain_letters() -> str:
    """Letters beyond ASCII (Latin, Greek, Cyrillic) that stay one letter each when normalized
    and lowered."""
    def plain(ch: str) -> bool:
        low = unicodedata.normalize("NFC", ch).lower()
        return ch.isalpha() and low.isalpha() and len(low) == 1 and low != "\u03c3"  # sigma lowers by its place

    return "".join(filter(plain, map(chr, range(0x80, 0x530))))


def _known(spec: str) -> bool:
    """Whether the tokenizer is of the kind that ``Encoder`` takes apart."""
    t = json.loads(spec)
    kinds = [n.get("type") for n in (t.get("normalizer") or {}).get("normalizers", [])]
    steps = (t.get("pre_tokenizer") or {}).get("pretokenizers", [])
    pattern = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    return (
        t["model"].get("type") == "BPE" and t["model"].get("end_of_word_suffix") == "</w>" and kinds == ["NFC", "Replace", "Lowercase"]
        and [s.get("type") for s in steps] == ["Split", "ByteLevel"] and steps[0].get("pattern") == {"Regex": pattern}
        and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True and not steps[1].get("use_regex")
    )


class _Numbers(dict):
    """Numbers keys in the order in which they are met."""

    def __init__(self):
        super().__init__()
        self.order: list = []

    def __missing__(self, key) -> int:
        n = self[key] = len(self.order)
        self.order.append(key)
        return n


class _Pool:
    """Id sequences by number."""

    def __init__(self):
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        self.start = np.concatenate([self.start, size.cumsum() - size + len(self.flat)])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, ids])

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences at these numbers, end to end, and their sizes."""
        n = self.size[at]
        ends = n.cumsum()
        return self.flat[np.repeat(self.start[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], n


class Encoder:
    """The tokenizer's ids, by words and pieces.

    Its pre-tokens hold no white space; inside a word its split pattern cuts runs of letters,
    single digits, runs of other marks and a few contractions, and byte-pair merges never cross a
    cut.  So each distinct piece is encoded once (many at a time, joined by spaces; the last id
    of a piece is one that ends a word), each distinct word is put together from its pieces, and
    a text from its words.  Pieces are normalized here and given to a copy of the tokenizer that
    only splits at spaces.  A text that holds anything but ASCII and plain letters, or what may be
    a special token, is encoded whole, and so is every text if the tokenizer's file does not name
    the split pattern and normalizers this rests on.
    """

    def __init__(self, spec: str, cache: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.cache = Tokenizer.from_str(spec), cache
        self.odd = f"<\\||[^\\x00-\\x7f{_plain_letters()}]" if _known(spec) else "(?s)."
        self.light = Tokenizer.from_str(spec)
        self.light.normalizer = normalizers.Sequence([])
        self.light.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.words, self.pieces = _Numbers(), _Numbers()
        self.of_word, self.of_piece = _Pool(), _Pool()
        self.pieces[""]  # an empty word has one piece, which has no id
        self.of_piece.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        """Encode the words met since the last call."""
        new = self.words.order[len(self.of_word.size):]
        if not new:
            return
        cut = pc.ascii_rtrim_whitespace(pc.replace_substring_regex(pa.array(new), PIECE, r"\1 "))
        cut = pc.ascii_split_whitespace(cut)
        coded = cut.flatten().dictionary_encode()
        known = np.fromiter(map(self.pieces.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        at = known[coded.indices.to_numpy()]
        pieces = self.pieces.order[len(self.of_piece.size):]
        flat, size = [], []
        for lo in range(0, len(pieces), 256):
            part = pieces[lo:lo + 256]
            text = unicodedata.normalize("NFC", " ".join(part)).lower()
            ids = np.array(self.light.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            end = np.flatnonzero(self.ends[ids]) + 1
            if len(end) != len(part):
                raise ValueError("the tokenizer does not keep to its pieces")
            flat.append(ids)
            size.append(np.diff(end, prepend=0))
        if flat:
            self.of_piece.add(np.concatenate(flat), np.concatenate(size))
        ids, n = self.of_piece.take(at)
        total = np.append(0, n.cumsum())
        self.of_word.add(ids, np.diff(total[cut.offsets.to_numpy()]))

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text; null counts as empty."""
        if len(self.words) > self.cache:
            self.clear()
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.odd)
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(odd, "", texts)))
        coded = split.flatten().dictionary_encode()
        known = np.fromiter(map(self.words.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        self._learn()
        at = known[coded.indices.to_numpy()]
        end = split.offsets.to_numpy().astype(np.int64)
        end -= end[0]
        for k, whole in enumerate(odd.to_pylist()):
            if whole:
                yield np.array(self._whole([texts[k].as_py()])[0], np.uint32)
            else:
                yield self.of_word.take(at[end[k]:end[k + 1]])[0]


def differencing(sizes: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Split items over m windows by Karmarkar-Karp multiway differencing: (window of each item,
    sum of each window)."""
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    heap = []
    for k, lo in enumerate(range(0, n, m)):
        items = order[lo:lo + m]
        sums = np.zeros(m, np.int64)
        sums[:len(items)] = sizes[items]
        member = [[int(i)] for i in items] + [[] for _ in range(m - len(items))]
        heap.append((-int(sums[0] - sums[-1]), k, sums, member))
    heapq.heapify(heap)
    k = len(heap)
    while len(heap) > 1:
        _, _, a, am = heapq.heappop(heap)
        _, _, b, bm = heapq.heappop(heap)
        sums = a + b[::-1]  # both are sorted from heavy to light
        at = np.argsort(-sums, kind="stable")
        sums = sums[at]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), k, sums, [am[i] + bm[m - 1 - i] for i in at.tolist()]))
        k += 1
    _, _, sums, member = heap[0]
    window = np.zeros(n, np.int64)
    for w, items in enumerate(member):
        window[items] = w
    return window, sums


def pack_block(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item; the window count rises while one exceeds the capacity."""
    m = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window, sums = differencing(sizes, m)
        if sums.max() <= capacity:
            return window
        m += 1


def pack(batches: Iterator[pa.RecordBatch], spec: str, p: Params, task: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(spec, p.cache)
    next_id = task << 32
    rows: list[tuple] = []  # (doc_id, start, length, crc, doc_tokens) of pieces that wait
    waiting = 0
    done: list[list] = [[] for _ in schema]

    def put(row: tuple, seq: int, offset: int) -> None:
        for col, v in zip(done, (*row, seq, offset), strict=True):
            col.append(v)

    def close() -> None:
        nonlocal rows, waiting, next_id
        if rows:
            window = pack_block(np.array([r[2] for r in rows], np.int64), p.window)
            fill = [0] * (int(window.max()) + 1)
            for r, w in zip(rows, window.tolist(), strict=True):
                put(r, next_id + w, fill[w])
                fill[w] += r[2]
            next_id += len(fill)
        rows, waiting = [], 0

    def emit() -> pa.RecordBatch:
        nonlocal done
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(done, schema, strict=True)], schema=schema)
        done = [[] for _ in schema]
        return out

    for batch in batches:
        for lo in range(0, batch.num_rows, 2500):
            ids_col, texts = batch.slice(lo, 2500).columns
            for doc_id, ids in zip(ids_col.to_pylist(), encoder.encode(texts), strict=True):
                ids = np.append(ids, np.uint32(p.end_id)).astype("<u4")
                n, at = len(ids), 0
                while at < n:
                    size = p.window if n - at >= p.window else min(p.piece, n - at)
                    row = (doc_id, at, size, zlib.crc32(ids[at:at + size].tobytes()), n)
                    at += size
                    if size == p.window:
                        put(row, next_id, 0)
                        next_id += 1
                    else:
                        rows.append(row)
                        waiting += size
                if waiting >= p.block * p.window:
                    close()
            if len(done[0]) > 10_000:
                yield emit()
    close()
    yield emit()


def op8(spark: SparkSession, docs: DataFrame, spec_path: str, params: Params = Params()) -> DataFrame:
    """One row per piece.  The tokenizer's file is read once and sent to every executor."""
    with open(spec_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    schema = _arrow_schema(spark, SCHEMA)

    def run(batches):
        from pyspark import TaskContext

        return pack(batches, spec.value, params, TaskContext.get().partitionId(), schema)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, SCHEMA)
