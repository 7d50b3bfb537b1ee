"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors in one pass over a text: at-signs, plus signs,
digits, URL schemes and the cue words of accounts and street addresses.  Around each anchor a
local parser walks left and right over the characters its kind allows, checks the boundary and
validates (labels of a host, octets, Luhn, digit counts, mod-97).  Parsers never look further
than the run of allowed characters around their anchor, and every run is walked once, so the
work is linear in the text.

Kinds, in the order spans with equal starts are listed:

* ``email ip card phone``: the base kinds; per kind the leftmost non-overlapping runs, failing
  ones dropped without a retry.
* ``url``: ``http://``, ``https://``, ``ftp://`` or ``www.`` and a host with a dot.
* ``iban``: country letters, check digits and 11 to 30 letters or digits, in groups or not, that
  pass mod-97.
* ``account``: 6 to 17 digits after a cue such as ``account number``.
* ``address``: house number, one to four capitalised words and a street cue such as ``Street``.

Spans are code points, end exclusive.  A null text counts as empty and has no span.  Rows are
handled one by one (repeated rows get equal spans); other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone", "url", "iban", "account", "address")
BASE = KINDS[:4]

_DIGIT = frozenset("0123456789")
_ALNUM = _DIGIT | frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOCAL = _ALNUM | frozenset("._%+-")
_HOST = _ALNUM | frozenset("-")
_PHONE = _DIGIT | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\x0b\x0c\"'<>`{}|\\^")
_SCHEMES = ("http://", "https://", "ftp://", "HTTP://", "HTTPS://", "www.")
# Lengths of IBANs by country are not checked, mod-97 is.
_ACCOUNT_CUES = ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT")
_IBAN_CUES = ("IBAN", "iban", "Iban")
_STREET_CUES = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Square", "Terrace")


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, cues in (
        ("@", "@"), ("+", "+"), ("d", "0123456789"), ("url", _SCHEMES), ("iban", _IBAN_CUES),
        ("account", _ACCOUNT_CUES), ("address", _STREET_CUES),
    ):
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def _host_end(text: str, at: int, size: int) -> int:
    """End of ``label(.label)+`` from ``at``, or -1."""
    i = at
    while i < size and text[i] in _HOST:
        i += 1
    if i == at:
        return -1
    dotted = False
    while i + 1 < size and text[i] == "." and text[i + 1] in _HOST:
        i += 2
        while i < size and text[i] in _HOST:
            i += 1
        dotted = True
    return i if dotted else -1


def _luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) <= 3 and (not s or int(s) <= 255)


def _mod97(s: str) -> bool:
    rest = 0
    for ch in s[4:] + s[:4]:
        v = int(ch, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _digit_runs(text: str, at: int, size: int) -> tuple[int, list[tuple[int, int]]]:
    """The digit runs from ``at`` that single spaces, hyphens or dots join, and their end."""
    runs, i = [], at
    while True:
        j = i
        while j < size and text[j] in _DIGIT:
            j += 1
        runs.append((i, j))
        if j + 1 < size and text[j] in " -." and text[j + 1] in _DIGIT:
            i = j + 1
        else:
            return j, runs


def _numbers(text: str, runs: list[tuple[int, int]], out: list) -> None:
    """Addresses and cards among runs joined by single separators."""
    chain: list[tuple[int, int]] = []  # joined by dots
    for k, run in enumerate(runs):
        chain.append(run)
        if len(chain) == 4:
            if all(_octet(text[a:b]) for a, b in chain):
                out.append((chain[0][0], 1, chain[3][1]))
            chain = []
        if k + 1 < len(runs) and text[run[1]] != ".":
            chain = []
        elif k + 1 < len(runs) and not chain:
            pass
    lo = 0
    for k, run in enumerate(runs):
        if k + 1 == len(runs) or text[run[1]] == ".":
            digits = "".join(text[a:b] for a, b in runs[lo:k + 1])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((runs[lo][0], 2, run[1]))
            lo = k + 1


def _iban(text: str, at: int, size: int) -> int:
    """End of a valid IBAN from ``at``, or -1."""
    if not (at + 4 <= size and text[at:at + 2].isascii() and text[at:at + 2].isupper() and text[at + 2] in _DIGIT and text[at + 3] in _DIGIT):
        return -1
    got, i, ends = text[at:at + 4], at + 4, []
    while i < size and len(got) < 34:
        ch = text[i]
        if ch in _DIGIT or ("A" <= ch <= "Z"):
            got += ch
            i += 1
            ends.append((len(got), i))
        elif ch == " " and i + 1 < size and len(got) % 4 == 0 and (text[i + 1] in _DIGIT or "A" <= text[i + 1] <= "Z"):
            i += 1
        else:
            break
    for n, end in reversed(ends):
        if n < 15:
            break
        if (end == size or text[end] not in _ALNUM) and _mod97(got[:n]):
            return end
    return -1


def _address(text: str, cue: int, end: int) -> int:
    """Start of ``number Word{1,4}`` before the street cue at ``cue``, or -1."""
    if end < len(text) and text[end].isalnum():
        return -1
    i, words = cue, 0
    while words <= 4 and i > 0 and text[i - 1] == " ":
        j = i - 1
        while j > 0 and (text[j - 1].isalnum() or text[j - 1] in "'-") and i - j < 40:
            j -= 1
        word = text[j:i - 1]
        if not word or (j > 0 and text[j - 1].isalnum()):
            return -1
        if word[0] in _DIGIT:
            digits = word.rstrip("abcdefABCDEF")
            return j if words and len(digits) <= 5 and all(c in _DIGIT for c in digits) else -1
        if not word[0].isupper():
            return -1
        words, i = words + 1, j
    return -1


def find(text: str | None, ac) -> list[tuple[int, int, int]]:
    """All spans as (start, index of kind, end), sorted."""
    if not text:
        return []
    size, out = len(text), []
    end_email = end_number = end_phone = end_url = end_address = 0
    for last, (kind, length) in ac.iter(text):
        at = last - length + 1
        if kind == "d":
            if at >= end_number:
                end_number, runs = _digit_runs(text, at, size)
                _numbers(text, runs, out)
        elif kind == "@":
            i = at
            while i > end_email and text[i - 1] in _LOCAL:
                i -= 1
            if i < at and (end := _host_end(text, at + 1, size)) > 0:
                out.append((i, 0, end))
                end_email = end
        elif kind == "+":
            if at >= end_phone and at + 3 < size and text[at + 1] in _DIGIT:
                i = at + 2
                while i < size and text[i] in _PHONE:
                    i += 1
                while i > at + 3 and text[i - 1] not in _DIGIT:
                    i -= 1
                if i > at + 3:
                    end_phone = i
                    if 10 <= sum(ch in _DIGIT for ch in text[at:i]) <= 15:
                        out.append((at, 3, i))
        elif kind == "url":
            if at >= end_url and (at == 0 or text[at - 1] not in _ALNUM):
                host = _host_end(text, last + 1, size)
                if host > 0:
                    i = host
                    if i < size and text[i] in "/?#:":
                        while i < size and text[i] not in _URL_END:
                            i += 1
                        while i > host and text[i - 1] in ".,;:!?)]":
                            i -= 1
                    out.append((at, 4, i))
                    end_url = i
        elif kind == "iban":
            i = last + 1
            while i < size and i < last + 12 and text[i] in " :.=#":
                i += 1
            if (end := _iban(text, i, size)) > 0:
                out.append((i, 5, end))
        elif kind == "account":
            i = last + 1
            for word in (" number", " no", " Number", " No"):
                if text.startswith(word, i):
                    i += len(word)
                    break
            lo = i
            while i < size and i < lo + 4 and text[i] in " :.=#":
                i += 1
            j = i
            while j < size and j < i + 18 and text[j] in _DIGIT:
                j += 1
            if i > lo and 6 <= j - i <= 17 and (j == size or text[j] not in _ALNUM):
                out.append((i, 6, j))
        elif at >= end_address and (start := _address(text, at, last + 1)) >= end_address:
            out.append((start, 7, last + 1))
            end_address = last + 1
    out.sort()
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str | None, ac) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans become one,
    named after the first."""
    spans = find(text, ac)
    if not spans:
        return text
    out, at = [], 0
    k = 0
    while k < len(spans):
        a, kind, b = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < b:
            b = max(b, spans[k][2])
            k += 1
        out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, one count per base kind, base_sha256, spans) of every row."""
    cache: list = []

    def run(c: list[list]) -> dict[str, list]:
        if not cache:
            cache.append(automaton())
        found = [find(t, cache[0]) for t in c[1]]
        base = [[s for s in f if s[1] < 4] for f in found]
        out: dict[str, list] = {"doc_id": c[0]}
        for k, kind in enumerate(BASE):
            out[f"n_{kind}"] = [sum(s[1] == k for s in f) for f in base]
        out["base_sha256"] = [hashlib.sha256(joined(f).encode()).hexdigest() for f in base]
        out["spans"] = [joined(f) for f in found]
        return out

    return arrow_map(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced; other columns stay."""
    from pyspark.sql.functions import pandas_udf

    cache: list = []

    @pandas_udf("string")
    def clean(text):
        import pandas as pd

        if not cache:
            cache.append(automaton())
        return pd.Series([redact(t, cache[0]) for t in text], dtype=object)

    return docs.withColumn("text", clean(F.col("text").cast("string")))
