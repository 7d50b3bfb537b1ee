"""Personal data: the anchored parsers against plain regular expressions."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from alertlens.llm import pii

AC = pii.automaton()
RX = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute(text):
    out = []
    for k, (kind, rx) in enumerate(RX.items()):
        for m in rx.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0,
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.Z@-+ 0123456789()%é\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.find(text, AC) if s[1] < 4] == brute(text)


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="1234. -+", max_size=40))
def test_base_spans_of_digit_soup(text):
    assert [s for s in pii.find(text, AC) if s[1] < 4] == brute(text)


def test_added_kinds():
    t = "see https://a.example.com/x?y=1. IBAN DE89 3704 0044 0532 0130 00, account number: 12345678; 12 Old Mill Road"
    got = {pii.KINDS[k]: t[a:b] for a, k, b in pii.find(t, AC) if k > 3}
    assert got == {"url": "https://a.example.com/x?y=1", "iban": "DE89 3704 0044 0532 0130 00",
                   "account": "12345678", "address": "12 Old Mill Road"}
    assert pii.redact(t, AC) == "see [URL]. IBAN [IBAN], account number: [ACCOUNT]; [ADDRESS]"


def test_documents(spark):
    long = "x" * 200_000 + " a@b.co " + "1 " * 5000
    rows = [(1, None, "z"), (2, "", "z"), (3, "mail a.b@c.de or +1 (784) 555-8120", "z"), (3, "mail a.b@c.de or +1 (784) 555-8120", "z"), (4, long, None), (None, "1.2.3.4", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = pii.scan(docs).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[1].spans == "" and by[1].base_sha256 == hashlib.sha256(b"").hexdigest() == by[2].base_sha256
    assert by[3].spans == "email:5:13,phone:17:34" and (by[3].n_email, by[3].n_phone) == (1, 1)
    assert by[4].n_email == 1 and by[None].n_ip == 1
    kept = pii.redacted(docs)
    assert kept.columns == docs.columns
    assert {r.text for r in kept.where("doc_id = 3").collect()} == {"mail [EMAIL] or [PHONE]"}
    assert pii.scan(docs.limit(0)).count() == 0


def test_whole_table_against_the_patterns(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in pii.scan(docs).collect():
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in want) for k in range(4)]
