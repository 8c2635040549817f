"""Personal data: base kinds against their patterns, added kinds on hand-made cases."""

from __future__ import annotations

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orelode.llm import personal_data, queries
from orelode.llm.personal_data import BASE, spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def good(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in found.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    out = [
        (kind, m.start(), m.end())
        for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(kind, m[0])
    ]
    return sorted(out, key=lambda s: (s[1], BASE.index(s[0])))


def base(text):
    return [s for s in spans(text) if s[0] in BASE]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="0123459@.+- ()aZ%é\n", max_size=80))
def test_base_equals_patterns(text):
    assert base(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "4111 1111 1111 1111", "5500-0000-0000-0004", "+1 (132) 555-1352", "+49 30 1234567", "1.2.3.4", ".5",
    "256.1.1.1", "a@b.c", "@", "x.y@z", " ", "-", "7", ".", "+", "und.34@mail7.example.com", "a@b@c.d",
]), max_size=12).map("".join))
def test_base_equals_patterns_near_real(text):
    assert base(text) == brute(text)


@pytest.mark.parametrize("text, want", [
    ("see ftp://bob:pa55@host.example.com/x", [("login", "ftp://bob:pa55@host.example.com")]),
    ("https://example.com/a@b", []),
    ("IBAN: GB82 WEST 1234 5698 7654 32 thanks", [("iban", "GB82 WEST 1234 5698 7654 32")]),
    ("iban DE89370400440532013000.", [("iban", "DE89370400440532013000")]),
    ("IBAN GB83 WEST 1234 5698 7654 32", []),
    ("My passport number is X1234567.", [("account", "X1234567")]),
    ("Account no: 00-123456-7 open", [("account", "00-123456-7")]),
    ("on account of illness, accountant 1234567", []),
])
def test_added_kinds(text, want):
    assert [(k, text[a:b]) for k, a, b in spans(text) if k not in BASE] == want


@pytest.mark.parametrize("unit", ["a", "a@", "1.", "1 ", "+1", "0", "1-", "://", "IBAN "])
def test_long_texts_take_linear_time(unit):
    short = unit * 300
    assert base(short) == brute(short)
    begun = time.perf_counter()
    spans(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - begun < 20


def test_rows(spark):
    text = "Mail a.b@c.de or +1 (132) 555-1352 é x@y.z"
    df = spark.createDataFrame(
        [(1, text, "a"), (2, None, "b"), (3, "", "c"), (1, text, "a"), (None, "10.0.0.1", "d")],
        "doc_id long, text string, spans string",
    )
    found = personal_data.finder()
    out = df.withColumn("found", found("text")).select("doc_id", "found", personal_data.masked(df["text"], found("text")).alias("m"))
    rows = sorted(out.collect(), key=str)
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 5 and by[2]["found"] == [] and by[2]["m"] is None and by[3]["m"] == ""
    assert by[1]["m"] == "Mail [email] or [phone] é [email]"
    assert by[None]["m"] == "[ip]"
    assert df.limit(0).select(found("text")).count() == 0


def test_query_equals_patterns(spark, sf_dir):
    import hashlib

    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    out = queries.op13_personal_data(spark, sf_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        want = brute(texts[r["doc_id"]])
        counts = [sum(s[0] == k for s in want) for k in BASE]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        own = [s for s in r["spans"].split(",") if s.split(":")[0] in BASE]
        assert ",".join(own) == joined
    assert sum(r["n_card"] + r["n_phone"] + r["n_email"] + r["n_ip"] for r in out) > 0
