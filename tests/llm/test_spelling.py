"""Spelling variants against a plain version."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orelode.llm import queries, spelling


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def plain_near(words):
    """Words by the strings that they become with one character left out, then checked."""
    by = defaultdict(set)
    for w in words:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if b != a and one_edit(a, b)}
    return near


def plain(rows):
    n = plain_words(rows)
    near, form = plain_near(n), {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def as_dict(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert as_dict(queries.op12_spelling_variants(spark, sf_dir)) == plain([tuple(r) for r in docs])


def test_dense_words(spark):
    """Words over two letters, where nearly all meet, repeated letters, and chains of forms."""
    import itertools

    words = ["".join(w) for w in itertools.product("ab", repeat=7)] + ["a" * k for k in range(8, 30)]
    words += ["ÀÉÿabcd", "Àéÿabcd", "àÉÿABCDE"]
    rows = [(i, " ".join([w] * (2 + i % 3))) for i, w in enumerate(words)]
    rows += [(1000, "aaaaaaa " * 300), (1001, "aaaaaab,aaaaaab;" * 10), (1002, "aaaaaaaa " * 5000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert as_dict(spelling.variants(df)) == plain(rows)


def test_odd_rows(spark):
    long = "xy" * 1_000
    rows = [(None, "Wonderful wonderful"), (2, None), (3, ""), (4, "wonderfull wonderfull " * 2), (4, "wonderfull"),
            (5, "one-two 12 ×÷×÷×÷×÷ short"), (6, f"{long} {long}"), (7, f"{long}z {long}z"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = as_dict(spelling.variants(df))
    assert out == plain(rows) and long + "z" in out
    assert spelling.variants(df.limit(0)).count() == 0


def test_very_long_runs(spark):
    long = "xy" * 50_000
    words = spark.createDataFrame([(long, 30), (long + "z", 3), (long[:500] + long[501:], 2)], "word string, n long")
    out = as_dict(spelling.group_words(words))
    assert out == {
        long: (30, 2, None, None, long), long + "z": (3, 1, long, 30, long),
        long[:500] + long[501:]: (2, 1, long, 30, long),
    }


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=6), st.text("ab", min_size=1, max_size=6))
def test_plain_one_edit(a, b):
    edits = {a[:i] + c + a[i + k :] for i in range(len(a) + 1) for c in ("", "a", "b") for k in (0, 1)} - {a}
    assert one_edit(a, b) == (b in edits and abs(len(a) - len(b)) <= 1)


def test_trie_has_forks_only(spark):
    words = spark.createDataFrame([("wonderful",), ("wonderfull",), ("splendid",)], "word string")
    edges, starts = spelling.trie(words)
    labels = {r["label"] for r in edges.collect()}
    assert "l" in labels and starts.count() == 6
    assert edges.filter(F.col("end_word") == "splendid").count() == 2


def test_runs_of_a_least_length_are_whole_runs(spark):
    docs = spark.createDataFrame([(1, "Abc abcdefG abcdefgh Ärmelchen ab1abcdefg"), (2, None)], "doc_id long, text string")
    found = sorted(r.run for r in spelling.occurrences(docs, "doc_id", "text", 7).collect())
    assert found == ["abcdefg", "abcdefg", "abcdefgh", "Ärmelchen"]


def test_one_edit_at_the_first_character_needs_no_distance(spark):
    words = ["", "a", "b", "ab", "ba", "abc", "xbc", "bc", "xabc", "abcd", "cab", "é", "éa", "x" * 70, "y" + "x" * 69, "y" + "x" * 70]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    one = F.coalesce(spelling._one_edit(F.col("a"), F.col("b")), F.lit(False))
    wrong = pairs.filter(one != (F.levenshtein("a", "b") == 1)).collect()
    assert wrong == []
