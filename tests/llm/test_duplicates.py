"""Near copies, repeated passages, URL rules and the two vector operators on hand-made cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orelode.llm import ann, embedding_dedup, minhash_dedup, suffix_dedup, suffixes, url_filter
from orelode.llm.components import components
from orelode.llm.queries import ORACLES, QUERIES
from orelode.llm.words import shingle_hashes, weighted_sets, word_hashes

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from compare import duck, duck_rows, spark_rows  # noqa: E402


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


# Components -----------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2200)]
    links += [(5, 5), (None, 7), links[0]]
    groups = Groups()
    for a, b in links:
        if a is not None:
            groups.link(a, b)
    df = spark.createDataFrame(links, "u long, v long")
    out = {r["id"]: r["component_id"] for r in components(df).collect()}
    assert out == {x: groups.find(x) for x in groups if groups.find(x) != x}
    assert components(df.limit(0)).count() == 0


# MinHash ----------------------------------------------------------------------------------------


def text_sets(texts):
    words, first = word_hashes(texts)
    s, o, c = weighted_sets(*shingle_hashes(words, first))
    cut = np.searchsorted(o, np.arange(len(texts) + 1))
    return [(s[a:b], minhash_dedup.weights(c[a:b])) for a, b in zip(cut, cut[1:])]


def test_words():
    words, first = word_hashes(["Ab, cd", "ab cd", None, "", "é E", "ab ab"])
    assert first.tolist() == [0, 2, 4, 4, 4, 6, 8]
    assert words[0] == words[2] == words[6] == words[7] and words[0] != words[1] and words[4] != words[5]
    assert len(shingle_hashes(*word_hashes(["a b c d e f", "a b", "", "a b c d e"]))[0]) == 4


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.integers(1, 5)), st.dictionaries(st.integers(0, 12), st.integers(1, 5)))
def test_probability_jaccard(a, b):
    pack = lambda d: (np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)], float))
    want = sum(
        1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in {*a, *b}) for d in {*a} & {*b}
    )
    assert minhash_dedup.similarity(pack(a), pack(b)) == pytest.approx(want)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(3)
    common, own = rng.integers(1, 1 << 62, 300), rng.integers(1, 1 << 62, 200)
    a, b = np.sort(np.append(common, own[:100])), np.sort(np.append(common, own[100:]))
    h = np.concatenate([a, b]).astype(np.uint64)
    owner, weight = np.repeat([0, 1], 400), np.where(np.isin(h, common[:50].astype(np.uint64)), 3.0, 1.0)
    s = minhash_dedup.signatures(h, owner, weight, 3, 4000)
    true = minhash_dedup.similarity((h[:400], weight[:400]), (h[400:], weight[400:]))
    assert (s[0] == s[1]).mean() == pytest.approx(true, abs=0.03) and (s[2] == 0).all()


def test_near_duplicate_groups(spark):
    rng = random.Random(2)
    base = [[f"w{rng.randrange(4000)}" for _ in range(120)] for _ in range(4)]
    texts = []
    for own in base:
        for _ in range(25):  # a group whose members differ among themselves
            copy = list(own)
            for _ in range(rng.choice((0, 0, 1, 2, 3))):
                copy[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += [None, "", "...", "a b c", "A, b. C!", "a b d", "x", texts[0], " ".join(f"u{i}" for i in range(30_000))]
    sets, groups = text_sets(texts), Groups()
    for i, j in itertools.combinations(range(len(texts)), 2):
        if minhash_dedup.similarity(sets[i], sets[j]) >= 0.8:
            groups.link(i, j)
    df = spark.createDataFrame(
        [(i, t, "class", "u") for i, t in enumerate(texts)], "doc_id long, text string, class_id string, u string"
    )
    out = {r["id"]: r["class_id"] for r in minhash_dedup.near_duplicates(df, "doc_id", "text").collect()}
    assert out == {i: groups.find(i) for i in range(len(texts))}
    kept = minhash_dedup.drop_near_duplicates(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in out if out[i] == i}
    assert minhash_dedup.near_duplicates(df.limit(0), "doc_id", "text").count() == 0


def test_ids_that_are_null_or_repeated(spark):
    df = spark.createDataFrame(
        [(None, "one two three four five six"), (None, None), (4, "b"), (4, "a"), (4, "a"), (9, "one two three four five six"),
         (7, "one two three four five six")], "doc_id long, text string",
    )
    out = {r["id"]: r["class_id"] for r in minhash_dedup.near_duplicates(df, "doc_id", "text").collect()}
    assert out == {4: 4, 7: 7, 9: 7}
    kept = minhash_dedup.drop_near_duplicates(df, "doc_id", "text").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [
        (0, ""), (0, "one two three four five six"), (4, "a"), (7, "one two three four five six")
    ]


# Suffix arrays -----------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b) * (1 + len(b) % 3)))
def test_suffix_array(data):
    text = np.frombuffer(data, np.uint8)
    sa = suffixes.suffix_array(text)
    want = sorted(range(len(data)), key=lambda i: data[i:])
    assert sa.tolist() == want
    if len(data) > 1:
        shared = suffixes.permuted_common_prefixes(text, sa, 9)
        for a, b in zip(want, want[1:]):
            n = 0
            while n < 9 and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
                n += 1
            assert shared[b] == n


def brute_kept(texts):
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - 199):
            seen[d[i : i + 200]] = seen.get(d[i : i + 200], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("often", [1_000, 3, 1])
def test_repeats_equal_brute_force(spark, often, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "OFTEN", often)
    rng = random.Random(9)
    fill = lambda n: "".join(rng.choice("abcdé ,") for _ in range(n))
    long, short, edge = fill(700), fill(150), fill(198)
    texts = [fill(300) + long + fill(50), long[100:500] + fill(20), fill(90) + short + fill(90) + short,
             None, "", "tiny", "tiny", "z" * 450, "yx" * 230, fill(260), edge + "q" * 30, "p" * 30 + edge]
    texts += [texts[9], texts[9]] + [fill(30) + long[50:330] + fill(30) for _ in range(6)]
    df = spark.createDataFrame(
        [(1, t, "x", 0) for t in texts], "doc_id long, text string, key string, copies int"
    ).withColumn("at", F.monotonically_increasing_id())
    out = suffix_dedup.remove_repeats(df, "text", "cleaned")
    assert out.columns == [*df.columns, "cleaned"]
    got = sorted(
        (r["text"] or "", r["cleaned"]["n_bytes"],
         sum(s["end"] - s["begin"] for s in r["cleaned"]["spans"]), len(r["cleaned"]["spans"]),
         hashlib.sha256(bytes(r["cleaned"]["kept"])).hexdigest())
        for r in out.collect()
    )
    assert got == sorted((t or "", *b) for t, b in zip(texts, brute_kept(texts)))
    assert suffix_dedup.remove_repeats(df.limit(0), "text").count() == 0


# URL rules ------------------------------------------------------------------------------------


def test_url_query_equals_sql(spark, sf_dir):
    name = "op8_url_rules"
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(duck(sf_dir), ORACLES[name])


def test_url_cases(spark):
    urls = {
        "http://Www.EXAMPLE.com/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "https://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "x://com": ("com", "", None, "allow"), "x://net/es/": ("net", "/es/", "net/es/", "block"),
        "x://a.net/ES/": ("a.net", "/ES/", None, "allow"), "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"), "": ("", "", None, "allow"),
        "http://spam-farm.example.org/a": ("spam-farm.example.org", "/a", None, "block"),
        "http://spammer.org/": ("spammer.org", "/", None, "allow"),
        "a://b://c.com/": ("b:", "//c.com/", None, "allow"),
    }
    data = [(i % 3, u, "p", "v") for i, u in enumerate([*urls, *urls])]
    df = spark.createDataFrame(data, "page_id int, url string, path string, verdict string")
    rules = (*url_filter.RULES, *url_filter.PATTERNS)
    out = url_filter.judge(df, "url", rules)
    assert {*df.columns[:2], "_path", "_verdict", "host", "path", "rule", "verdict"} == set(out.columns)
    rows = out.collect()
    assert len(rows) == len(data)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == urls[r["url"]], r
    assert url_filter.judge(df.limit(0), "url", rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge(df, "url", ()).collect()} == {"allow"}


# Vectors ----------------------------------------------------------------------------------------


def vectors(spark, data, kind="float"):
    return spark.createDataFrame(
        [(i, v, "label", 1) for i, v in data], f"vec_id long, embedding array<{kind}>, n_links string, n int"
    )


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_equal_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 50)
    monkeypatch.setattr(embedding_dedup, "STEP", 16)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((220, 24)).astype(np.float32)
    x[60:140] = x[0] + 0.25 * rng.standard_normal((80, 24))  # a crowd around 0.9
    x[140:160] = x[1]
    x[160] = 2 * x[2]
    data = [(k, v.tolist()) for k, v in enumerate(x.tolist() and x)]
    bad = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf"), *[1.0] * 23], [None, *[1.0] * 23], [1.0, 2.0]]
    data += [(1000 + k, v) for k, v in enumerate(bad)]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    groups = Groups()
    for i, j in np.argwhere(linked):
        groups.link(int(i), int(j))
    df = vectors(spark, data, kind)
    out = {r["vec_id"]: r for r in embedding_dedup.near_vectors(df, "vec_id", "embedding").collect()}
    assert len(out) == len(data)
    for k in range(220):
        assert (out[k]["n_links"], out[k]["component_id"]) == (linked[k].sum() - 1, groups.find(k))
    for k in range(len(bad)):
        assert (out[1000 + k]["n_links"], out[1000 + k]["component_id"]) == (0, 1000 + k)
    assert embedding_dedup.near_vectors(df.limit(0), "vec_id", "embedding").count() == 0


def test_neighbours_of_a_small_table_are_exact(spark):
    """With every cell of two hashes visited nothing is approximate: ties, copies and odd vectors."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((40, 8)).astype(np.float32)
    x[10:25] = x[0]
    data = [(k, v.tolist()) for k, v in enumerate(x)] + [(90, None), (91, [0.0] * 8), (92, [float("nan")] * 8), (None, x[0].tolist())]
    df = vectors(spark, data)
    every = ann.Settings(tables=2, hashes=2, width=9.0, probes=9)
    out = ann.nearest(df, "vec_id", "embedding", "vec_id % 5 = 0", 5, every).orderBy("query_id", "rank").collect()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for q in range(0, 40, 5):
        s = (u * u[q]).sum(1)
        want = sorted((k for k in range(40) if k != q), key=lambda k: (-round(s[k], 12), k))[:5]
        own = [r for r in out if r["query_id"] == q]
        assert [r["vec_id"] for r in own] == want and [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert [r["score"] for r in own] == pytest.approx([s[k] for k in want], abs=1e-12)
    assert {r["query_id"] for r in out} == set(range(0, 40, 5))
    assert ann.nearest(df.limit(0), "vec_id", "embedding", "true").count() == 0
    alone = ann.nearest(vectors(spark, data[:3]), "vec_id", "embedding", "vec_id = 0", 5, every)
    assert alone.count() == 2


def test_recall(spark, sf_dir):
    found = QUERIES["op1_nearest_neighbours"](spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    u = np.array([r["embedding"] for r in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = u @ u[q]
        s[q] = -2
        best = set(ids[np.argsort(-s)[:5]])
        hits += len(best & {r["vec_id"] for r in found if r["query_id"] == ids[q]})
        total += 5
    assert hits >= 0.9 * total


def test_nearest_sends_no_cells_to_the_driver(spark):
    """A few queries make six hundred rows each, so no size of theirs may have Spark broadcast the rows."""
    rng = np.random.default_rng(3)
    df = vectors(spark, [(k, v.tolist()) for k, v in enumerate(rng.standard_normal((40, 8)))])
    text = ann.nearest(df, "vec_id", "embedding", "vec_id % 5 = 0")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text


def test_nearest_of_mixed_dimensions_and_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(3 if i % 2 else 5).tolist()) for i in range(60)]
    # Two vectors of one id: the smaller counts, in whichever order they come.
    twice = [(0, [9.0, 0.0, 0.0, 0.0, 0.0]), (7, [-9.0, 0.5, 0.5])]
    want = None
    for order in (rows + twice, twice + rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").repartition(4)
        got = sorted(map(tuple, ann.nearest(df, "vec_id", "embedding", "vec_id % 10 = 0 or vec_id = 7").collect()))
        assert want is None or got == want
        want = got
    vectors = dict(rows) | {7: min(rows[7][1], [-9.0, 0.5, 0.5])}
    assert all(len(vectors[q]) == len(vectors[v]) for q, _, v, _ in got) and got
    for q, _, v, score in got:
        a, b = np.array(vectors[q]), np.array(vectors[v])
        assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_steps_of_large_batches_stay_small():
    """Vectorised steps over one batch of three million bytes: the arrays of one step at a time, no more."""
    import random
    import tracemalloc

    import pyarrow as pa

    from orelode.llm import minhash_dedup, suffix_dedup

    rng = random.Random(1)
    texts = ["".join(rng.choices("abcdefghij ", k=12_000)) for _ in range(250)]
    keyed = pa.RecordBatch.from_arrays([pa.array([str(i).encode() for i in range(250)]), pa.array(texts)], names=["key", "text"])
    listed = pa.RecordBatch.from_arrays([pa.array(range(250), pa.int64()), pa.array(texts)], names=["id", "text"])
    for step, batch, least in ((suffix_dedup._find_anchors, keyed, 1), (minhash_dedup._sign, listed, 250)):
        tracemalloc.start()
        rows = sum(out.num_rows for out in step(iter([batch])))
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert rows >= least
        assert most < 50_000_000, (step.__name__, most)
