"""Language ID, packing, byte-level BPE, quality and licence scan on hand-made cases."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orelode.llm import bpe, lang_id, license_scan, packing, quality_lm
from orelode.sources.paths import scratch_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, found string, score string"
ODD = [None, "", " ", "\n\n\t", "12 34", "…!?", "x", "ﬀ Å ǆ 한국", "é å", "'s don't THE'S", "\x1c a\x1db"]


def rows(texts, langs=None):
    langs = langs or [None] * len(texts)
    return [(i, t, l, "extra", "column") for i, (t, l) in enumerate(zip(texts, langs))]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(BYTES, public_tokenizers.PATTERN)


# Byte-level BPE -------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab C1\n\t '.srtéß　日\x1c", max_size=400))
def test_tree_equals_library(text):
    own = bpe._codec(BYTES, public_tokenizers.PATTERN)
    leaf, match = bpe.LEAF_CHARS, bpe.LEAF_BYTES
    bpe.LEAF_CHARS, bpe.LEAF_BYTES = 16, 4
    try:
        ids = own.encode(text)
    finally:
        bpe.LEAF_CHARS, bpe.LEAF_BYTES = leaf, match
    assert ids == own.encoding.encode_ordinary(text)
    assert own.decode(np.array(ids, "<u4")) == text.encode()


def test_long_matches(codec):
    for text in ("a" * 70_000, " " * 70_000 + "x", "ab1" * 30_000):
        assert codec.encode(text) == codec.encoding.encode_ordinary(text)


def test_bpe_columns(spark):
    texts = [*ODD, "same", "same", "word " * 20_000]
    df = spark.createDataFrame(rows(texts), SCHEMA)
    encode, decode = bpe.encoder(BYTES, public_tokenizers.PATTERN), bpe.decoder(BYTES, public_tokenizers.PATTERN)
    out = df.select("doc_id", encode("text").alias("ids")).withColumn("back", decode("ids")).collect()
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks={p: r for r, p in bpe._codec(BYTES, public_tokenizers.PATTERN).pieces.items()},
    )
    for r in out:
        text = texts[r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r["back"]) == text.encode()
    assert df.limit(0).select(encode("text")).count() == 0


# Packing ------------------------------------------------------------------------------------------


def library_ids(texts):
    t = Tokenizer.from_file(WORDS)
    return [
        np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for x in texts
    ]


def check_packing(out, texts, most):
    want = library_ids(texts)
    seen = {i: 0 for i in range(len(texts))}
    for r in sorted(out, key=lambda r: (r["doc_id"], r["start"])):
        own = want[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["start"] == seen[r["doc_id"]] and r["length"] > 0
        part = own[r["start"] : r["start"] + r["length"]].tobytes()
        assert bytes(r["ids"]) == part and r["ids_crc32"] == zlib.crc32(part)
        seen[r["doc_id"]] += r["length"]
    assert seen == {i: len(w) for i, w in enumerate(want)}
    sizes = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sizes.get(r["sequence_id"], 0)
        sizes[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sizes.values()) <= most
    return sizes


def test_packing_cases(spark):
    texts = [*ODD, "same one.", "same one.", "wörd " * 9_000, "a." * 5_000, "Long " + "x" * 9_000,
             "a <|endoftext|> b", "A<|startoftext|>b <|ENDOFTEXT|> <|x|>", "<|endoftext|>"]
    df = spark.createDataFrame(rows(texts), SCHEMA)
    for most in (4096, 100):
        check_packing(packing.pack(df, "doc_id", "text", WORDS, most).collect(), texts, most)
    assert packing.pack(df.limit(0), "doc_id", "text", WORDS).count() == 0


def test_packing_keeps_rows_without_id(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    out = packing.pack(df, "doc_id", "text", WORDS).collect()
    assert sorted((r["doc_id"] is None, r["length"]) for r in out) == [(False, 1), (True, 3), (True, 3)]


def test_little_padding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").coalesce(1)
    texts = [r["text"] for r in docs.select("text").collect()]
    keys = [r["doc_id"] for r in docs.select("doc_id").collect()]
    place = {k: i for i, k in enumerate(keys)}
    out = [
        r.asDict() | {"doc_id": place[r["doc_id"]]}
        for r in packing.pack(docs, "doc_id", "text", WORDS).collect()
    ]
    sizes = check_packing(out, texts, 4096)
    padding = sum(4096 - n for n in sizes.values() if n & (n - 1))
    assert padding < 0.01 * sum(sizes.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=14), st.lists(st.integers(0, 30), min_size=15, max_size=15))
def test_cuts_are_the_cheapest(gaps, costs):
    places = np.concatenate([[0], np.cumsum(gaps)])
    penalties = np.array([0, *costs[: len(gaps)]])
    limit = 16

    def price(n):
        return min(limit - n, math.inf if n & (n - 1) or n == limit else packing.SHORT_WINDOW)

    best = [0.0] + [math.inf] * len(gaps)
    for j in range(1, len(places)):
        for i in range(j):
            n = int(places[j] - places[i])
            if n <= limit:
                best[j] = min(best[j], best[i] + price(n) + penalties[j])
    cuts = packing.best_cuts(places, penalties, limit, last=True)
    total, i = 0.0, 0
    for j in cuts:
        total += price(int(places[j] - places[i])) + penalties[j]
        i = j
    assert cuts[-1] == len(gaps) and total == pytest.approx(best[-1])


# Language ID ------------------------------------------------------------------------------------


def test_language_cases(spark):
    texts = ["the cat and the dog", "le chat et le chien", "the house", "la maison et le jardin", None, "", "42 !"]
    langs = ["en", "fr", "en", "fr", "en", None, "fr"]
    df = spark.createDataFrame(rows(texts, langs), SCHEMA)
    model = lang_id.train(df, "text", "lang")
    assert model.languages == ("en", "fr")
    predict = lang_id.predictor(spark.sparkContext.broadcast(model))
    out = {r["doc_id"]: r["p"] for r in df.select("doc_id", predict("text").alias("p")).collect()}
    assert [out[i]["lang_pred"] for i in range(7)] == ["en", "fr", "en", "fr", "und", "und", "und"]
    assert all(0 <= p["score"] <= 1 for p in out.values()) and out[4]["score"] == 0
    empty = lang_id.train(df.limit(0), "text", "lang")
    assert empty.predict(["text", None]) [0] == ["und", "und"]


def test_language_is_right_where_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = lang_id.train(docs.filter(~held), "text", "lang")
    rows_ = docs.filter(held).select("text", "lang").collect()
    names, _ = model.predict([r["text"] for r in rows_])
    assert np.mean([n == r["lang"] for n, r in zip(names, rows_)]) > 0.97


def test_ngrams_by_hand():
    """Sums over n-grams do not depend on what else is in the step, nor on signs and case."""
    alone = lang_id.ngrams(["Ab, cd"])[0]
    both, begins, letters = lang_id.ngrams(["", "ab  cd", None, "Ab-cd", "7"])
    parts = [sorted(both[a:b]) for a, b in zip(begins, begins[1:])]
    assert parts[1] == parts[3] == sorted(alone) and parts[0] == parts[2] == parts[4] == []
    assert letters.tolist() == [0, 4, 0, 4, 0]


def brute_language(labelled, text):
    """Naive Bayes over the same n-grams, counted one by one."""
    from collections import Counter

    size, counts, rows_ = 1 << lang_id.BUCKET_BITS, {}, Counter(n for _, n in labelled)
    for t, name in labelled:
        counts.setdefault(name, Counter()).update(lang_id.ngrams([t])[0].tolist())
    logs = {}
    for name, own in counts.items():
        total = sum(own.values()) + size * lang_id.SMOOTHING
        logs[name] = np.log(rows_[name] / len(labelled)) + sum(
            np.log((own[g] + lang_id.SMOOTHING) / total) for g in lang_id.ngrams([text])[0].tolist()
        )
    top = max(logs.values())
    return min(n for n in logs if logs[n] == top), 1 / sum(np.exp(v - top) for v in logs.values())


def test_language_equals_brute_force(spark):
    """Ties (fr and xx learn the same), repeated rows, NULL and empty texts."""
    labelled = [("the cat sat", "en"), ("the dog", "en"), ("le chat", "fr"), ("le chat", "xx"), ("Der Hund!", "de"),
                ("der", "de"), (None, "de"), ("", "en")]
    df = spark.createDataFrame(labelled, "text string, lang string")
    model = lang_id.train(df, "text", "lang")
    asked = ["the", "le chat", "le chat", "Hund der", "x", "the le der"]
    names, scores = model.predict(asked)
    want = [brute_language(labelled, t) for t in asked]
    assert names == [n for n, _ in want]
    assert scores == pytest.approx([s for _, s in want], abs=1e-4)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20])
def test_long_texts_are_counted_in_pieces(size, monkeypatch):
    def totals(texts):
        found, letters = {}, np.zeros(len(texts), int)
        for part, owner, bucket, n, some in lang_id.counted(texts):
            letters[part] += some
            for i, b, c in zip(owner, bucket, n):
                found[part.start + i, b] = found.get((part.start + i, b), 0) + c
        return found, letters.tolist()

    rng = random.Random(3)
    texts = ["".join(rng.choices("abcÉ ,.dß1İ", k=rng.randrange(40))) for _ in range(200)] + [None, ""]
    whole = totals(texts)
    monkeypatch.setattr(lang_id, "STEP_CHARS", size)
    assert totals(texts) == whole


def test_language_memory_does_not_follow_text_times_languages():
    import tracemalloc

    prob = np.random.default_rng(1).random((1 << lang_id.BUCKET_BITS, 64)).astype(np.float32)
    model = lang_id.LanguageModel(tuple(f"l{i:02}" for i in range(64)), np.zeros(64), prob)
    text = "".join(random.Random(2).choices("abcdefgh ijkl", k=1_000_000))
    model.predict(["warm"])
    tracemalloc.start()
    model.predict([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 * 1024 * 1024


# Quality ----------------------------------------------------------------------------------------


def brute_log_probs(texts, query):
    """The same model, written down from its definition."""
    from collections import Counter

    order, top = quality_lm.ORDER, Counter()
    for t in texts:
        s = (chr(255) * (order - 1)) + t
        top.update(s[i : i + order] for i in range(len(t)))
    tables = {order: top}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    cuts = {
        n: quality_lm._discounts(*(sum(c == k for c in t.values()) for k in (1, 2, 3, 4)))
        for n, t in tables.items()
    }

    def p(n, g):
        if n == 0:
            return 1 / quality_lm.SYMBOLS
        d = lambda c: cuts[n][min(c, 3) - 1]
        same = {x: c for x, c in tables[n].items() if x[:-1] == g[:-1]}
        if not same:
            return p(n - 1, g[1:])
        total, c = sum(same.values()), same.get(g, 0)
        own = (c - d(c)) / total if c else 0.0
        return own + sum(map(d, same.values())) / total * p(n - 1, g[1:])

    s = chr(255) * (order - 1) + query
    return [math.log(p(order, s[i : i + order])) for i in range(len(query))]


def test_perplexity_is_that_of_the_definition(spark):
    trained = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "that hat"]
    model = quality_lm.fit(spark.createDataFrame([(t,) for t in trained], "text string"), "text")
    texts = ["the cat", "zzz!", "the cat", None, "", "hat " * 3000]
    df = spark.createDataFrame(rows(texts), SCHEMA)
    out = quality_lm.perplexity(df, "text", model, "value")
    assert out.columns == [*df.columns, "value"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == 6 and [got[i]["text"] for i in range(6)] == texts
    for i in (0, 1, 2):
        want = math.exp(-np.mean(brute_log_probs(trained, texts[i])))
        assert got[i]["value"] == pytest.approx(want, rel=1e-4)
    assert got[3]["value"] is None and got[4]["value"] is None
    assert quality_lm.perplexity(df.limit(0), "text", model).count() == 0


def test_models_side_by_side_equal_models_of_their_own(spark):
    """A model without a part is that of the other parts; one of no text at all is uniform."""
    rows = [(0, "abab abc"), (0, "zz"), (1, "abab"), (2, "the abc")]
    texts = spark.createDataFrame(rows, "part int, text string").select("text", "part")
    counts = quality_lm._counts(texts.mapInArrow(quality_lm._pack, "packed binary, part int"))
    asked = quality_lm.grams(["abab", "zz q", "the", "\u4e2d"])[0]
    wanted = spark.createDataFrame([(int(g),) for g in sorted(set(asked.tolist()))], "gram long")
    both = quality_lm._model(counts, range(3)).log_probs(wanted)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") < 50
    found = {r[0]: r[1:] for r in both.collect()}
    assert len(found) == wanted.count()
    for k in range(3):
        own = quality_lm._model(counts.filter(f"part <> {k}")).log_probs(wanted)
        for gram, logp in own.collect():
            assert found[gram][k] == pytest.approx(logp, rel=1e-6)
    none = quality_lm._model(counts.filter("part = 0"), range(2)).log_probs(wanted)
    assert all(r.logp0 == pytest.approx(-math.log(quality_lm.SYMBOLS)) for r in none.collect())


def test_filter_without_trusted_documents_keeps_all_but_empty(spark):
    df = spark.createDataFrame(rows(["some text", None, ""]), SCHEMA)
    none = spark.createDataFrame([], "doc_id long")
    chosen = quality_lm.fit_filter(df, none, "doc_id", "text", "lang")
    scored = quality_lm.perplexity(df, "text", chosen.model)
    kept = scored.filter(chosen.keeps(F.col("perplexity"), F.col("lang"))).collect()
    assert [r["doc_id"] for r in kept] == [0]


def test_every_trusted_document_is_counted_and_sets_the_limits(spark, monkeypatch):
    """However many there are, and though the map of marks lets others through."""
    # Not a fitting size for any table: with 64 marks most ids collide.
    monkeypatch.setattr(quality_lm, "MARK_BITS", 15)
    monkeypatch.setattr(quality_lm, "MOST_TRUSTED", 50, raising=False)
    n = 400
    docs = spark.createDataFrame(rows([f"word{i} and some more {i * 7919}" for i in range(n)]), SCHEMA)
    trusted = docs.filter("doc_id % 2 = 0").select("doc_id")
    chosen = quality_lm.fit_filter(docs, trusted, "doc_id", "text", "lang")
    whole = quality_lm.fit(docs.join(trusted, "doc_id", "left_semi"), "text")
    one, two = (m.shares[-1].count() for m in (chosen.model, whole))
    assert one == two
    ids = trusted.select(F.col("doc_id").alias("id"))
    assert quality_lm._trusted_texts(docs, ids, "doc_id", "text").count() == n // 2


def prose(rng, parts, n):
    """Sentences of ``n`` words that are made of the given syllables."""
    found = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n)]
    return ". ".join(" ".join(found[i : i + 8]).capitalize() for i in range(0, n, 8)) + "."


@pytest.fixture(scope="module")
def judged(spark):
    """Clean and repeated documents of a common language, and clean ones of a rare one in other letters."""
    rng = np.random.default_rng(5)
    common, rare = ["the", "an", "er", "ing", "ed", "st", "o", "tion"], [*"одназиремутлкпвыбгшцфхжчщэюяёйъь"]
    kinds = ["en"] * 400 + ["ru"] * 20 + ["junk"] * 20
    size = lambda: int(rng.integers(5, 200))
    texts = [
        " ".join([prose(rng, common, 1)[:-1]] * (100 + size())) if k == "junk"
        else prose(rng, common if k == "en" else rare, size()) for k in kinds
    ]
    docs = spark.createDataFrame(rows(texts, ["en" if k == "junk" else k for k in kinds]), SCHEMA)
    # Every second rare document is trusted; the others are as clean.
    trusted = docs.filter("doc_id < 400 or (doc_id < 420 and doc_id % 2 = 0)").select("doc_id")
    path = scratch_dir(spark, "judged")
    docs.coalesce(2).write.parquet(path)
    out = quality_lm.judge(spark.read.parquet(path), trusted, "doc_id", "text", "lang")
    return [(k, r["kept"]) for k, r in zip(kinds, sorted(out.collect(), key=lambda r: r["doc_id"]))]


def test_repeated_words_go_and_clean_text_stays(judged):
    kept = lambda kind: [k for name, k in judged if name == kind]
    assert sum(kept("junk")) <= 1 and sum(kept("en")) >= 390


def test_no_two_characters_fall_together():
    every = "".join(map(chr, [*range(0x3040, 0x9FFF), *range(0x1F300, 0x1F600)]))
    codes, begins = quality_lm.grams(list(every))
    ends = codes[begins[1:] - 1]
    assert len(np.unique(ends)) == len(every)


def test_a_rare_language_has_limits_of_its_own(judged):
    kept = [k for name, k in judged if name == "ru"]
    assert sum(kept) >= 19


def test_limits_change_little_by_little(spark):
    """No number of documents from which on a language is judged otherwise."""
    rng = np.random.default_rng(3)
    own = [(float(h), 400, lang) for lang, at in (("en", 1.6), ("ru", 2.6)) for h in rng.normal(at, 0.05, 300)]
    tops = []
    for n in (1, 2, 20, 49, 50, 51, 200, 201):
        part = own[:300] + own[300 : 300 + n]
        found = quality_lm._limits(spark.createDataFrame(part, "h double, size int, lang string"))
        assert abs(found["ru"].centre - 2.6) < 0.15
        tops.append(found["ru"].high)
    assert abs(tops[3] - tops[4]) < 0.1 and abs(tops[4] - tops[5]) < 0.1 and abs(tops[6] - tops[7]) < 0.1


# Licence scan -------------------------------------------------------------------------------------


def test_licence_cases(spark):
    mit, gpl = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["GPL-3.0"]
    bsd = license_scan.TEMPLATES["BSD-3-Clause"]
    filler = " ".join(f"word{i}" for i in range(300))
    texts = [
        f"{filler} {mit} {filler}", f"{filler}\n{gpl.upper()}", bsd, f"{filler} licensed released {filler}",
        None, "", "released under", f"{mit} {filler} {gpl}",
        filler + " " + bsd.replace("binary", "object") + " " + filler,  # 5 of 16 shingles differ
        filler + " " + bsd.replace("met", "kept"),
    ]
    df = spark.createDataFrame(rows(texts), SCHEMA)
    out = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan(df, "doc_id", "text").collect()}
    assert set(out) == {
        (0, "MIT"), (1, "GPL-3.0"), (2, "BSD-3-Clause"), (7, "MIT"), (7, "GPL-3.0"), (9, "BSD-3-Clause"),
    }
    assert out[(0, "MIT")] == 1.0 and out[(9, "BSD-3-Clause")] < 1
    assert license_scan.scan(df.limit(0), "doc_id", "text").count() == 0
    assert license_scan.scan(df, "doc_id", "text", {}).count() == 0


def test_licence_scan_is_whole(spark, sf_dir):
    """Against the exact containment of every template in every document."""
    import re

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {(r["doc_id"], r["license"]) for r in license_scan.scan(docs, "doc_id", "text").collect()}

    def parts(text):
        own = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}

    want = set()
    for r in docs.collect():
        own = parts(r["text"])
        for name, t in license_scan.TEMPLATES.items():
            if len(parts(t) & own) / len(parts(t)) >= 0.8:
                want.add((r["doc_id"], name))
    assert found == want and want


def test_common_licences_are_told_apart(spark):
    """Usual notices are found, under the name of their licence alone."""
    cases = {
        "MIT": ["Licensed under the MIT License", "Permission is hereby granted, free of charge, to any person "
                "obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in "
                "the Software without restriction, including without limitation the rights to use"],
        "GPL-3.0": ["This program is licensed under the GNU General Public License v3"],
        "GPL-2.0": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                    "published by the Free Software Foundation; either version 2 of the License, or (at your option)"],
        "LGPL-2.1": ["under the terms of the GNU Lesser General Public License as published by the Free Software "
                     "Foundation; either version 2.1 of the License, or (at your option) any later version."],
        "AGPL-3.0": ["released under the GNU Affero General Public License version 3"],
        "BSD-2-Clause": ["Distributed under the BSD 2-Clause License."],
        "ISC": ["licensed under the ISC License"], "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0 license"],
        "CC0-1.0": ["The author has waived all copyright and related or neighboring rights to this work"],
        "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to "
                      "copy, modify, publish, use, compile, sell, or distribute this software"],
    }
    flat = [(name, t) for name, own in cases.items() for t in own]
    df = spark.createDataFrame(rows([f"some words before it. {t} and words after" for _, t in flat]), SCHEMA)
    found = {(r["doc_id"], r["license"]) for r in license_scan.scan(df, "doc_id", "text").collect()}
    assert found == {(i, name) for i, (name, _) in enumerate(flat)}


def test_no_wording_holds_that_of_another_licence():
    from orelode.llm.notices import ROWS

    def parts(text):
        own = license_scan._split(text)
        return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}

    every = [(name, t, parts(t)) for name, t in (*license_scan.TEMPLATES.items(), *ROWS)]
    wrong = [
        (t, u) for name, t, a in every for other, u, b in every
        if name != other and a and len(a & b) >= license_scan.CONTAINMENT * len(a)
    ]
    assert not wrong, wrong[:12]
