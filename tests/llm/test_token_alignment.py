"""Two tokenizers aligned, against a plain version."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, pre_tokenizers

from orelode.llm import queries, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "  two  blanks ", "\n\n\t x", "<|endoftext|> and </s><s> <0x41>", "▁ sign", "한국어 ß é ☃ 🙂🙂",
       "don't I'll 12 345 6789", "ﬁ ½ … 。", "same text here", "same text here", "\x00 \x01", "á é", "tab\tend "]


@pytest.fixture(scope="module")
def vocabularies():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_signs():
    """The byte of each sign, from the library's own spelling of characters."""
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    out = {}
    for c in range(0x800):
        data = chr(c).encode()
        out |= dict(zip(spell(chr(c))[0][0], data))
    for c in (0xFFFF, 0x10FFFF, *range(0x800, 0xD800, 0x100), *range(0x10000, 0x110000, 0x10000)):
        out |= dict(zip(spell(chr(c))[0][0], chr(c).encode()))
    return out


def plain_tokens(vocabularies, text):
    if not text:
        return [], []
    a, b = vocabularies
    back = byte_signs()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    of_a = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in ids_a]
    of_b = [
        (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
        for i in b.encode(text)
    ]
    data = (" " + text).encode()
    whole = all(b"".join(x[1] for x in side) == data for side in (of_a, of_b))
    return (of_a, of_b) if whole else ([], [])


def ranges(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def plain(vocabularies, texts):
    rows, count, links = [], Counter(), []
    for text in texts:
        a, b = map(ranges, plain_tokens(vocabularies, text))
        own, k = [], 0
        for i, begin, end in a:
            while k < len(b) and b[k][2] <= begin:
                k += 1
            j = k
            while j < len(b) and b[j][1] < end:
                own.append((i, b[j][0]))
                j += 1
        cuts = sorted({x[2] for x in a} & {x[2] for x in b})
        side = lambda tokens, low, high: ",".join(str(i) for i, _, e in tokens if low < e <= high)
        written = ""
        if len(a) < 3000:
            written = ";".join(f"{side(a, x, y)}|{side(b, x, y)}" for x, y in zip([0, *cuts], cuts))
        links.append(own)
        count.update(set(own))
        rows.append((len(a), len(b), len(cuts), len(own), hashlib.sha256(written.encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [
        (*r[:4], sum(count[p] == best[p[0]] for p in own), sum(count[p] for p in own), r[4])
        for r, own in zip(rows, links)
    ]


def values(row):
    return (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["n_best"], row["count_sum"], row["groups_sha256"])


def test_odd_texts(spark, vocabularies):
    df = spark.createDataFrame([(i, t, "x", 2) for i, t in enumerate(ODD)], "doc_id long, text string, pairs string, n_a int")
    out = {r["doc_id"]: values(r) for r in token_alignment.align(df, A, B).collect()}
    want = plain(vocabularies, ODD)
    assert [out[i] for i in range(len(ODD))] == want
    assert out[6][0] > 0 and out[7][0] == 0 and out[8][0] > 0
    assert token_alignment.align(df.limit(0), A, B).count() == 0


def test_rows_without_id_and_repeated(spark, vocabularies):
    df = spark.createDataFrame([(None, "a word"), (1, "a word"), (1, "a word"), (None, None)], "doc_id long, text string")
    out = sorted((r["doc_id"] or 0, values(r)) for r in token_alignment.align(df, A, B).collect())
    want = plain(vocabularies, ["a word", None, "a word", "a word"])
    assert out == sorted(zip([0, 0, 1, 1], want))


def test_words_change_nothing(vocabularies, monkeypatch):
    """Aligning word by word, remembered or not, gives what aligning whole texts gives."""
    text = "Some words of a text, don't cut 'em; naïve café 12 a b  c\n\nd e \x1c f\x85 g\u3000 h .. . , ' s" * 40
    own = token_alignment.Aligner(A, B)
    want = own.align([text, "x", None, text])
    monkeypatch.setattr(token_alignment, "KNOWN_WORDS", 3)
    again = own.align([text, "x", None, text])
    own.forget()
    monkeypatch.setattr(token_alignment, "WORDS", re.compile("(?!)"))
    for got in (again, own.align([text, "x", None, text])):
        assert (want[0] == got[0]).all() and (want[1] == got[1]).all() and want[2] == got[2]


def test_no_piece_runs_from_a_letter_into_a_blank():
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    assert not [p for p in pieces if "▁" in p.lstrip("▁")]


def test_blocks_and_radixes_change_nothing(spark, vocabularies, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_ROWS", 3)
    monkeypatch.setattr(token_alignment, "STEP_CHARS", 20)
    monkeypatch.setattr(token_alignment, "KNOWN_CHARS", 50)
    monkeypatch.setattr(token_alignment, "RADIX_RECORDS", 10)
    df = spark.createDataFrame(list(enumerate(ODD * 3)), "doc_id long, text string").repartition(5)
    out = {r["doc_id"]: values(r) for r in token_alignment.align(df, A, B).collect()}
    assert [out[i] for i in range(len(out))] == plain(vocabularies, ODD * 3)


def test_long_text(spark):
    text = "word after word " * 60_000 + "x" * 20_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = token_alignment.align(df, A, B).first()
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"] and row["n_a"] > 180_000
    assert row["n_best"] > 0 and row["count_sum"] == row["n_links"]


def test_query_equals_plain(spark, sf_dir, vocabularies):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: values(r) for r in queries.op11_token_alignment(spark, sf_dir).collect()}
    want = plain(vocabularies, [r["text"] for r in docs])
    assert len(out) == len(docs)
    for r, w in zip(docs, want):
        got = out[r["doc_id"]]
        assert got[:6] == w[:6]
        assert w[0] >= 3000 or got[6] == w[6]
    assert np.mean([out[r["doc_id"]][0] > 0 for r in docs]) > 0.9
