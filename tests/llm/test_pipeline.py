"""The pipeline against plain versions of its stages, each over what the stage before really gave."""

from __future__ import annotations

import hashlib
import itertools
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_duplicates import Groups, brute_kept, text_sets  # noqa: E402
from test_text_operators import check_packing  # noqa: E402

from orelode.llm import lang_id, minhash_dedup  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Some of the given documents with odd rows beside them, and their labels."""
    root = tmp_path_factory.mktemp("pipeline")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [
        (100_001, None, "en", "x", 0), (100_002, "", None, None, 0), (100_003, "12 34 …", "fr", "x", 7),
        (None, "The words of the one that has no number are here and that is fine.", "en", "x", 1),
        (100_004, "Wörter " * 4_000, None, "x", 28_000),
    ]
    docs = given.unionByName(spark.createDataFrame(odd, given.schema)).withColumn("perplexity", F.lit("x"))
    docs = docs.withColumns({"key": F.lit(1), "number": F.lit(2), "cleaned": F.lit(3)})
    docs.coalesce(2).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return str(root)


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage has written, by its place."""
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], folder).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(kept):
    assert all(df.columns == kept[0].columns for df in kept[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == list(STAGES) and len(STAGES) == 5


def test_language(spark, kept):
    model = lang_id.train(kept[0], "text", "lang")
    before = texts(kept[0])
    names, scores = model.predict(list(before.values()))
    assert texts(kept[1]) == {
        k: t for (k, t), n, s in zip(before.items(), names, scores) if n != "und" and s >= 0.5
    }


def test_quality_keeps_the_trusted_and_drops_signs(spark, folder, kept):
    before, after = texts(kept[1]), texts(kept[2])
    assert after.items() <= before.items()
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = [k for k in before if k in labels and labels[k]["quality"] and not labels[k]["toxic"]]
    assert len(good) > 20 and sum(k in after for k in good) >= 0.98 * len(good)
    noisy = [k for k, t in before.items() if t.count("***") + t.count("###") > 20]
    assert noisy and not any(k in after for k in noisy)


def test_one_of_each_group_stays(kept):
    before = texts(kept[2])
    ids = [k for k in before if k is not None]
    sets, groups = text_sets([before[k] for k in ids]), Groups()
    for i, j in itertools.combinations(range(len(ids)), 2):
        if minhash_dedup.similarity(sets[i], sets[j]) >= 0.8:
            groups.link(ids[i], ids[j])
    assert texts(kept[3]) == {k: t for k, t in before.items() if k is None or groups.find(k) == k}


def test_passages_go(kept):
    before, after = texts(kept[3]), texts(kept[4])
    assert before.keys() == after.keys()
    for (k, _), (_, _, spans, digest) in zip(before.items(), brute_kept(list(before.values()))):
        if spans == 0:
            assert after[k] == before[k]
        elif after[k].isascii() and before[k].isascii():
            assert hashlib.sha256(after[k].encode()).hexdigest() == digest
    assert all(r["n_chars"] == len(r["text"]) for r in kept[4].collect())


def test_sequences(kept):
    before = list(texts(kept[4]).items())
    place = {k: i for i, (k, _) in enumerate(before)}
    rows = [r.asDict() | {"doc_id": place[r["doc_id"]]} for r in kept[5].collect()]
    check_packing(rows, [t for _, t in before], 4096)


def test_run_is_the_stages_one_after_the_other(spark, folder, kept):
    facts = ("doc_id", "start", "length", "ids_crc32")
    one, two = (df.select(*facts) for df in (corpus_pipeline.run(spark, folder), kept[5]))
    assert one.select("doc_id").distinct().count() == two.select("doc_id").distinct().count()
    total = lambda df: df.agg(F.sum("length")).first()[0]
    assert total(one) == total(two)
