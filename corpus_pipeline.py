"""From raw documents to packed token sequences: language, quality, near copies, passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.llm import lang_id, minhash_dedup, packing, quality_lm, suffix_dedup
from orelode.llm.common import free_name
from orelode.sources.paths import materialise

#: A language is believed from this posterior probability on.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled ones; those without letters go.

    A document without a language gets the one predicted. Repeated rows all stay or all go; a table
    without labelled rows keeps nothing.
    """
    model = lang_id.train(docs, "text", "lang")
    found = free_name(docs, "_found")
    predict = lang_id.predictor(spark.sparkContext.broadcast(model))
    marked = docs.withColumn(found, predict(F.col("text").cast("string")))
    kept = (F.col(f"{found}.lang_pred") != lang_id.UNKNOWN) & (F.col(f"{found}.score") >= LEAST_SCORE)
    lang = F.coalesce(F.col("lang").cast("string"), F.col(f"{found}.lang_pred"))
    return marked.filter(kept).withColumn("lang", lang).select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limit of their language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trusted = labels.filter("quality = 1 and toxic = 0").select("doc_id")
    column, kept = free_name(docs, "_perplexity"), free_name(docs, "_kept")
    found = quality_lm.judge(docs, trusted, "doc_id", "text", "lang", column, kept)
    return found.filter(F.col(kept)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_dedup.drop_near_duplicates(docs, "doc_id", "text")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that stand elsewhere too; every document stays."""
    found = free_name(docs, "_cleaned")
    done = suffix_dedup.remove_repeats(docs, "text", found)
    done = done.withColumn("text", suffix_dedup.characters()(F.col(f"{found}.kept")))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done.select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", passages),
    ("packing", sequences),
]

#: SQL cannot express the models, the suffix arrays or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = materialise(docs, name.replace(" ", "-"))
    return docs
