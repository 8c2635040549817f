"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.llm import ann, bpe, embedding_dedup, lang_id, license_scan, minhash_dedup, packing
from orelode.llm import personal_data, quality_lm, spelling, suffix_dedup, token_alignment
from orelode.llm import url_filter

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, "vec_id", "embedding", queries="vec_id % 50 = 0", k=5)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    held_out = F.coalesce(fold == 2, F.lit(False))
    model = lang_id.train(docs.filter(~held_out), "text", "lang")
    predict = lang_id.predictor(spark.sparkContext.broadcast(model))
    found = docs.select("doc_id", held_out.alias("held_out"), predict("text").alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    found = quality_lm.judge(docs, trusted, "doc_id", "text", "lang", keep_text=False)
    return found.select("doc_id", "lang", "perplexity", "kept")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeats(docs, "text", "cleaned")
    removed = F.aggregate(
        "cleaned.spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"]
    )
    return done.select(
        "doc_id", "cleaned.n_bytes", removed.alias("n_removed"),
        F.size("cleaned.spans").cast("long").alias("n_spans"),
        F.sha2("cleaned.kept", 256).alias("kept_sha256"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(
        docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json")
    ).drop("ids")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = minhash_dedup.near_duplicates(docs, "doc_id", "text")
    return found.select(
        F.col("id").alias("doc_id"), "class_id", (F.col("id") == F.col("class_id")).alias("kept")
    )


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    rules = (*url_filter.RULES, *url_filter.PATTERNS)
    return url_filter.judge(pages, "url", rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encode = bpe.encoder(path, public_tokenizers.PATTERN)
    decode = bpe.decoder(path, public_tokenizers.PATTERN)
    ids = _table(spark, sf_dir, "documents").select("doc_id", encode("text").alias("ids"))
    both = ids.select("doc_id", "ids", decode("ids").alias("decoded"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    found = embedding_dedup.near_vectors(vectors, "vec_id", "embedding")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return found.withColumn("kept", kept)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.align(_table(spark, sf_dir, "documents"), *paths, "doc_id", "text")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", personal_data.finder()("text").alias("found"))
    base = F.filter("found", lambda s: s["kind"].isin(*personal_data.BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ","
    )
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in personal_data.BASE),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_nearest_neighbours, op2_license_scan, op3_language_id, op4_quality,
        op5_suffix_dedup, op6_packing, op7_near_duplicates, op8_url_rules,
        op9_byte_bpe, op10_near_vectors, op11_token_alignment,
        op12_spelling_variants, op13_personal_data,
    )
}

OP8_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
fits AS (
  SELECT *,
    CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/')
        THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/')
        THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
  CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path,
      '(^|[./_-])(adult|casino|pills|porn|spam|warez|xxx)([./_-]|$)') THEN 'block'
    ELSE 'allow'
  END AS verdict
FROM fits
"""

ORACLES: dict[str, str] = {"op8_url_rules": OP8_SQL}
