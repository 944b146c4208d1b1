"""The operators applied to the given tables, and SQL for what SQL can say."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import benchmark_scan, bpe, exact_dedup, html_main, langid, license_scan, minhash, packing, simhash, suffix_dedup, token_align, url_filter, vector_codes
from .shipping import ship

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_lookups(simhash.compare_neighbours(_documents(spark, sf_dir)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    return packing.pack_documents(_documents(spark, sf_dir), tokenizer)


def op3_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_pages(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(_documents(spark, sf_dir))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_documents(spark, sf_dir), similar=license_scan.similar_spans)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_pages(spark, sf_dir), URL_RULES)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remaining(_documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vector_codes.encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("label")


def op12_benchmark_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_scan.scan(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    b = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return token_align.align(_documents(spark, sf_dir), a, b)


REGISTRY = {f.__name__: f for f in (op1_simhash, op2_packing, op3_html_main, op4_exact_dedup, op5_license_scan, op6_langid, op7_minhash, op8_url_filter, op9_bpe, op10_suffix_dedup, op11_vector_codes, op12_benchmark_scan, op13_token_align)}

SQL = {
    "op4_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g""",
    "op5_license_scan": license_scan.oracle_sql(),
    "op8_url_filter": r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM p, r WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)""",
    "op11_vector_codes": vector_codes.oracle_sql(),
    "op12_benchmark_scan": benchmark_scan.oracle_sql(),
}
