"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import arrow_files, collocations, divergence, hashing_search, licenses, mixing, near_dedup, packing, quality, site_style, substrings, toxicity, warc
from tidemark.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline at the top of the repository, which stands or falls with this subpackage."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_multi_index_hashing(spark, sf_dir):
    return hashing_search.nearest(table(spark, sf_dir, "embeddings"))


@query
def op3_packing(spark, sf_dir):
    docs, tokenizer = table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(docs, tokenizer, special=True, quantum=packing.TURN)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op4_quality_rules(spark, sf_dir):
    judged = quality.assess(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op4_quality_rules"] = quality.ORACLE_SQL


@query
def op5_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).drop("block")


@query
def op6_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_warc(spark, sf_dir):
    return warc.digests(warc.read_pages(warc.write_pages(table(spark, sf_dir, "pages"))))


ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d FROM p),
f AS (SELECT d, min(page_id) AS first FROM k WHERE n >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, n::BIGINT AS payload_bytes, k.d AS payload_digest,
       CASE WHEN f.first IS NULL OR page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f.first THEN f.first END AS refers_to
FROM k LEFT JOIN f ON k.d = f.d
"""


@query
def op8_arrow_files(spark, sf_dir):
    manifest = arrow_files.write_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), special=True)
    return arrow_files.read_documents(manifest)


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op10_html_extraction(spark, sf_dir):
    return site_style.extract(table(spark, sf_dir, "pages"))


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = collocations.ORACLE_SQL


@query
def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = divergence.ORACLE_SQL


@query
def op13_substring_dedup(spark, sf_dir):
    cleaned = substrings.repeated_removed(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op13_substring_dedup"] = substrings.ORACLE_SQL
