"""From raw documents to packed training sequences, stage by stage.

Every stage takes the documents that the one before kept, as a table, and returns those that it keeps with the same
columns; the last returns the pieces of the packed sequences. ``run`` writes each stage's rows to the shared folder
and reads them again, so stages never recompute one another and a lost executor costs work of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, near_dedup, packing, quality, toxicity
from tidemark.llm.common import stored
from tidemark.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores below 0.5."""
    ship_package(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_civil(docs, model)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and the cascade of quality rules."""
    return quality.kept_rows(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return near_dedup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, every sequence with the sources' shares."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), special=True, quantum=packing.TURN).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near-duplicates", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Hashed darts, a fitted model and a tokenizer have no SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs.select([F.col(c) for c in docs.columns])
