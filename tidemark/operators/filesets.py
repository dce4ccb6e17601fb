"""Relational bookkeeping of files: what is pending, released, landed or ingested.

A listing is a DataFrame with at least ``name``; other columns travel along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPRESSED_SUFFIXES = (".csv.zst", ".zip")
_COMPRESSED_ENDING = r"\.(csv\.zst|zip)$"


def has_suffix(name: Column, suffixes: tuple[str, ...] = COMPRESSED_SUFFIXES) -> Column:
    return reduce(lambda a, b: a | b, [name.endswith(s) for s in suffixes])


def csv_name(name: Column) -> Column:
    """Name of the decompressed file."""
    return F.regexp_replace(name, _COMPRESSED_ENDING, ".csv")


def file_of_url(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def _missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.join(present.select(F.col("name").alias(key)), key, "left_anti").select(*wanted.columns)


def pending_files(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Compressed source files whose name is not in the landing listing."""
    return _missing(source.filter(has_suffix(F.col("name"))), landed, "name")


def release_next(source: DataFrame, landed: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pending files by name; zero releases none."""
    return pending_files(source, landed).orderBy("name").limit(n)


def pending_decompress(source: DataFrame, landed: DataFrame, limit: int | None = None) -> DataFrame:
    """Compressed files whose decompressed counterpart has not landed; no or zero limit means all."""
    wanted = source.filter(has_suffix(F.col("name"))).withColumn("csv_name", csv_name(F.col("name")))
    pending = _missing(wanted, landed.filter(F.col("name").endswith(".csv")), "csv_name")
    return pending.orderBy("name").limit(limit) if limit and limit > 0 else pending


def pending_urls(urls: DataFrame, present: DataFrame, limit: int | None = None) -> DataFrame:
    """Links whose file name is not present; no or zero limit means all."""
    pending = _missing(urls.withColumn("name", file_of_url(F.col("url"))), present, "name")
    return pending.orderBy("url").limit(limit) if limit and limit > 0 else pending


def landing_full(source: DataFrame, landed: DataFrame) -> DataFrame:
    """One row: is there any source file, and has every one of them landed?"""
    wanted = source.filter(has_suffix(F.col("name"))).select("name")
    marked = wanted.join(
        landed.select("name").distinct().withColumn("_landed", F.lit(1)), "name", "left"
    )
    counted = marked.agg(
        F.count(F.lit(1)).alias("source_files"), F.count_if(F.col("_landed").isNull()).alias("missing_files")
    )
    return counted.withColumn(
        "landing_full", (F.col("source_files") > 0) & (F.col("missing_files") == 0)
    )


def ingest_ledger(parsed: DataFrame) -> DataFrame:
    """What has been read: rows and unreadable rows per (file, member). Pending work is judged by this."""
    return parsed.groupBy("path", "member").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.col("corrupt_record")).alias("corrupt_rows")
    )
