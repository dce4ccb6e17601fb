"""The columns a stream of drifting files has shown so far, in a log beside its checkpoint.

Each batch that brings new columns adds one folder with a row for each: name, type and the batch. A type is chosen once,
from the values of the first batch that has the column, and kept; later values that do not fit become NULL in the column.
A batch that is repeated reads the log as it was before it and replaces its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.ledger import read_if_any

LOG_SCHEMA = "name string, type string, batch bigint, place int"
#: Types that a column of text is tried for, narrowest first.
CANDIDATES = ("bigint", "double", "timestamp_ntz")


def logged(spark: SparkSession, location: str, before: int | None = None) -> list[T.StructField]:
    """The logged columns in the order they came; with ``before``, those of earlier batches."""
    found = read_if_any(spark, location, LOG_SCHEMA)
    if found is None:
        return []
    rows = found if before is None else found.where(F.col("batch") < before)
    ordered = rows.orderBy("batch", "place").collect()  # a row for each column there ever was
    return [T.StructField(r["name"], T._parse_datatype_string(r["type"])) for r in ordered]


def chosen_types(rows: DataFrame, names: list[str]) -> dict[str, str]:
    """For columns of text the first of ``CANDIDATES`` that every value fits, else string; one pass over the rows."""
    if not names:
        return {}
    failing = [
        F.count_if(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(c).isNull()).alias(f"{i}_{c}")
        for i, n in enumerate(names)
        for c in CANDIDATES
    ]
    known = [F.count(F.col(f"`{n}`")).alias(f"{i}_known") for i, n in enumerate(names)]
    row = rows.agg(*failing, *known).first()
    return {
        n: next((c for c in CANDIDATES if row[f"{i}_known"] and not row[f"{i}_{c}"]), "string") for i, n in enumerate(names)
    }


def add(spark: SparkSession, location: str, batch: int, types: dict[str, str]) -> None:
    rows = [(name, kind, batch, place) for place, (name, kind) in enumerate(types.items())]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{location}/{batch:012d}")
