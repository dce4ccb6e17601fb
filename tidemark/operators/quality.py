"""Profiling of a ping table. Every report is one pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import is_valid_lonlat


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def unique_count(df: DataFrame, column: str, alias: str, relative_error: float | None = None) -> DataFrame:
    """Exact distinct count, or a HyperLogLog++ estimate when an error is allowed."""
    if relative_error is None:
        return df.agg(F.countDistinct(column).alias(alias))
    return df.agg(F.approx_count_distinct(column, relative_error).alias(alias))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column that has NULLs: their number and percentage."""
    names = columns or df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(names)]
    )
    long_rows = F.inline(
        F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count")) for i, c in enumerate(names)]
        )
    )
    percent = F.round(F.lit(100.0) * F.col("null_count") / F.col("_total"), 1)
    return (
        counted.select("_total", long_rows)
        .filter(F.col("null_count") > 0)
        .select("column_name", "null_count", percent.alias("null_percent"))
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of non-NULL values."""
    counted = df.agg(*[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"),
            F.col(f"_n{i}").alias("non_null"),
        )
        for i, (name, dtype) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*rows)))


def time_range(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("min_time"), F.max(ts).alias("max_time"))


def geo_bounds(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
    )


def bounds_center(df: DataFrame) -> DataFrame:
    """Middle of the bounding box."""
    return geo_bounds(df).select(
        ((F.col("min_lat") + F.col("max_lat")) / 2).alias("center_lat"),
        ((F.col("min_lon") + F.col("max_lon")) / 2).alias("center_lon"),
    )


def validity_summary(df: DataFrame) -> DataFrame:
    """Rows per validity: true, false, and NULL for missing coordinates."""
    valid = is_valid_lonlat(F.col("longitude"), F.col("latitude"))
    return df.groupBy(valid.alias("is_valid_geom")).agg(F.count(F.lit(1)).alias("count"))


def quality_report(df: DataFrame, ts: str = "ts", vessel: str = "mmsi") -> DataFrame:
    """All checks as (check, value) rows from a single aggregation; times as epoch seconds."""
    valid = is_valid_lonlat(F.col("longitude"), F.col("latitude"))
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    checks = {
        "total_rows": F.count(F.lit(1)),
        "unique_vessels": F.countDistinct(vessel),
        "min_time": F.min(seconds),
        "max_time": F.max(seconds),
        "min_lat": F.min("latitude"),
        "max_lat": F.max("latitude"),
        "min_lon": F.min("longitude"),
        "max_lon": F.max("longitude"),
        "valid_geom": F.count_if(valid),
        "invalid_geom": F.count_if(~valid),
        "missing_geom": F.count_if(valid.isNull()),
        **{f"nulls_{c}": F.count_if(F.col(c).isNull()) for c in df.columns},
    }
    counted = df.agg(*[agg.alias(name) for name, agg in checks.items()])
    rows = [F.struct(F.lit(n).alias("check"), F.col(n).cast("double").alias("value")) for n in checks]
    return counted.select(F.inline(F.array(*rows)))
