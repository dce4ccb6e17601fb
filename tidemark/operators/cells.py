"""Cell x hour aggregates and what is derived from them for a map.

Distinct vessels are counted with Spark's two-step distinct aggregation: the first shuffle is keyed by
(cell, hour, vessel) after a partial aggregation, so neither a crowded cell nor a chatty vessel ends up in
one task.

Pings without a usable position form the NULL cell. Where only real cells make sense (map, centre), give
valid pings: that test is a cheap filter on the coordinates, while a filter on the cell would make the
optimizer compute every cell a second time inside the filter.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import hexgrid, style
from tidemark.functions.geo import is_valid_lonlat
from tidemark.session import stored


def valid_pings(pings: DataFrame) -> DataFrame:
    return pings.filter(is_valid_lonlat(F.col("longitude"), F.col("latitude")))


def cell_hour(pings: DataFrame, resolution: int, ts: str = "ts", vessel: str = "mmsi") -> DataFrame:
    """Unique vessels and records per (cell, hour of day). Pings without a cell form the NULL group."""
    cell = f"hex_res{resolution}"
    celled = hexgrid.add_cells(pings.select(vessel, ts, "longitude", "latitude"), (resolution,))
    return celled.groupBy(cell, F.hour(ts).alias("hour_of_day")).agg(
        F.countDistinct(vessel).alias("unique_vessels"), F.count(F.lit(1)).alias("total_records")
    )


def cell_hour_all(
    pings: DataFrame, resolutions: tuple[int, ...] = hexgrid.MAP_RESOLUTIONS, ts: str = "ts", vessel: str = "mmsi"
) -> DataFrame:
    """All resolutions in one pass: ``resolution, cell, hour_of_day, unique_vessels, total_records``."""
    celled = hexgrid.add_cells(pings.select(vessel, ts, "longitude", "latitude"), resolutions)
    each = F.array(
        *[
            F.struct(F.lit(res).alias("resolution"), F.col(f"hex_res{res}").alias("cell"))
            for res in resolutions
        ]
    )
    unfolded = celled.select(vessel, F.hour(ts).alias("hour_of_day"), F.inline(each))
    return unfolded.groupBy("resolution", "cell", "hour_of_day").agg(
        F.countDistinct(vessel).alias("unique_vessels"), F.count(F.lit(1)).alias("total_records")
    )


def cell_daily_sum(hourly: DataFrame, cell: str) -> DataFrame:
    """Hourly rows folded per cell. Vessels seen in several hours count once per hour."""
    return hourly.groupBy(cell).agg(
        F.sum("unique_vessels").alias("total_unique_vessels"), F.sum("total_records").alias("total_records")
    )


def cell_daily_unique(pings: DataFrame, resolution: int, vessel: str = "mmsi") -> DataFrame:
    """Vessels counted once per cell, whatever the hour."""
    cell = f"hex_res{resolution}"
    celled = hexgrid.add_cells(pings.select(vessel, "longitude", "latitude"), (resolution,))
    return celled.groupBy(cell).agg(
        F.countDistinct(vessel).alias("daily_unique"), F.count(F.lit(1)).alias("total_records")
    )


def cell_stats(hourly: DataFrame, cell: str) -> DataFrame:
    """Rows, distinct cells and distinct hours of an hourly table, folding hours into a bit set per cell."""
    per_cell = hourly.groupBy(cell).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("hour_of_day"))).alias("_hours"),
    )
    return per_cell.agg(
        F.sum("_rows").alias("hourly_rows"),
        F.count(cell).alias("distinct_cells"),
        F.bit_count(F.bit_or("_hours")).cast("bigint").alias("distinct_hours"),
    )


def distinct_cells(hourly: DataFrame, cell: str) -> DataFrame:
    return hourly.select(cell).distinct()


def cell_centroids(cells: DataFrame, cell: str) -> DataFrame:
    """Append ``cell_lon, cell_lat``."""
    lon, lat = hexgrid.cell_centroid(F.col(cell))
    return cells.withColumns({"cell_lon": lon, "cell_lat": lat})


def cells_center(hourly: DataFrame, cell: str) -> DataFrame:
    """Mean of the centroids of the distinct cells."""
    middles = cell_centroids(distinct_cells(hourly, cell), cell)
    return middles.agg(F.avg("cell_lat").alias("center_lat"), F.avg("cell_lon").alias("center_lon"))


QUARTILES = (0.25, 0.5, 0.75)


def describe_values(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, min, quartiles and max of an integer column. NULLs do not count.

    The histogram of values is cut into ranges of values and stored. Ranges are summed by themselves; quartiles, which
    interpolate linearly, are looked up only in the ranges that hold their ranks, so no task sees the whole histogram.
    """
    value, weight = F.col("_value"), F.col("_n")
    histogram = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    histogram = histogram.repartitionByRange("_value").withColumn("_range", F.spark_partition_id())
    histogram = stored(histogram, "histogram")
    mass = F.sum(value.cast("decimal(20,0)") * weight)
    ranges = histogram.groupBy("_range").agg(F.sum(weight).alias("n"), mass.alias("mass"), F.min(value).alias("low"), F.max(value).alias("high"))
    ranges = ranges.orderBy("low").collect()  # a row for each partition
    spark, count = df.sparkSession, sum(r["n"] for r in ranges)
    fields = "count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    if not count:
        return spark.createDataFrame([(0, *[None] * 7)], fields)
    mean = float(Fraction(int(sum(r["mass"] for r in ranges)), count))
    ranks = sorted({k for q in QUARTILES for k in (_rank(count, q)[0], min(_rank(count, q)[0] + 1, count - 1))})
    holding, before = {}, 0
    for r in ranges:
        if any(before <= k < before + r["n"] for k in ranks):
            holding[r["_range"]] = before
        before += r["n"]
    offset = F.create_map(*[F.lit(x) for pair in holding.items() for x in pair])[F.col("_range")]
    inside = Window.partitionBy("_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = histogram.where(F.col("_range").isin(*holding)).withColumn("_upto", F.sum("_n").over(inside) + offset)
    found = placed.agg(*[F.min(F.when(F.col("_upto") > k, value)).alias(f"r{k}") for k in ranks]).first()
    off = value.cast("double") - F.lit(mean)
    spread = histogram.agg(F.sum(off * off * weight)).first()[0]

    def quartile(q: float) -> float:
        low, part = _rank(count, q)
        a, b = found[f"r{low}"], found[f"r{min(low + 1, count - 1)}"]
        return float(a + (b - a) * part)

    std = math.sqrt(max(spread, 0.0) / (count - 1)) if count > 1 else None
    low, high = float(ranges[0]["low"]), float(max(r["high"] for r in ranges))
    return spark.createDataFrame([(count, mean, std, low, *map(quartile, QUARTILES), high)], fields)


def _rank(count: int, q: float) -> tuple[int, Fraction]:
    """The rank below a quantile, from 0, and how far the quantile lies beyond it."""
    at = Fraction(q) * (count - 1)
    return int(at), at - int(at)


def cell_colors(daily: DataFrame, cell: str) -> DataFrame:
    """Colour and place of each cell, plus the totals over all cells.

    The colour is the position between the quietest and the busiest cell on a log scale.
    The bounds are a one-row scalar subquery over the same aggregate, whose shuffle Spark reuses.
    """
    bounds = daily.agg(
        F.struct(
            F.min("total_unique_vessels").alias("low"),
            F.max("total_unique_vessels").alias("high"),
            F.sum("total_unique_vessels").alias("vessels"),
            F.sum("total_records").alias("records"),
        ).alias("bounds")
    )
    scaled = style.min_max_scaled(
        F.log1p("total_unique_vessels"), F.log1p(F.col("bounds.low")), F.log1p(F.col("bounds.high"))
    )
    lon, lat = hexgrid.cell_centroid(F.col(cell))
    return (
        daily.withColumn("bounds", bounds.scalar())
        .withColumn("normalized_vessels", scaled)
        .withColumns(
            {
                "cell_hex": hexgrid.cell_hex(F.col(cell)),
                "cell_lon": lon,
                "cell_lat": lat,
                "rgba": style.fire_rgba(F.col("normalized_vessels")),
                "all_vessels": F.col("bounds.vessels"),
                "all_records": F.col("bounds.records"),
            }
        )
        .drop("bounds")
    )
