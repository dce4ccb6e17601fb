"""The end-to-end flows: enrich, map cells, port voyages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.operators import cells, ports, spatial, voyages
from tidemark.sources.features import wkb_rings


def map_cells(pings: DataFrame, resolution: int) -> DataFrame:
    """Pings to coloured cells: hourly counts, folded per cell, coloured."""
    cell = f"hex_res{resolution}"
    daily = cells.cell_daily_sum(cells.cell_hour(cells.valid_pings(pings), resolution), cell)
    return cells.cell_colors(daily, cell)


def in_port_pings(
    pings: DataFrame, all_ports: DataFrame, radius_m: float = geo.NAUTICAL_MILE_M, zone: int | None = 10
) -> DataFrame:
    """Pings within the radius of a port that is not very small; ``zone`` None: each pair in its port's zone."""
    return spatial.pings_in_ports(pings, ports.without_size(all_ports), radius_m, zone)


def stays(
    pings: DataFrame, all_ports: DataFrame, radius_m: float = geo.NAUTICAL_MILE_M, zone: int | None = 10, **options
) -> DataFrame:
    """Port stays; ``options`` go to the session rule."""
    return _stay_blocks(pings, all_ports, radius_m, zone, **options).drop("_block")


def _stay_blocks(pings: DataFrame, all_ports: DataFrame, radius_m: float, zone: int | None, **options) -> DataFrame:
    columns = pings.select("mmsi", "vessel_name", "ts", "longitude", "latitude")
    if "crowded" not in options:
        options["crowded"] = voyages.crowded_slices(pings.select("mmsi", "ts"), options.get("slice_seconds", voyages.SLICE_SECONDS))
        options.setdefault("collapse", options["crowded"] is not None)
    return voyages.stay_blocks(in_port_pings(columns, all_ports, radius_m, zone), **options)


def journeys(
    pings: DataFrame, all_ports: DataFrame, radius_m: float = geo.NAUTICAL_MILE_M, zone: int | None = 10, **options
) -> DataFrame:
    """Journeys between differently named ports."""
    return voyages.journeys(_stay_blocks(pings, all_ports, radius_m, zone, **options), "_block").drop("_block")


def od_matrix(
    pings: DataFrame, all_ports: DataFrame, radius_m: float = geo.NAUTICAL_MILE_M, zone: int | None = 10, **options
) -> DataFrame:
    """Journeys between ports, busiest first."""
    return voyages.od_matrix(journeys(pings, all_ports, radius_m, zone, **options))


def ports_from_features(features: DataFrame, zone: int) -> DataFrame:
    """Feature rows with decoded points to a port table: all properties, the projected and the WGS84 position.

    ``port_id, port_name, size, plon, plat`` are what the joins need; ``easting, northing`` and the eleven properties
    follow under their own names.
    """
    expanded = ports.expand_properties(features, ports.PORT_PROPERTIES_SAMPLE)
    named = ports.reproject_features(expanded, zone)
    properties = [c for c in expanded.columns if c not in ("geometry", "crs", "easting", "northing")]
    return named.select(
        F.col("OID").cast("double").cast("bigint").alias("port_id"),
        F.col("PORT").alias("port_name"),
        F.col("SIZE").alias("port_size"),
        "plon",
        "plat",
        "easting",
        "northing",
        *[c for c in properties if c.lower() != "size"],
    ).withColumnRenamed("port_size", "size")


def zones_from_features(feature_rows: DataFrame, zone_id: str, zone: int | None = None) -> DataFrame:
    """``zone_id, rings`` in EPSG:4326 of the polygons and multi-polygons among features; other geometries are left out.

    ``zone_id`` is the property that names a zone. Features are in EPSG:4326, or projected in UTM ``zone``; another crs is
    an error rather than a wrong place.
    """
    expected = 4326 if zone is None else geo.epsg_of_zone(zone)
    message = F.format_string(f"expected EPSG:{expected}, got EPSG:%s", F.col("crs").cast("string"))
    checked = F.when(F.col("crs") == expected, F.col("geometry")).otherwise(F.raise_error(message).cast("binary"))
    decoded = feature_rows.select(F.get_json_object("properties", f"$.{zone_id}").alias("zone_id"), wkb_rings(checked).alias("rings"))
    decoded = decoded.where(F.col("rings").isNotNull())
    return decoded if zone is None else decoded.withColumn("rings", geo.lonlat_rings("rings", zone))
