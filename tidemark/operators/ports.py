"""Port reference data: property expansion, filters, buffers and their envelope."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import geo

# One property document, used to derive the expansion schema (fixed value).
PORT_PROPERTIES_SAMPLE = (
    '{"OID":"1.0","WPIN":"1.0","REGION":"r","PORT":"p","UN_LOCODE":"u","COUNTRY":"c",'
    '"WORLD_WATE":"w","SIZE":"Small","TYPE":"t","LAT":49.5,"LON":-124.5}'
)

BUFFER_VERTICES = 32

# Fixed value: length of a degree of latitude at the equator, reduced by the smallest scale of the projection.
SHORTEST_DEGREE_M = 110574.0 * 0.9996


def expand_properties(features: DataFrame, sample: str, column: str = "properties") -> DataFrame:
    """Replace a JSON text column by its top-level fields, typed after one sample document."""
    kept = [c for c in features.columns if c != column]
    parsed = F.from_json(F.col(column), F.schema_of_json(F.lit(sample)))
    return features.withColumn(column, parsed).select(*kept, f"{column}.*")


def without_size(ports: DataFrame, excluded: str = "Very Small", column: str = "size") -> DataFrame:
    """Rows whose size is known and differs from ``excluded`` (a NULL size does not pass)."""
    return ports.filter(~(F.col(column) == F.lit(excluded)))


#: Degrees from a zone's central meridian up to which a plane position is taken for a distance.
ZONE_REACH_DEG = 4.0


def project_ports(ports: DataFrame, zone: int | None, lon: str = "plon", lat: str = "plat") -> DataFrame:
    """Valid ports with their position in the projected plane and its ``port_zone``.

    Without ``zone`` each port is projected in its own. With one, a port too far from it for distances to hold is an
    error rather than a wrong distance.
    """
    usable = ports.filter(geo.is_valid_lonlat(F.col(lon), F.col(lat)))
    if zone is None:
        own = F.least(F.lit(60), (F.floor((F.col(lon) + 180.0) / 6.0) + 1).cast("int"))
    else:
        off = F.pmod(F.col(lon) - geo.central_meridian(zone) + 180.0, F.lit(360.0)) - 180.0  # either way round the globe
        far = F.abs(off) > ZONE_REACH_DEG
        message = F.format_string(f"port at longitude %s is outside UTM zone {zone}", F.col(lon).cast("string"))
        own = F.when(far, F.raise_error(message).cast("int")).otherwise(F.lit(zone))
    placed = usable.withColumn("port_zone", own)
    return geo.add_utm(placed, lon, lat, zone or "port_zone", "port_e", "port_n", valid_only=True)


def reproject_features(features: DataFrame, zone: int) -> DataFrame:
    """Valid WGS84 positions for projected feature points, given ``easting``/``northing``/``crs`` columns.

    Rows in another CRS than the requested zone are an error rather than a silently wrong position.
    """
    expected = geo.epsg_of_zone(zone)
    checked = features.withColumn(
        "easting",
        F.when(F.col("crs") == expected, F.col("easting")).otherwise(
            F.raise_error(F.format_string(f"expected EPSG:{expected}, got EPSG:%s", F.col("crs").cast("string")))
        ),
    )
    located = geo.add_lonlat(checked, "easting", "northing", zone, "plon", "plat")
    return located.filter(geo.is_valid_lonlat(F.col("plon"), F.col("plat")))


def buffer_ports(projected: DataFrame, radius_m: float, zone: int, vertices: int = BUFFER_VERTICES) -> DataFrame:
    """Append ``ring``: the buffer polygon of each port in EPSG:4326."""
    return projected.withColumn("ring", geo.buffer_ring("port_e", "port_n", radius_m, vertices, zone))


def ring_envelope(rings: DataFrame, column: str = "ring") -> DataFrame:
    """One row with the bounds of all rings."""
    x = F.transform(F.col(column), lambda v: v["x"])
    y = F.transform(F.col(column), lambda v: v["y"])
    return rings.agg(
        F.min(F.array_min(x)).alias("xmin"),
        F.max(F.array_max(x)).alias("xmax"),
        F.min(F.array_min(y)).alias("ymin"),
        F.max(F.array_max(y)).alias("ymax"),
    )


def add_box(ports: DataFrame, radius_m: float, lon: str = "plon", lat: str = "plat") -> DataFrame:
    """Append ``x0, x1, y0, y1``: degrees around a port that hold every point within the radius.

    Metres become degrees with the shortest degree there is, so the box is slightly generous. Beyond the 180th meridian
    ``x0`` and ``x1`` go on counting; a box that holds a pole, or more than half the circle, holds all longitudes.
    """
    reach = F.lit(radius_m / SHORTEST_DEGREE_M)
    poleward = F.abs(F.col(lat)) + reach
    sideways = reach / F.greatest(F.cos(F.radians(F.least(poleward, F.lit(90.0)))), F.lit(1e-9))
    all_round = (poleward >= 90.0) | (sideways >= 180.0)
    return ports.withColumns(
        {
            "x0": F.when(all_round, F.lit(-180.0)).otherwise(F.col(lon) - sideways),
            "x1": F.when(all_round, F.lit(180.0)).otherwise(F.col(lon) + sideways),
            "y0": F.greatest(F.col(lat) - reach, F.lit(-90.0)),
            "y1": F.least(F.col(lat) + reach, F.lit(90.0)),
        }
    )


def longitude_ranges(x0: Column, x1: Column) -> Column:
    """A box's longitudes as one range, or as two where it crosses the 180th meridian: an array of ``x0, x1``."""

    def span(a, b) -> Column:
        return F.struct(a.alias("x0"), b.alias("x1"))

    low, high = F.lit(-180.0), F.lit(180.0)
    crossed_west = F.array(span(x0 + 360.0, high), span(low, x1))
    crossed_east = F.array(span(x0, high), span(low, x1 - 360.0))
    return F.when(x0 < low, crossed_west).when(x1 > high, crossed_east).otherwise(F.array(span(x0, x1)))


@dataclass(frozen=True)
class SearchArea:
    """What the driver needs to know about the port side: common bounds and the number of ports.

    ``west`` and ``east`` are the longitudes of boxes around the middle of either hemisphere, if there are boxes in both;
    ``levels`` are the levels of squares in use.
    """

    xmin: float | None
    xmax: float | None
    ymin: float | None
    ymax: float | None
    ports: int = 0
    west: tuple[float, float] | None = None
    east: tuple[float, float] | None = None
    levels: tuple[int, ...] = ()


def search_area(boxed: DataFrame, level: Column | None = None) -> SearchArea:
    """Facts about all boxes, from one single-row job. ``level`` tells the level of a box, if levels are asked for."""
    western = F.col("x0") + F.col("x1") < 0
    level = F.lit(0) if level is None else level
    row = boxed.select("y0", "y1", level.alias("level"), F.posexplode(longitude_ranges(F.col("x0"), F.col("x1"))).alias("nth", "range"))
    row = row.select("nth", "y0", "y1", "level", "range.x0", "range.x1").agg(
        *(f(F.when(side, F.col(c))).alias(f"{name}{c}") for name, side in (("w", western), ("e", ~western)) for f, c in ((F.min, "x0"), (F.max, "x1"))),
        F.min("y0").alias("ymin"),
        F.max("y1").alias("ymax"),
        F.count_if(F.col("nth") == 0).alias("ports"),
        F.collect_set("level").alias("levels"),
    ).first()
    west = (row["wx0"], row["wx1"]) if row["wx0"] is not None else None
    east = (row["ex0"], row["ex1"]) if row["ex0"] is not None else None
    sides = [s for s in (west, east) if s]
    xmin, xmax = (min(s[0] for s in sides), max(s[1] for s in sides)) if sides else (None, None)
    both = bool(west and east)
    return SearchArea(xmin, xmax, row["ymin"], row["ymax"], row["ports"], west if both else None, east if both else None, tuple(sorted(row["levels"])))


def within_bounds(
    df: DataFrame, area: SearchArea, lon: str = "longitude", lat: str = "latitude"
) -> DataFrame:
    """Keep points inside the bounds, all four sides included. Constant bounds reach the file scan."""
    if area.xmin is None:
        return df.filter(F.lit(False))
    sides = [area.west, area.east] if area.west and area.east and area.west[1] < area.east[0] else [(area.xmin, area.xmax)]
    across = [(F.col(lon) >= low) & (F.col(lon) <= high) for low, high in sides]
    return df.filter(across[0] if len(across) == 1 else across[0] | across[1]).filter(
        (F.col(lat) >= area.ymin) & (F.col(lat) <= area.ymax)
    )
