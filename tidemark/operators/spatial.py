"""Spatial joins as grid-cell equi-joins followed by the exact test.

A join on distance or containment alone would compare every ping with every port. Both sides get a
grid cell instead, Spark joins on the cell, and the exact predicate only sees candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.functions.columns import put_aside
from tidemark.operators import ports as port_ops
from tidemark.operators import zone_index
from tidemark.session import stored

BROADCAST_MAX_ROWS = 20_000
EDGES_PER_ROW = 32
SALTS = 32
ZONE_BASE_DEG = zone_index.BASE_DEG
PORT_BASE_DEG = 1.0 / 1024
_PORT_HELPERS = "_(level|gx|gy|salt)|easting|northing|port_(e|n|zone)"
_ZONE_HELPERS = "_(level|gx|gy|salt|corner|edges)"


def _join_on_cell(left: DataFrame, small: DataFrame, keys: list[str], small_rows: int, limit: int, salts: int) -> DataFrame:
    """Equi-join on grid cells: broadcast a side counted as small, else salt so a crowded cell is split."""
    if small_rows <= limit:
        return left.join(F.broadcast(small), keys)
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*keys, "_salt"]).drop("_salt")


def _settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a one-row generator, which the optimizer does not merge with what follows.

    For costly expressions used many times over, such as the bounds of a box.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[v.alias(c) for c, v in columns.items()]))))


def _square(degrees: Column, level: Column, base_deg: float) -> Column:
    return F.floor(degrees / (F.lit(base_deg) * F.pow(F.lit(2.0), level.cast("double")))).cast("int")


def _looking(pings: DataFrame, levels: list[int], base_deg: float) -> DataFrame:
    """Pings with the square that each looks into, once for every level in use."""
    level = F.lit(levels[0]) if len(levels) == 1 else F.explode(F.array(*[F.lit(x) for x in levels]))
    found = pings.withColumn("_level", level)
    at = F.col("_level")
    return found.withColumns({"_gx": _square(F.col("longitude"), at, base_deg), "_gy": _square(F.col("latitude"), at, base_deg)})


def _level() -> Column:
    """The level of a port's squares, by its box."""
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(PORT_BASE_DEG))
    return F.ceil(F.log2(extent / F.lit(PORT_BASE_DEG))).cast("int")


def _filed_ports(boxed: DataFrame) -> DataFrame:
    """Ports once for each square of their own level that their box touches, on either side of the 180th meridian."""
    levelled = _settled(boxed, _level=_level())

    def squares(low: Column, high: Column) -> Column:
        return F.sequence(_square(low, F.col("_level"), PORT_BASE_DEG), _square(high, F.col("_level"), PORT_BASE_DEG))

    ranges = port_ops.longitude_ranges(F.col("x0"), F.col("x1"))
    columns = F.array_distinct(F.flatten(F.transform(ranges, lambda r: squares(r["x0"], r["x1"]))))
    kept = ["port_id", "port_name", "port_e", "port_n", "port_zone", "_level"]
    filed = levelled.select(*kept, "y0", "y1", F.explode(columns).alias("_gx"))
    return filed.select(*kept, "_gx", F.explode(squares(F.col("y0"), F.col("y1"))).alias("_gy"))


def pings_in_ports(
    pings: DataFrame,
    ports: DataFrame,
    radius_m: float = geo.NAUTICAL_MILE_M,
    zone: int | None = 10,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Every (ping, port) pair no further apart than ``radius_m`` in the projected plane.

    Without ``zone`` a pair is measured in the zone of its port, so ports may lie anywhere, at the poles and at the 180th
    meridian too. ``pings`` has longitude and latitude; ``ports`` has port_id, port_name, plon, plat, which are appended
    and replace columns of those names.

    Each port is filed on a grid of squares about as wide as its own search box, so it takes at most 2 x 2 of them (twice
    that at the 180th meridian) whatever the others need. A ping looks into one square per level in use, of which there are
    at most 19 between the base and the whole globe, one or two for ports of similar latitude. Pings in squares without
    any port drop out in a semi-join before the projection, which is the expensive part.
    """
    ids = {c: ports.schema[c].dataType for c in ("port_id", "port_name")}
    plain, _, restored = put_aside(pings.drop(*ids), _PORT_HELPERS)
    projected = port_ops.add_box(port_ops.project_ports(ports, zone), radius_m)
    projected = _settled(projected, **{c: F.col(c) for c in ("x0", "x1", "y0", "y1")})
    filed = _filed_ports(projected)
    area = port_ops.search_area(projected, _level())
    if not area.ports:
        return restored(plain.filter(F.lit(False)).withColumns({c: F.lit(None).cast(kind) for c, kind in ids.items()}))
    keys = ["_level", "_gx", "_gy"]
    nearby = _looking(port_ops.within_bounds(plain, area), list(area.levels), PORT_BASE_DEG)
    squares = filed.select(*keys)
    squares = F.broadcast(squares) if area.ports <= broadcast_max_rows else squares.distinct()
    nearby = nearby.join(squares, keys, "left_semi")
    if zone is None:
        pairs = _join_on_cell(nearby, filed, keys, area.ports, broadcast_max_rows, salts)
        matched = geo.add_utm(pairs, "longitude", "latitude", "port_zone", valid_only=True)
    else:
        located = geo.add_utm(nearby, "longitude", "latitude", zone, valid_only=True)
        matched = _join_on_cell(located, filed, keys, area.ports, broadcast_max_rows, salts)
    de = F.col("easting") - F.col("port_e")
    dn = F.col("northing") - F.col("port_n")
    within = de * de + dn * dn <= F.lit(float(radius_m) ** 2)
    return restored(matched.filter(within).select(*plain.columns, "port_id", "port_name"))


def pings_in_zones(
    pings: DataFrame,
    zones: DataFrame,
    base_deg: float = ZONE_BASE_DEG,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Every (ping, zone) pair with the ping inside the zone under the even-odd rule (EPSG:4326).

    ``zones`` has ``zone_id`` and either ``ring`` (one ring of x and y) or ``rings`` (all outer rings and holes).
    ``zone_id`` is appended and replaces a column of that name. Zones are filed in squares that hold the edges passing them
    (see ``zone_index``), so a ping costs no more than the edges of its square, however many vertices the zone has.
    The index is stored once; its size is counted before it is broadcast.
    """
    rings = F.col("rings") if "rings" in zones.columns else F.array("ring")
    filed = stored(zone_index.zone_squares(zones.select("zone_id", rings.alias("rings")), base_deg), "zone-squares")
    side = F.lit(base_deg) * F.pow(F.lit(2.0), F.col("_level").cast("double"))
    facts = filed.agg(
        F.min(F.col("_gx") * side).alias("xmin"),
        F.max((F.col("_gx") + 1) * side).alias("xmax"),
        F.min(F.col("_gy") * side).alias("ymin"),
        F.max((F.col("_gy") + 1) * side).alias("ymax"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("_edges")).alias("edges"),
        F.collect_set("_level").alias("levels"),
    ).first()
    plain, _, restored = put_aside(pings.drop("zone_id"), _ZONE_HELPERS)
    if not facts["n"]:
        return restored(plain.limit(0).select("*", F.lit(None).cast(zones.schema["zone_id"].dataType).alias("zone_id")))
    area = port_ops.SearchArea(facts["xmin"], facts["xmax"], facts["ymin"], facts["ymax"])
    usable = port_ops.within_bounds(plain, area).filter(geo.is_valid_lonlat(F.col("longitude"), F.col("latitude")))
    looking = _looking(usable, sorted(facts["levels"]), base_deg)
    weight = max(facts["n"], facts["edges"] // EDGES_PER_ROW)
    matched = _join_on_cell(looking, filed, ["_level", "_gx", "_gy"], weight, broadcast_max_rows, salts)
    inside = zone_index.is_inside(F.col("longitude"), F.col("latitude"), base_deg)
    return restored(matched.filter(inside).select(*plain.columns, "zone_id"))
