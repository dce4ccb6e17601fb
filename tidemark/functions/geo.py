"""Points, validity, and the transverse Mercator projection as Column arithmetic.

A geometry is a pair of double columns (or ``struct<x, y>``) with a CRS known from context:
EPSG:4326 for longitude/latitude, EPSG:269zz for UTM zone zz north in metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import put_aside

WGS84 = 4326
NAUTICAL_MILE_M = 1852.0

# GRS80 ellipsoid and UTM constants (fixed values).
SEMI_MAJOR_M = 6378137.0
INVERSE_FLATTENING = 298.257222101
SCALE_FACTOR = 0.9996
FALSE_EASTING_M = 500000.0

_N = 1 / INVERSE_FLATTENING / (2 - 1 / INVERSE_FLATTENING)
RECTIFYING_RADIUS_M = SEMI_MAJOR_M / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ECCENTRICITY = 2 * math.sqrt(_N) / (1 + _N)

# Krueger series, third order in n (fixed values): forward, inverse, and conformal-to-geodetic latitude.
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)


def central_meridian(zone: int) -> float:
    """Longitude of the middle of a UTM zone, in degrees."""
    return -183.0 + 6.0 * zone


def epsg_of_zone(zone: int) -> int:
    """EPSG code of the NAD83 UTM zone on the northern hemisphere."""
    return 26900 + zone


def zone_of_epsg(epsg: int) -> int:
    """UTM zone of a supported projected CRS; anything else is an error."""
    if not 26901 <= epsg <= 26923:
        raise ValueError(f"EPSG:{epsg} is not supported, expected a NAD83 UTM zone (26901-26923)")
    return epsg - 26900


def point(lon: Column, lat: Column) -> Column:
    """``struct<x, y>`` in EPSG:4326, NULL when either coordinate is NULL."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("x"), lat.alias("y")))


def is_valid_lonlat(lon: Column, lat: Column) -> Column:
    """NULL for NULL coordinates, false when out of range or not finite."""
    return F.when(
        lon.isNotNull() & lat.isNotNull(),
        lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0),
    )


def point_wkt(lon: Column, lat: Column, decimals: int = 6) -> Column:
    """``POINT(lon lat)`` text with a fixed number of decimals."""
    number = f"%.{decimals}f"
    return F.when(
        lon.isNotNull() & lat.isNotNull(),
        F.format_string(f"POINT({number} {number})", lon, lat),
    )


def double(value: float) -> str:
    """SQL literal of a double."""
    return f"{float(value)!r}D"


def _series(start: str, coefficients: tuple[float, ...], term: str, sign: str = "+") -> str:
    """``start`` plus (or minus) the sum of coefficient times ``term``, with ``{k}`` standing for 2, 4, 6."""
    parts = [f" {sign} {double(c)} * {term.format(k=double(2 * j))}" for j, c in enumerate(coefficients, start=1)]
    return f"({start}{''.join(parts)})"


def add_utm(
    df: DataFrame,
    lon: str,
    lat: str,
    zone: int | str,
    easting: str = "easting",
    northing: str = "northing",
    valid_only: bool = False,
) -> DataFrame:
    """Append projected metres: for every row of ``df`` if it holds valid points only, else NULL where invalid.

    ``zone`` is a number for all rows, or the name of a column with each row's zone.

    Stacked projections evaluate each intermediate once, and the multiple angles of the series follow from
    the double ones by the addition theorems. With ``valid_only`` the results are declared free of NULLs
    (the coalesce never fires): a join or filter on them then gives the optimizer no IS NOT NULL test to
    push down, which would repeat the whole computation inside a filter.
    """
    df, now, back = put_aside(df, r"_(lon|lat|sin_phi|delta|t|xi|eta|up|(s|c|sh|ch)[246])")
    lon, lat = now(lon), now(lat)
    middle = double(central_meridian(zone)) if isinstance(zone, int) else f"(`{now(zone)}` * 6D - 183D)"
    e = double(ECCENTRICITY)
    k0a = double(SCALE_FACTOR * RECTIFYING_RADIUS_M)
    usable = is_valid_lonlat(F.col(lon), F.col(lat)) & (F.abs(F.col(lat)) < 90.0)
    inputs = {"_lon": F.col(lon), "_lat": F.col(lat)}
    if not valid_only:
        inputs = {name: F.when(usable, value) for name, value in inputs.items()}
    steps = [
        inputs,
        {
            "_sin_phi": F.expr("sin(radians(coalesce(_lat, 0D)))"),
            "_delta": F.expr(f"radians(coalesce(_lon, {middle}) - {middle})"),
        },
        {"_t": F.expr(f"sinh(atanh(_sin_phi) - {e} * atanh({e} * _sin_phi))")},
        {
            "_xi": F.expr("atan2(_t, cos(_delta))"),
            "_eta": F.expr("atanh(sin(_delta) * pow(1D + _t * _t, -0.5D))"),
        },
        {"_s2": F.expr("sin(2D * _xi)"), "_c2": F.expr("cos(2D * _xi)"), "_up": F.expr("exp(2D * _eta)")},
        {"_sh2": F.expr("0.5D * (_up - 1D / _up)"), "_ch2": F.expr("0.5D * (_up + 1D / _up)")},
    ]
    for low, high in ((2, 4), (4, 6)):
        steps.append(
            {
                f"_s{high}": F.expr(f"_s{low} * _c2 + _c{low} * _s2"),
                f"_c{high}": F.expr(f"_c{low} * _c2 - _s{low} * _s2"),
                f"_sh{high}": F.expr(f"_sh{low} * _ch2 + _ch{low} * _sh2"),
                f"_ch{high}": F.expr(f"_ch{low} * _ch2 + _sh{low} * _sh2"),
            }
        )
    east = " + ".join(["_eta", *(f"{double(a)} * _c{k} * _sh{k}" for a, k in zip(ALPHA, (2, 4, 6)))])
    north = " + ".join(["_xi", *(f"{double(a)} * _s{k} * _ch{k}" for a, k in zip(ALPHA, (2, 4, 6)))])
    east, north = F.expr(f"{double(FALSE_EASTING_M)} + {k0a} * ({east})"), F.expr(f"{k0a} * ({north})")
    if valid_only:
        east, north = F.coalesce(east, F.lit(0.0)), F.coalesce(north, F.lit(0.0))
    else:
        known = F.col("_lon").isNotNull()
        east, north = F.when(known, east), F.when(known, north)
    staged = df
    for step in steps:
        staged = staged.withColumns(step)
    return back(staged.withColumns({easting: east, northing: north}).drop(*(name for step in steps for name in step)))


# The inverse projection in four steps of SQL text, each a function of the previous one's results.


def _to_sphere(easting: str, northing: str) -> tuple[str, str]:
    scale = double(1.0 / (SCALE_FACTOR * RECTIFYING_RADIUS_M))
    return f"{northing} * {scale}", f"({easting} - {double(FALSE_EASTING_M)}) * {scale}"


def _undo_series(xi: str, eta: str) -> tuple[str, str]:
    return (
        _series(xi, BETA, f"sin({{k}} * {xi}) * cosh({{k}} * {eta})", "-"),
        _series(eta, BETA, f"cos({{k}} * {xi}) * sinh({{k}} * {eta})", "-"),
    )


def _conformal(xi0: str, eta0: str, zone: int) -> tuple[str, str]:
    lon = f"{double(central_meridian(zone))} + degrees(atan2(sinh({eta0}), cos({xi0})))"
    return lon, f"asin(sin({xi0}) * pow(cosh({eta0}), -1D))"


def _geodetic(chi: str) -> str:
    return f"degrees({_series(chi, DELTA, f'sin({{k}} * {chi})')})"


def add_lonlat(df: DataFrame, easting: str, northing: str, zone: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Append longitude and latitude of projected points."""
    df, now, back = put_aside(df, "_xi|_eta|_xi0|_eta0|_chi")
    xi, eta = _to_sphere(f"`{now(easting)}`", f"`{now(northing)}`")
    staged = df.withColumns({"_xi": F.expr(xi), "_eta": F.expr(eta)})
    xi0, eta0 = _undo_series("_xi", "_eta")
    staged = staged.withColumns({"_xi0": F.expr(xi0), "_eta0": F.expr(eta0)})
    x, chi = _conformal("_xi0", "_eta0", zone)
    staged = staged.withColumns({lon: F.expr(x), "_chi": F.expr(chi)})
    return back(staged.withColumn(lat, F.expr(_geodetic("_chi"))).drop("_xi", "_eta", "_xi0", "_eta0", "_chi"))


def _each_vertex(ring: str, xy: tuple[str, str]) -> str:
    return f"transform({ring}, v -> named_struct('x', {xy[0]}, 'y', {xy[1]}))"


def buffer_ring(easting: str, northing: str, radius_m: float, vertices: int, zone: int) -> Column:
    """Regular polygon standing for a circular buffer of a projected point: ``array<struct<x, y>>`` in EPSG:4326."""
    angle = f"{double(2 * math.pi / vertices)} * i"
    radius = double(radius_m)
    ring = (
        f"transform(sequence(0, {vertices - 1}), i -> named_struct("
        f"'x', {easting} + {radius} * cos({angle}), 'y', {northing} + {radius} * sin({angle})))"
    )
    return F.expr(_lonlat_ring(ring, zone))


def _lonlat_ring(ring: str, zone: int) -> str:
    ring = _each_vertex(ring, _to_sphere("v.x", "v.y"))
    ring = _each_vertex(ring, _undo_series("v.x", "v.y"))
    ring = _each_vertex(ring, _conformal("v.x", "v.y", zone))
    return _each_vertex(ring, ("v.x", _geodetic("v.y")))


def lonlat_rings(rings: str, zone: int) -> Column:
    """A column of projected rings ``array<array<struct<x, y>>>`` in EPSG:4326."""
    return F.expr(f"transform({rings}, ring -> {_lonlat_ring('ring', zone)})")
