"""Hexagon cells on an equal-area plane, computed with plain Column arithmetic.

Cell ids are bigints of this project: resolution, then two axial coordinates of 28 bits each. They are
not interchangeable with ids of other grid systems. Resolution 6 has cells of 36 square kilometres and
every further resolution divides the area by seven.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import put_aside
from tidemark.functions.geo import double, is_valid_lonlat

# Authalic earth radius, standard parallel, base cell area.
EARTH_RADIUS_M = 6371007.181
STANDARD_PARALLEL_COS = math.cos(math.radians(30.0))
BASE_RESOLUTION = 6
BASE_AREA_M2 = 36e6

AXIS_BITS = 28
AXIS_OFFSET = 1 << (AXIS_BITS - 1)
AXIS_MASK = (1 << AXIS_BITS) - 1

MAP_RESOLUTIONS = (6, 7, 8, 9)
INGEST_RESOLUTIONS = (9, 10, 11)


def cell_area_m2(resolution: int) -> float:
    return BASE_AREA_M2 / 7 ** (resolution - BASE_RESOLUTION)


def cell_side_m(resolution: int) -> float:
    return math.sqrt(2 * cell_area_m2(resolution) / (3 * math.sqrt(3)))


# The cell of a point in steps of SQL text; names are columns of the step before.


def _plane(lon: str, lat: str) -> tuple[str, str]:
    return (
        f"{double(EARTH_RADIUS_M * STANDARD_PARALLEL_COS)} * radians({lon})",
        f"{double(EARTH_RADIUS_M / STANDARD_PARALLEL_COS)} * sin(radians({lat}))",
    )


def _axial(x: str, y: str, resolution: int) -> tuple[str, str]:
    """Fractional axial coordinates of a plane position."""
    side = cell_side_m(resolution)
    third = double(1 / (3 * side))
    return f"{double(math.sqrt(3) / (3 * side))} * {x} - {y} * {third}", f"2D * {y} * {third}"


def _worst(q: str, r: str, rq: str, rr: str, rs: str) -> str:
    """Which rounded cube axis is furthest from the exact one: 1 for q, 2 for r, 0 for the third."""
    dq, dr, ds = f"abs({rq} - {q})", f"abs({rr} - {r})", f"abs({rs} + {q} + {r})"
    return f"CASE WHEN {dq} > {dr} AND {dq} > {ds} THEN 1 WHEN {dr} > {ds} THEN 2 ELSE 0 END"


def _nearest(rq: str, rr: str, rs: str, worst: str, resolution: int) -> str:
    """Cell id from the rounded cube axes, the worst of which is derived from the others."""
    fixed_q = f"if({worst} = 1, -{rr} - {rs}, {rq})"
    fixed_r = f"if({worst} = 2, -{rq} - {rs}, {rr})"
    return (
        f"{resolution * (1 << 2 * AXIS_BITS)}L"
        f" + (CAST({fixed_q} AS BIGINT) + {AXIS_OFFSET}L) * {1 << AXIS_BITS}L"
        f" + (CAST({fixed_r} AS BIGINT) + {AXIS_OFFSET}L)"
    )


def add_cells(
    df: DataFrame, resolutions: tuple[int, ...], lon: str = "longitude", lat: str = "latitude", prefix: str = "hex_res"
) -> DataFrame:
    """Append ``<prefix>N`` for each resolution; NULL for NULL or invalid coordinates.

    Each resolution starts from the point itself. The work is spread over stacked projections so that no
    intermediate is evaluated twice.
    """
    df, now, back = put_aside(df, r"_[xy]|_(q|r|rq|rr|rs|w)\d+")
    lon, lat = now(lon), now(lat)
    usable = is_valid_lonlat(F.col(lon), F.col(lat))
    x, y = _plane(f"`{lon}`", f"`{lat}`")
    staged = df.withColumns({"_x": F.when(usable, F.expr(x)), "_y": F.when(usable, F.expr(y))})
    raw, whole, worst, out, temp = {}, {}, {}, {}, ["_x", "_y"]
    for res in resolutions:
        q, r, rq, rr, rs, w = (f"_{axis}{res}" for axis in ("q", "r", "rq", "rr", "rs", "w"))
        raw[q], raw[r] = (F.expr(axis) for axis in _axial("_x", "_y", res))
        whole |= {rq: F.expr(f"rint({q})"), rr: F.expr(f"rint({r})"), rs: F.expr(f"rint(-{q} - {r})")}
        worst[w] = F.expr(_worst(q, r, rq, rr, rs))
        out[f"{prefix}{res}"] = F.expr(_nearest(rq, rr, rs, w, res))
        temp += [q, r, rq, rr, rs, w]
    return back(staged.withColumns(raw).withColumns(whole).withColumns(worst).withColumns(out).drop(*temp))


def cell_resolution(cell: Column) -> Column:
    return F.shiftright(cell, 2 * AXIS_BITS)


def _axes(cell: Column) -> tuple[Column, Column]:
    q = F.shiftright(cell, AXIS_BITS).bitwiseAND(F.lit(AXIS_MASK)) - F.lit(AXIS_OFFSET)
    r = cell.bitwiseAND(F.lit(AXIS_MASK)) - F.lit(AXIS_OFFSET)
    return q.cast("double"), r.cast("double")


def cell_centroid(cell: Column) -> tuple[Column, Column]:
    """Longitude and latitude of the middle of a cell, whatever its resolution."""
    q, r = _axes(cell)
    area = F.lit(BASE_AREA_M2) / F.pow(F.lit(7.0), (cell_resolution(cell) - F.lit(BASE_RESOLUTION)).cast("double"))
    side = F.sqrt(F.lit(2.0) * area / F.lit(3 * math.sqrt(3)))
    x = side * F.lit(math.sqrt(3)) * (q + r / F.lit(2.0))
    y = side * F.lit(1.5) * r
    sin_lat = F.greatest(
        F.lit(-1.0), F.least(F.lit(1.0), y * F.lit(STANDARD_PARALLEL_COS / EARTH_RADIUS_M))
    )
    return (
        F.degrees(x / F.lit(EARTH_RADIUS_M * STANDARD_PARALLEL_COS)),
        F.when(cell.isNotNull(), F.degrees(F.asin(sin_lat))),
    )


def cell_hex(cell: Column) -> Column:
    """Lower-case hexadecimal form, padded to 15 digits."""
    return F.lpad(F.lower(F.hex(cell)), 15, "0")
