from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, hexgrid, style

POINTS = [
    (-124.916667, 49.666667),
    (-123.0, 48.0),
    (-121.3, 46.2),
    (-125.9, 50.4),
    (-123.0, 0.0),
]


def points(spark, rows=None):
    return spark.createDataFrame(rows or POINTS, "longitude double, latitude double")


def test_projection_check_value(spark):
    row = geo.add_utm(points(spark, POINTS[:1]), "longitude", "latitude", 10).first()
    assert (row["easting"], row["northing"]) == pytest.approx((361694.859, 5503334.002), abs=1e-3)


def test_published_positions(spark):
    """A tower in zone 17 from a public gazetteer; lengths of the meridian on the ellipsoid, times the scale factor."""
    rows = [(-79.387139, 43.642567, 17, 630084.0, 4833438.0), (3.0, 45.0, 31, 500000.0, 0.9996 * 4984944.378), (9.0, 89.999999999, 32, 500000.0, 0.9996 * 10001965.729)]
    for lon, lat, zone, east, north in rows:
        row = geo.add_utm(points(spark, [(lon, lat)]), "longitude", "latitude", zone).first()
        assert (row["easting"], row["northing"]) == pytest.approx((east, north), abs=1.0)


def test_six_resolutions_stay_below_the_compilers_limit(spark, sf_dir):
    pings = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("value").alias("longitude"), F.col("value").alias("latitude"))
    for resolutions in ((6, 7, 8), (6, 7, 8, 9), (6, 7, 8, 9, 10, 11)):
        cells = hexgrid.add_cells(pings, resolutions)
        text = spark._jvm.PythonSQLUtils.explainString(cells._jdf.queryExecution(), "codegen")
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000


def test_central_meridian_maps_to_false_easting(spark):
    row = geo.add_utm(points(spark, [(-123.0, 0.0)]), "longitude", "latitude", 10).first()
    assert (row["easting"], row["northing"]) == pytest.approx((500000.0, 0.0), abs=1e-6)


def test_projection_round_trip(spark):
    there = geo.add_utm(points(spark), "longitude", "latitude", 10, valid_only=True)
    for row in geo.add_lonlat(there, "easting", "northing", 10).collect():
        assert row["lon"] == pytest.approx(row["longitude"], abs=1e-7)
        assert row["lat"] == pytest.approx(row["latitude"], abs=1e-7)


def test_projection_of_unusable_points_is_null(spark):
    rows = [(None, 48.0), (-123.0, None), (-123.0, 95.0), (float("nan"), 48.0), (-123.0, 90.0), (181.0, 1.0)]
    out = geo.add_utm(points(spark, rows), "longitude", "latitude", 10).collect()
    assert all(row["easting"] is None and row["northing"] is None for row in out)


def test_zone_of_epsg():
    assert geo.zone_of_epsg(26910) == 10
    assert geo.epsg_of_zone(10) == 26910
    with pytest.raises(ValueError, match="4326"):
        geo.zone_of_epsg(4326)


def test_validity_has_three_outcomes(spark):
    rows = [(-180.0, 90.0), (180.0, -90.0), (180.1, 0.0), (0.0, 95.0), (float("inf"), 0.0), (0.0, float("nan")), (None, 1.0)]
    valid = geo.is_valid_lonlat(F.col("longitude"), F.col("latitude"))
    got = [r[0] for r in points(spark, rows).coalesce(1).select(valid).collect()]
    assert got == [True, True, False, False, False, False, None]


def test_point_and_text(spark):
    df = points(spark, [(-124.5, 49.25), (None, 1.0)]).coalesce(1)
    rows = df.select(
        geo.point(F.col("longitude"), F.col("latitude")).alias("p"),
        geo.point_wkt(F.col("longitude"), F.col("latitude"), 2).alias("t"),
    ).collect()
    assert rows[0]["p"].asDict() == {"x": -124.5, "y": 49.25}
    assert rows[0]["t"] == "POINT(-124.50 49.25)"
    assert rows[1]["p"] is None and rows[1]["t"] is None


def test_cell_contains_its_centroid_and_is_near(spark):
    resolutions = (6, 8, 9, 11)
    celled = hexgrid.add_cells(points(spark), resolutions)
    for res in resolutions:
        cell = f"hex_res{res}"
        lon, lat = hexgrid.cell_centroid(F.col(cell))
        middle = celled.select("longitude", "latitude", cell, lon.alias("clon"), lat.alias("clat"))
        back = hexgrid.add_cells(middle, (res,), "clon", "clat", "back").collect()
        for row in back:
            assert row[f"back{res}"] == row[cell]
            k = math.cos(math.radians(30))
            r = hexgrid.EARTH_RADIUS_M
            dx = r * k * math.radians(row["longitude"] - row["clon"])
            dy = r / k * (math.sin(math.radians(row["latitude"])) - math.sin(math.radians(row["clat"])))
            assert math.hypot(dx, dy) <= hexgrid.cell_side_m(res) * (1 + 1e-9)


def test_centroid_of_no_cell_is_null(spark):
    lon, lat = hexgrid.cell_centroid(F.lit(None).cast("bigint"))
    assert tuple(spark.range(1).select(lon, lat).first()) == (None, None)


def test_cell_areas_shrink_by_seven():
    assert hexgrid.cell_area_m2(6) == 36e6
    assert hexgrid.cell_area_m2(8) == pytest.approx(36e6 / 49)


def test_cell_of_unusable_point_is_null(spark):
    rows = [(None, 48.0), (-123.0, 95.0), (float("nan"), 1.0)]
    assert [r["hex_res9"] for r in hexgrid.add_cells(points(spark, rows), (9,)).collect()] == [None] * 3


def test_cell_id_carries_resolution_and_prints_as_15_digits(spark):
    celled = hexgrid.add_cells(points(spark), (6, 11))
    for res in (6, 11):
        cell = F.col(f"hex_res{res}")
        for row in celled.select(hexgrid.cell_resolution(cell).alias("r"), hexgrid.cell_hex(cell).alias("h"), cell.alias("c")).collect():
            assert row["r"] == res
            assert row["h"] == format(row["c"], "015x")


def test_colour_ramp(spark):
    values = [(0.0,), (0.25,), (0.4999,), (0.5,), (0.75,), (1.0,)]
    df = spark.createDataFrame(values, "s double").coalesce(1)
    got = [r[0] for r in df.select(style.fire_rgba(F.col("s"))).collect()]
    assert got == [[255, g, 0, 255] for g in (255, 210, 165, 165, 82, 0)]


def test_scaling_of_equal_values_is_zero(spark):
    df = spark.createDataFrame([(3.0, 3.0, 3.0), (4.0, 3.0, 5.0), (None, 3.0, 3.0)], "v double, lo double, hi double")
    got = [r[0] for r in df.coalesce(1).select(style.min_max_scaled(F.col("v"), F.col("lo"), F.col("hi"))).collect()]
    assert got == [0.0, 0.5, None]


def test_zoom_defaults_to_five(spark):
    df = spark.createDataFrame([(6,), (8,), (12,)], "r int").coalesce(1)
    rows = df.select(style.zoom_of(F.col("r")).alias("z"), style.description_of(F.col("r")).alias("d")).collect()
    assert [r["z"] for r in rows] == [4.0, 5.5, 5.0]
    assert rows[2]["d"] is None and rows[0]["d"].startswith("~36")
