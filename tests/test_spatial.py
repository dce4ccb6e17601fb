"""Grid joins against comparing everything with everything, on both join strategies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.operators import ports as port_ops
from tidemark.operators import spatial

PING = "event_id bigint, longitude double, latitude double"
PORT = "port_id bigint, port_name string, plon double, plat double"


def random_pings(spark, n=2000, seed=5):
    rng = random.Random(seed)
    rows = [(i, -123.5 + rng.random() * 0.3, 48.5 + rng.random() * 0.3) for i in range(n)]
    rows += [(n, None, 48.6), (n + 1, -123.4, None), (n + 2, -123.4, 95.0), (n + 3, float("nan"), 48.6)]
    hot = [(n + 10 + i, -123.40001, 48.60001) for i in range(n // 2)]
    return spark.createDataFrame(rows + hot, PING)


def random_ports(spark, n=40, seed=6):
    rng = random.Random(seed)
    rows = [(i, f"P{i}", -123.5 + rng.random() * 0.3, 48.5 + rng.random() * 0.3) for i in range(n)]
    return spark.createDataFrame(rows + [(n, "hot", -123.4, 48.6), (n + 1, "bad", None, 48.6)], PORT)


def pairs(df, right):
    return sorted((r["event_id"], r[right]) for r in df.collect())


def brute_ports(pings, ports, radius, zone=10):
    usable = pings.filter(geo.is_valid_lonlat(F.col("longitude"), F.col("latitude")))
    left = geo.add_utm(usable, "longitude", "latitude", zone).collect()
    right = port_ops.project_ports(ports, zone).collect()
    return sorted(
        (e["event_id"], p["port_id"])
        for e in left
        for p in right
        if (e["easting"] - p["port_e"]) ** 2 + (e["northing"] - p["port_n"]) ** 2 <= radius**2
    )


@pytest.mark.parametrize("limit", [20_000, 0])
@pytest.mark.parametrize("radius", [300.0, 1852.0, 9000.0])
def test_ports_join_equals_brute_force(spark, radius, limit):
    pings, ports = random_pings(spark), random_ports(spark)
    got = spatial.pings_in_ports(pings, ports, radius, broadcast_max_rows=limit, salts=5)
    assert pairs(got, "port_id") == brute_ports(pings, ports, radius)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) == (limit == 0)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_ports_gives_no_pairs(spark):
    assert spatial.pings_in_ports(random_pings(spark, 10), random_ports(spark).limit(0)).count() == 0


def test_bounds_are_generous(spark):
    """No point on the rim of a buffer may be lost by the rough filter, near and far from the meridian."""
    ports = spark.createDataFrame([(0, "a", -125.9, 60.0), (1, "b", -123.0, 30.0), (2, "c", -120.1, 48.0)], PORT)
    for port in ports.collect():
        one = ports.filter(F.col("port_id") == port["port_id"])
        area = port_ops.search_area(port_ops.add_box(one, 1852.0))
        ring = port_ops.buffer_ports(port_ops.project_ports(one, 10), 1852.0, 10, 360).select(F.inline("ring"))
        assert port_ops.within_bounds(ring, area, "x", "y").count() == 360


def test_bounds_include_their_edges(spark):
    area = port_ops.SearchArea(xmin=-1.0, xmax=1.0, ymin=-2.0, ymax=2.0, ports=1)
    rows = [(1, -1.0, -2.0), (2, 1.0, 2.0), (3, 1.0000001, 0.0), (4, 0.0, None)]
    got = port_ops.within_bounds(spark.createDataFrame(rows, PING), area)
    assert sorted(r["event_id"] for r in got.collect()) == [1, 2]


def inside(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            hit = not hit
    return hit


@pytest.mark.parametrize("limit", [20_000, 0])
def test_zones_join_equals_brute_force(spark, limit):
    rings = {
        "notched": [(-123.45, 48.55), (-123.35, 48.55), (-123.4, 48.6), (-123.35, 48.65), (-123.45, 48.65)],
        "closed": [(-123.3, 48.6), (-123.25, 48.6), (-123.25, 48.7), (-123.3, 48.6)],
        "tiny": [(-123.4001, 48.5999), (-123.3999, 48.5999), (-123.3999, 48.6001), (-123.4001, 48.6001)],
        "huge": [(-170.0, -10.0), (-20.0, -10.0), (-20.0, 80.0), (-170.0, 80.0)],
    }
    zones = spark.createDataFrame(
        [(k, [{"x": x, "y": y} for x, y in ring]) for k, ring in rings.items()],
        "zone_id string, ring array<struct<x: double, y: double>>",
    )
    pings = random_pings(spark)
    got = spatial.pings_in_zones(pings, zones, broadcast_max_rows=limit, salts=3)
    rows = [r for r in pings.collect() if r["longitude"] is not None and r["latitude"] is not None and r["latitude"] <= 90]
    expected = sorted(
        (r["event_id"], k) for r in rows for k, ring in rings.items() if inside(ring, r["longitude"], r["latitude"])
    )
    assert pairs(got, "zone_id") == expected
    assert {z for _, z in expected} == set(rings)


def test_no_zones_gives_no_pairs(spark):
    zones = spark.createDataFrame([], "zone_id int, ring array<struct<x: double, y: double>>")
    assert spatial.pings_in_zones(random_pings(spark, 10), zones).count() == 0


def test_unknown_size_is_dropped_with_very_small(spark):
    ports = spark.createDataFrame([(1, "Very Small"), (2, None), (3, "Large")], "port_id int, size string")
    assert [r["port_id"] for r in port_ops.without_size(ports).collect()] == [3]


def test_feature_crs_must_match(spark):
    rows = [(500000.0, 5300000.0, 26911)]
    features = spark.createDataFrame(rows, "easting double, northing double, crs int")
    with pytest.raises(Exception, match="expected EPSG:26910, got EPSG:26911"):
        port_ops.reproject_features(features, 10).collect()


def globe_pings(spark, n=3000, seed=8):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lon = rng.choice([rng.uniform(179.95, 180), rng.uniform(-180, -179.95), rng.uniform(-180, 180)])
        rows.append((i, lon, rng.choice([rng.uniform(89.95, 90), rng.uniform(-90, -89.95), rng.uniform(9.95, 10.05)])))
    return spark.createDataFrame([*rows, (n, 180.0, 10.0), (n + 1, -180.0, 10.0), (n + 2, 33.0, 90.0), (n + 3, 0.0, -90.0)], PING)


GLOBE_PORTS = [
    (0, "north", 20.0, 89.99), (1, "south", -50.0, -89.995), (2, "east", 179.99, 10.0), (3, "west", -179.99, 10.0), (4, "on", 180.0, 10.01),
    (5, "pole", 0.0, 90.0),
]


@pytest.mark.parametrize("limit", [20_000, 0])
@pytest.mark.parametrize("radius", [1852.0, 4000.0])
def test_ports_at_poles_and_the_180th_meridian(spark, radius, limit):
    pings, ports = globe_pings(spark), spark.createDataFrame(GLOBE_PORTS, PORT)
    expected = set()
    for port in port_ops.project_ports(ports, None).collect():
        measured = geo.add_utm(pings, "longitude", "latitude", int(port["port_zone"]), valid_only=True).collect()
        expected |= {
            (e["event_id"], port["port_id"])
            for e in measured
            if (e["easting"] - port["port_e"]) ** 2 + (e["northing"] - port["port_n"]) ** 2 <= radius**2
        }
    got = pairs(spatial.pings_in_ports(pings, ports, radius, zone=None, broadcast_max_rows=limit, salts=3), "port_id")
    assert len(got) == len(set(got)) and set(got) == expected
    assert {p for _, p in expected} == {p[0] for p in GLOBE_PORTS}


def test_a_polar_port_leaves_the_others_their_squares(spark):
    ports = spark.createDataFrame([(1, "pole", 10.0, 89.99), (2, "harbour", -123.2, 48.4)], PORT)
    filed = spatial._filed_ports(port_ops.add_box(port_ops.project_ports(ports, None), 1852.0))
    side = {r["port_id"]: spatial.PORT_BASE_DEG * 2 ** r["_level"] for r in filed.collect()}
    assert side[2] < 0.2 and side[1] >= 180
    assert filed.groupBy("port_id").count().agg(F.max("count")).first()[0] <= 8


def test_a_fixed_zone_at_the_180th_meridian_takes_ports_of_both_sides(spark):
    ports = spark.createDataFrame([(1, "near", -179.0, 10.0), (2, "over", 179.99, 10.0)], PORT)
    assert port_ops.project_ports(ports, 1).count() == 2


def ring_of(points):
    return [{"x": x, "y": y} for x, y in points]


RINGS = "zone_id string, rings array<array<struct<x: double, y: double>>>"


def test_zones_with_holes_and_parts_equal_brute_force(spark):
    rng = random.Random(12)

    def star(cx, cy, reach, n):
        import math

        return [(cx + math.cos(i * 2 * math.pi / n) * reach * rng.uniform(0.3, 1), cy + math.sin(i * 2 * math.pi / n) * reach * rng.uniform(0.3, 1)) for i in range(n)]

    zones = {
        "hole": [star(-123.35, 48.65, 0.14, 300), star(-123.35, 48.65, 0.04, 40)],
        "parts": [star(-123.45, 48.55, 0.05, 7), star(-123.25, 48.75, 0.05, 90)],
        "on the grid": [[(-123.5, 48.5), (-123.25, 48.5), (-123.25, 48.75), (-123.5, 48.75)], [(-123.4375, 48.5625), (-123.375, 48.5625), (-123.375, 48.625), (-123.4375, 48.625)]],
        "needle": [[(-123.5, 48.5), (-123.2, 48.8), (-123.2, 48.8001)]],
        "degenerate": [[(-123.4, 48.6)], [(-123.4, 48.6), (-123.3, 48.6)]],
        "empty": [],
    }
    table = spark.createDataFrame([(k, [ring_of(r) for r in rings]) for k, rings in zones.items()], RINGS)
    pings = random_pings(spark, 4000)
    rows = [r for r in pings.collect() if r["longitude"] is not None and r["latitude"] is not None and r["latitude"] <= 90]
    expected = sorted(
        (r["event_id"], k) for r in rows for k, rings in zones.items() if sum(inside(ring, r["longitude"], r["latitude"]) for ring in rings) % 2
    )
    for limit in (20_000, 0):
        assert pairs(spatial.pings_in_zones(pings, table, broadcast_max_rows=limit, salts=3), "zone_id") == expected
    assert {"hole", "parts", "on the grid"} <= {z for _, z in expected}


def test_a_zone_of_many_vertices_has_few_edges_in_a_square():
    import math

    import numpy as np

    from tidemark.operators import zone_index

    n = 100_000
    circle = [{"x": 10 * math.cos(i * 2 * math.pi / n), "y": 10 * math.sin(i * 2 * math.pi / n)} for i in range(n)]
    squares = list(zone_index.squares_of(zone_index.ring_edges([circle])))
    sizes = [len(edges) for *_, edges in squares if len(edges)]
    assert max(sizes) <= 1000 and len(squares) <= 2 * n and n <= sum(sizes) <= 1.5 * n
    assert np.mean([corner for *_, corner, edges in squares if not len(edges)]) == 1


def test_missing_coordinates_make_no_edges():
    from tidemark.operators import zone_index

    assert len(zone_index.ring_edges([[{"x": 1.0, "y": None}, {"x": 2.0, "y": 1.0}], None, [None]])) == 0
    assert list(zone_index.squares_of(zone_index.ring_edges(None))) == []
