"""Helper columns never touch a caller's columns, whatever their names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, hexgrid
from tidemark.operators import spatial, voyages
from tidemark.sinks import tables
from tidemark.streaming import ingest

CLASHING = ["_x", "_Y", "_q9", "_rr9", "_t", "_lon", "_lat", "_s2", "_xi", "_chi", "_z", "_h"]


def frame(spark):
    df = spark.createDataFrame([(1, -123.2, 48.4), (2, None, 1.0)], "id bigint, longitude double, latitude double")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})


@pytest.mark.parametrize(
    "work",
    [
        lambda df: hexgrid.add_cells(df, (6, 9)),
        lambda df: geo.add_utm(df, "longitude", "latitude", 10),
        lambda df: geo.add_lonlat(geo.add_utm(df, "longitude", "latitude", 10), "easting", "northing", 10),
        lambda df: ingest.enriched(df, (9,)),
    ],
)
def test_columns_stay(spark, work):
    df = frame(spark)
    out = work(df)
    assert out.columns[: len(df.columns)] == df.columns
    assert sorted(map(tuple, out.select(*df.columns).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_clustered_write_keeps_columns(spark, tmp_path):
    df = frame(spark)
    out = tables.write_clustered(df, str(tmp_path / "c"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_a_point_may_stand_in_clashing_columns(spark):
    df = spark.createDataFrame([(-123.2, 48.4)], "_x double, _y double")
    plain = df.toDF("longitude", "latitude")
    cell = hexgrid.add_cells(df, (9,), "_x", "_y").first()["hex_res9"]
    assert cell == hexgrid.add_cells(plain, (9,)).first()["hex_res9"]


def test_a_table_may_be_replaced_by_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).withColumn("day", F.col("id") % 3)
    tables.replace_table(rows, "replaced_by_itself", path, ("day",))
    tables.replace_table(spark.table("replaced_by_itself").where("id > 4"), "replaced_by_itself", path, ("day",))
    out = spark.newSession().table("replaced_by_itself")
    assert sorted(r["id"] for r in out.collect()) == [5, 6, 7, 8, 9]
    with pytest.raises(Exception):
        tables.replace_table(out.withColumn("bad", F.raise_error(F.lit("no"))), "replaced_by_itself", path)
    assert spark.table("replaced_by_itself").count() == 5
    dropped = tables.drop_old_versions(spark, path, spark.table("replaced_by_itself"))
    assert dropped and spark.table("replaced_by_itself").count() == 5
    spark.sql("DROP TABLE replaced_by_itself")


def test_a_durable_view_is_seen_by_other_sessions(spark, tmp_path):
    root = str(tmp_path / "v")
    tables.publish_version(spark.range(3), root, "durable_numbers", durable=True)
    tables.publish_version(spark.table("durable_numbers").where("id > 0"), root, "durable_numbers", durable=True)
    assert spark.newSession().table("durable_numbers").count() == 2
    spark.sql("DROP VIEW durable_numbers")


VOYAGE_HELPERS = (
    "_vessel _slice _part _borders _at _block _prev_port _prev_ts _break _breaks _base _opens _in_port _in_ts _n_breaks _first "
    "_last _first_port _last_port _first_ts _last_ts _slot _next _opens _closes _edge"
).split()
SPATIAL_HELPERS = "_level _gx _gy _Salt _corner _edges easting Northing port_e port_n port_zone x0 y0 x1 y1 _x0".split()


def with_all(df, names):
    return df.withColumns({c: F.lit(f"own {c}") for c in names})


def same_rows(out, df):
    assert out.columns[: len(df.columns)] == df.columns
    own = [c for c in df.columns if c not in ("mmsi", "ts")]
    assert out.select(*own).distinct().collect() == df.select(*own).distinct().collect()


@pytest.mark.parametrize("slice_rows", [100, 1])
def test_sessions_keep_columns(spark, slice_rows):
    pings = spark.sql("SELECT id AS mmsi, 'A' AS vessel_name, timestamp_ntz '2024-01-01' AS ts, 1L AS port_id, 'P' AS port_name FROM range(3)")
    df = with_all(pings.unionByName(pings), VOYAGE_HELPERS)
    out = voyages.sessionize(df, slice_rows=slice_rows)
    same_rows(out, df)
    assert out.columns[len(df.columns) :] == ["prev_port", "prev_time", "is_new_session", "session_id"] and out.count() == 6
    assert voyages.sessionize(out).columns == out.columns


def test_journeys_keep_columns(spark):
    stays = spark.sql(
        "SELECT 1 AS mmsi, 'A' AS vessel_name, id AS port_id, concat('P', id) AS port_name, id AS session_id, "
        "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) AS arrival_time FROM range(5)"
    )
    df = with_all(stays, VOYAGE_HELPERS)
    out = voyages.journeys(df)
    assert out.columns == [*df.columns, "origin_port", "destination_port"] and out.count() == 4
    assert out.select(*VOYAGE_HELPERS).distinct().collect() == df.select(*VOYAGE_HELPERS).distinct().collect()


@pytest.mark.parametrize("limit", [20_000, 0])
@pytest.mark.parametrize("zone", [10, None])
def test_ports_join_keeps_columns(spark, limit, zone):
    df = with_all(frame(spark).select("id", "longitude", "latitude"), SPATIAL_HELPERS)
    ports = spark.sql("SELECT 7L AS port_id, 'P' AS port_name, -123.2D AS plon, 48.4D AS plat, 'own' AS _level, 'own' AS x0")
    out = spatial.pings_in_ports(df, ports, zone=zone, broadcast_max_rows=limit)
    assert [tuple(r) for r in out.collect()] == [(*df.where("id = 1").first(), 7, "P")]
    assert out.columns == [*df.columns, "port_id", "port_name"]
    assert spatial.pings_in_ports(out, ports, zone=zone, broadcast_max_rows=limit).columns == out.columns


@pytest.mark.parametrize("limit", [20_000, 0])
def test_zones_join_keeps_columns(spark, limit):
    df = with_all(frame(spark).select("id", "longitude", "latitude"), SPATIAL_HELPERS)
    box = "array(named_struct('x', -124D, 'y', 48D), named_struct('x', -123D, 'y', 48D), named_struct('x', -123D, 'y', 49D), named_struct('x', -124D, 'y', 49D))"
    out = spatial.pings_in_zones(df, spark.sql(f"SELECT 'Z' AS zone_id, {box} AS ring"), broadcast_max_rows=limit)
    assert [tuple(r) for r in out.collect()] == [(*df.where("id = 1").first(), "Z")]
