"""Every query by name. Each reads the given tables in full."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import geo, hexgrid, style, temporal
from tidemark.operators import cells, filesets, ports, quality, spatial, voyages
from tidemark.plans import flows, given
from tidemark.session import scratch_path, ship_package
from tidemark.sinks import ledger, tables
from tidemark.sources import archives, features, links, listing
from tidemark.sources import pings as ping_files
from tidemark.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ZONE = 10
RADIUS_M = geo.NAUTICAL_MILE_M
BBOX = ports.SearchArea(xmin=-124.4, xmax=-122.6, ymin=47.5, ymax=49.0)
LINK_SUFFIXES = ("er", "ion", ".")
LINK_BASE = "https://files.example.org/pings"
ZONE_VERTICES = 12
ZONE_RADIUS_M = 1500.0
HOLE_RADIUS_M = 600.0


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, decimals: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, decimals) for c in columns})


def _table_name(label: str) -> str:
    return f"tidemark_{label}_{uuid.uuid4().hex}"


def _pings_out(df: DataFrame) -> DataFrame:
    return rounded(df.select(*given.PING_COLUMNS), 7, "longitude", "latitude")


# Scans and sources


@query
def scan_pings(spark, sf_dir):
    return _pings_out(given.pings(spark, sf_dir))


@query
def scan_csv(spark, sf_dir):
    folder = given.write_csv(spark, sf_dir, "csv")
    return _pings_out(ping_files.with_parsed_time(ping_files.scan_csv(spark, folder)))


def _drifted_out(df: DataFrame) -> DataFrame:
    named = ping_files.with_parsed_time(df).select(*given.PING_COLUMNS, F.col("sog").cast("bigint").alias("sog"))
    return rounded(named, 7, "longitude", "latitude")


@query
def scan_csv_reordered(spark, sf_dir):
    return _drifted_out(ping_files.scan_csv(spark, given.write_drifting_csv(spark, sf_dir, "drift")))


@query
def stream_schema_drift(spark, sf_dir):
    folder = given.write_drifting_csv(spark, sf_dir, "drift")
    checkpoint, path = scratch_path(spark, "drift-checkpoint"), scratch_path(spark, "drift-pings")
    return _drifted_out(ingest.ingest_by_name(spark, folder, checkpoint, path, max_files_per_trigger=4))


@query
def schema_profile(spark, sf_dir):
    folder = given.write_csv(spark, sf_dir, "csv")
    return quality.schema_profile(ping_files.scan_csv(spark, folder, schema=None))


@query
def scan_csv_zst(spark, sf_dir):
    folder = given.write_compressed(spark, sf_dir, "zst", "zst")
    return _pings_out(ping_files.with_parsed_time(ping_files.scan_csv(spark, folder)))


@query
def scan_csv_zip(spark, sf_dir):
    folder = given.write_compressed(spark, sf_dir, "zip", "zip")
    return _pings_out(ping_files.with_parsed_time(archives.scan_zip(spark, folder)))


@query
def feature_source(spark, sf_dir):
    folder = given.write_port_features(spark, sf_dir, "features")
    found = features.with_point_xy(features.read_features(spark, folder, "ports"))
    named = found.withColumn("port_id", F.get_json_object("properties", "$.OID").cast("bigint"))
    return rounded(named.select("port_id", "crs", "easting", "northing"), 3, "easting", "northing")


def _feature_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = features.read_features(spark, given.write_port_features(spark, sf_dir, "features"), "ports")
    return flows.ports_from_features(features.with_point_xy(found), ZONE)


@query
def ports_from_features(spark, sf_dir):
    placed = rounded(_feature_ports(spark, sf_dir), 3, "easting", "northing")
    return rounded(placed, 6, "plon", "plat", "LAT", "LON")


@query
def od_matrix_from_features(spark, sf_dir):
    return flows.od_matrix(given.pings(spark, sf_dir), _feature_ports(spark, sf_dir), zone=ZONE)


@query
def file_manifest(spark, sf_dir):
    """The given tables' files by name, each table with the rows read from its files."""
    listed = listing.list_files(spark, sf_dir).select(F.regexp_extract("path", r"/([a-z]+)\.parquet(/|$)", 1).alias("table"), "path")
    named = lambda name: F.col("_metadata.file_path").alias("path")
    read = reduce(
        DataFrame.unionByName, [spark.read.parquet(f"{sf_dir}/{t}.parquet").select(named(t), F.lit(t).alias("of")) for t in given.TABLES]
    )
    rows = read.groupBy("path", "of").agg(F.count(F.lit(1)).alias("rows"))
    return listing.with_rows(listed.where(F.col("table").isin(*given.TABLES)), rows)


@query
def link_extract(spark, sf_dir):
    pages = given.table(spark, sf_dir, "pages").select("page_id", "html")
    return links.file_links(pages, LINK_BASE, 2024, LINK_SUFFIXES).select("page_id", "href", "url")


# Sinks


@query
def write_overwrite(spark, sf_dir):
    table, path = _table_name("pings"), scratch_path(spark, "pings")
    rows = given.pings(spark, sf_dir)
    tables.replace_table(rows.select("event_id", F.lit("old").alias("mmsi")), table, path)
    return _pings_out(tables.replace_table(rows, table, path))


@query
def replace_self(spark, sf_dir):
    """A table replaced by a selection from itself, read back through the catalog by another session."""
    table, path = _table_name("pings"), scratch_path(spark, "pings")
    tables.replace_table(given.pings(spark, sf_dir), table, path)
    kept = spark.table(table).where(F.col("event_id") % 2 == 0).withColumn("_x", F.col("event_id") * 2)
    replaced = tables.replace_table(kept, table, path)
    tables.drop_old_versions(spark, path, replaced)
    return rounded(spark.newSession().table(table).select(*given.PING_COLUMNS, "_x"), 7, "longitude", "latitude")


@query
def enrich_table(spark, sf_dir):
    folder = given.write_csv(spark, sf_dir, "csv")
    root, view = scratch_path(spark, "pings"), _table_name("pings")
    tables.publish_version(ping_files.with_parsed_time(ping_files.scan_csv(spark, folder)), root, view)
    tables.publish_version(ingest.enriched(spark.table(view), hexgrid.MAP_RESOLUTIONS), root, view)
    return spark.table(view).select(
        "event_id", "ts", "is_valid_geom", *[f"hex_res{r}" for r in hexgrid.MAP_RESOLUTIONS]
    )


@query
def write_ports(spark, sf_dir):
    kept = ports.without_size(given.ports(spark, sf_dir))
    saved = tables.replace_table(kept, _table_name("ports"), scratch_path(spark, "ports"))
    return rounded(saved, 6, "plon", "plat")


@query
def agg_all_resolutions(spark, sf_dir):
    path = scratch_path(spark, "cells")
    cells.cell_hour_all(given.pings(spark, sf_dir)).write.partitionBy("resolution").parquet(path)
    return spark.read.parquet(path).select("resolution", "cell", "hour_of_day", "unique_vessels", "total_records")


@query
def add_missing_columns(spark, sf_dir):
    table = _table_name("pings")
    tables.replace_table(given.pings(spark, sf_dir), table, scratch_path(spark, "pings"))
    wanted = {"LATITUDE": "double", "is_valid_geom": "boolean", "hex_res9": "bigint"}
    tables.add_missing_columns(spark, table, wanted)
    tables.add_missing_columns(spark, table, wanted)
    out = spark.table(table).select(*given.PING_COLUMNS, "is_valid_geom", "hex_res9")
    return rounded(out, 7, "longitude", "latitude")


@query
def backfill_idempotent(spark, sf_dir):
    path = scratch_path(spark, "pings")
    celled = hexgrid.add_cells(given.pings(spark, sf_dir), (9,)).withColumn("day", F.to_date("ts"))
    known = celled.withColumn("hex_res9", F.when(F.day("ts") <= 20, F.col("hex_res9")))
    known.write.partitionBy("day").parquet(path)
    usable = geo.is_valid_lonlat(F.col("longitude"), F.col("latitude"))
    for _ in range(2):
        stored = spark.read.parquet(path)
        stored = tables.backfill(stored, lambda rows: hexgrid.add_cells(rows, (9,)), ("hex_res9",), usable, path, "day")
    return stored.select("event_id", "hex_res9")


@query
def backfill_staged(spark, sf_dir):
    """The same back-fill in a table whose partitions are switched to their filled copies."""
    celled = hexgrid.add_cells(given.pings(spark, sf_dir), (9,)).withColumn("week", F.weekofyear("ts"))
    known = celled.withColumn("hex_res9", F.when(F.day("ts") <= 20, F.col("hex_res9")))
    table = _table_name("backfill")
    tables.replace_table(known, table, scratch_path(spark, "backfill"), ("week",))
    usable = geo.is_valid_lonlat(F.col("longitude"), F.col("latitude"))
    for _ in range(2):
        tables.backfill_table(spark, table, lambda rows: hexgrid.add_cells(rows, (9,)), ("hex_res9",), usable, "week")
    return spark.table(table).select("event_id", "hex_res9")


@query
def write_zclustered(spark, sf_dir):
    return _pings_out(tables.write_clustered(given.pings(spark, sf_dir), scratch_path(spark, "clustered")))


@query
def release_next_n(spark, sf_dir):
    source, landed = given.file_listing(spark, sf_dir)
    return filesets.release_next(source, landed, 50).select("name", "path", "length")


# Projections and filters


@query
def parse_ts_default(spark, sf_dir):
    text = given.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("event_time"))
    return text.select("event_id", temporal.parse_ts(F.col("event_time")).alias("event_ts"))


@query
def parse_ts_pattern(spark, sf_dir):
    lines = given.ping_lines(spark, sf_dir)
    return ping_files.with_parsed_time(lines, target="timestamp").select("event_id", "timestamp")


@query
def ports_expand(spark, sf_dir):
    documents = given.table(spark, sf_dir, "events").select("event_id", "props")
    return ports.expand_properties(documents, '{"k": 1}', "props")


@query
def ports_not_very_small(spark, sf_dir):
    return rounded(ports.without_size(given.ports(spark, sf_dir)), 6, "plon", "plat")


@query
def bbox_filter(spark, sf_dir):
    return _pings_out(ports.within_bounds(given.pings(spark, sf_dir), BBOX))


@query
def valid_points(spark, sf_dir):
    rows = given.pings(spark, sf_dir)
    return _pings_out(rows.filter(geo.is_valid_lonlat(F.col("longitude"), F.col("latitude"))))


@query
def sample_rows(spark, sf_dir):
    return _pings_out(given.pings(spark, sf_dir).orderBy("event_id").limit(10))


# Joins


def _in_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.in_port_pings(given.pings(spark, sf_dir), given.ports(spark, sf_dir))


@query
def pings_in_ports(spark, sf_dir):
    return _in_port(spark, sf_dir).select("event_id", "mmsi", "vessel_name", "ts", "port_id", "port_name")


@query
def pings_in_ports_two_zones(spark, sf_dir):
    """Every second row of ports, and the pings around it, one UTM zone further east: the same pairs must be found."""
    row = lambda lat: F.floor((F.col(lat) - 46.9) / 0.6) % 2 * 6.0
    all_ports = given.ports(spark, sf_dir).withColumn("plon", F.col("plon") + row("plat"))
    rows = given.pings(spark, sf_dir).withColumn("longitude", F.col("longitude") + row("latitude"))
    found = flows.in_port_pings(rows, all_ports, zone=None)
    return found.select("event_id", "mmsi", "vessel_name", "ts", "port_id", "port_name")


@query
def pings_in_zones(spark, sf_dir):
    projected = ports.project_ports(given.ports(spark, sf_dir), ZONE)
    zones = ports.buffer_ports(projected, ZONE_RADIUS_M, ZONE, ZONE_VERTICES)
    found = spatial.pings_in_zones(given.pings(spark, sf_dir), zones.select(F.col("port_id").alias("zone_id"), "ring"))
    return found.select("event_id", "mmsi", "zone_id")


@query
def pings_in_feature_zones(spark, sf_dir):
    """Zones with holes, read from feature files as polygons and multi-polygons."""
    folder = given.write_zone_features(spark, sf_dir, "zone-features", (ZONE_RADIUS_M, HOLE_RADIUS_M), ZONE_VERTICES)
    crs = geo.epsg_of_zone(ZONE)
    zones = flows.zones_from_features(features.read_features(spark, folder, "zones").where(F.col("crs") == crs), "OID", ZONE)
    zones = zones.withColumn("zone_id", F.col("zone_id").cast("bigint"))
    return spatial.pings_in_zones(given.pings(spark, sf_dir), zones).select("event_id", "mmsi", "zone_id")


@query
def pending_files(spark, sf_dir):
    return filesets.pending_files(*given.file_listing(spark, sf_dir)).select("name", "path", "length")


@query
def pending_decompress(spark, sf_dir):
    source, landed = given.file_listing(spark, sf_dir)
    present = landed.withColumn("name", filesets.csv_name(F.col("name")))
    return filesets.pending_decompress(source, present).select("name", "csv_name")


@query
def pending_by_ledger(spark, sf_dir):
    """Documents stand for members of files, a few rows each. Labelled ones were ingested once, some of them cut short, and
    some of those once more, whole; a third batch broke off before its ledger was written."""
    size = (F.col("n_chars") % 20 + 1).cast("bigint")
    path = F.concat(F.lit("archive-"), F.col("doc_id") % 10)
    members = given.table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), F.concat(F.lit("m"), "doc_id").alias("member"), size.alias("expected_rows"))
    read = members.join(given.table(spark, sf_dir, "labels").select("doc_id"), "doc_id")

    def rows(some: DataFrame, short) -> DataFrame:
        line = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("expected_rows") - short))
        return some.select("path", "member", F.lit(None).cast("string").alias("corrupt_record"), line.alias("line"))

    root = scratch_path(spark, "ledger")
    short = F.when((F.col("doc_id") % 3 == 0) & (F.col("expected_rows") > 1), 1).otherwise(0)
    ledger.commit(rows(read, short), root, 0)
    ledger.commit(rows(read.where("doc_id % 2 = 0"), F.lit(0)), root, 1)
    rows(members, F.lit(0)).withColumn("_ledger_batch", F.lit(2).cast("bigint")).write.parquet(f"{root}/rows/{2:012d}")
    pending = ledger.pending_by_ledger(members.drop("doc_id"), ledger.ledger(spark, root))
    return pending.select("path", "member", "expected_rows", "committed_rows")


@query
def pending_urls(spark, sf_dir):
    pages = given.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = links.file_links(pages.select("page_id", "html"), LINK_BASE, 2024, LINK_SUFFIXES).select("url").distinct()
    mirrored = links.page_links(pages.filter(F.col("url").contains("example.org")))
    present = mirrored.select(filesets.file_of_url(F.col("href")).alias("name"))
    return filesets.pending_urls(found, present).select("url", "name")


@query
def landing_full(spark, sf_dir):
    return filesets.landing_full(*given.file_listing(spark, sf_dir))


# Profiling


@query
def row_count(spark, sf_dir):
    return quality.row_count(given.table(spark, sf_dir, "events"))


@query
def unique_vessels(spark, sf_dir):
    return quality.unique_count(given.pings(spark, sf_dir), "mmsi", "unique_vessels")


@query
def null_profile(spark, sf_dir):
    return quality.null_profile(given.pings(spark, sf_dir))


@query
def time_range(spark, sf_dir):
    return quality.time_range(given.pings(spark, sf_dir))


@query
def geo_bounds(spark, sf_dir):
    return rounded(quality.geo_bounds(given.pings(spark, sf_dir)), 7, "min_lat", "max_lat", "min_lon", "max_lon")


@query
def bounds_center(spark, sf_dir):
    return rounded(quality.bounds_center(given.pings(spark, sf_dir)), 6, "center_lat", "center_lon")


@query
def validity_summary(spark, sf_dir):
    return quality.validity_summary(given.pings(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    return rounded(quality.quality_report(given.pings(spark, sf_dir)), 7, "value")


# Cells


def _cell_hour(resolution: int) -> Query:
    def run(spark, sf_dir):
        return cells.cell_hour(given.pings(spark, sf_dir), resolution)

    run.__name__ = f"cell_hour_res{resolution}"
    return run


for _resolution in hexgrid.MAP_RESOLUTIONS:
    query(_cell_hour(_resolution))


def _hourly(spark: SparkSession, sf_dir: str, resolution: int) -> DataFrame:
    return cells.cell_hour(given.pings(spark, sf_dir), resolution)


@query
def cell_daily_sum(spark, sf_dir):
    return cells.cell_daily_sum(_hourly(spark, sf_dir, 7), "hex_res7")


@query
def cell_daily_unique(spark, sf_dir):
    return cells.cell_daily_unique(given.pings(spark, sf_dir), 7)


@query
def cell_stats(spark, sf_dir):
    return cells.cell_stats(_hourly(spark, sf_dir, 8), "hex_res8")


@query
def distinct_cells(spark, sf_dir):
    return cells.distinct_cells(_hourly(spark, sf_dir, 8), "hex_res8")


@query
def vessel_stats(spark, sf_dir):
    hourly = cells.cell_hour(cells.valid_pings(given.pings(spark, sf_dir)), 8)
    daily = cells.cell_daily_sum(hourly, "hex_res8")
    return rounded(cells.describe_values(daily, "total_unique_vessels"), 6, "mean", "std", "p25", "p50", "p75")


@query
def cells_center(spark, sf_dir):
    hourly = cells.cell_hour(cells.valid_pings(given.pings(spark, sf_dir)), 7)
    return rounded(cells.cells_center(hourly, "hex_res7"), 6, "center_lat", "center_lon")


@query
def cell_colors(spark, sf_dir):
    colored = flows.map_cells(given.pings(spark, sf_dir), 8)
    channels = [F.col("rgba")[i].alias(c) for i, c in enumerate("rgba")]
    out = colored.select(
        "hex_res8",
        "cell_hex",
        "total_unique_vessels",
        "total_records",
        "normalized_vessels",
        "cell_lon",
        "cell_lat",
        *channels,
        "all_vessels",
        "all_records",
    )
    return rounded(out, 6, "normalized_vessels", "cell_lon", "cell_lat")


@query
def cell_hex(spark, sf_dir):
    celled = hexgrid.add_cells(given.pings(spark, sf_dir), (9,))
    return celled.select("event_id", hexgrid.cell_hex(F.col("hex_res9")).alias("cell_hex"))


@query
def hex_cells(spark, sf_dir):
    resolutions = tuple(range(6, 12))
    celled = hexgrid.add_cells(given.pings(spark, sf_dir), resolutions)
    return celled.select("event_id", *[f"hex_res{r}" for r in resolutions])


@query
def cell_centroids(spark, sf_dir):
    celled = hexgrid.add_cells(cells.valid_pings(given.pings(spark, sf_dir)), (9,))
    return rounded(
        cells.cell_centroids(celled.select("hex_res9").distinct(), "hex_res9"), 6, "cell_lon", "cell_lat"
    )


@query
def resolution_info(spark, sf_dir):
    found = cells.cell_hour_all(given.pings(spark, sf_dir)).groupBy("resolution", "cell").agg(
        F.sum("total_records").alias("_n")
    )
    return (
        found.groupBy("resolution")
        .agg(F.count("cell").alias("cells"), F.sum("_n").alias("records"))
        .withColumns(
            {
                "zoom": style.zoom_of(F.col("resolution")),
                "description": style.description_of(F.col("resolution")),
            }
        )
    )


# Geometry


def _coordinate(value: Column, decimals: int, name: str) -> Column:
    return F.round(value, decimals).alias(name)


@query
def point_geom(spark, sf_dir):
    rows = given.pings(spark, sf_dir)
    located = rows.withColumn("p", geo.point(F.col("longitude"), F.col("latitude")))
    return located.select("event_id", _coordinate(F.col("p.x"), 7, "x"), _coordinate(F.col("p.y"), 7, "y"))


@query
def point_wkt(spark, sf_dir):
    return given.pings(spark, sf_dir).select(
        "event_id", geo.point_wkt(F.col("longitude"), F.col("latitude"), 7).alias("wkt")
    )


@query
def project_utm(spark, sf_dir):
    projected = geo.add_utm(given.pings(spark, sf_dir), "longitude", "latitude", ZONE)
    return rounded(projected.select("event_id", "easting", "northing"), 4, "easting", "northing")


@query
def unproject_utm(spark, sf_dir):
    projected = geo.add_utm(cells.valid_pings(given.pings(spark, sf_dir)), "longitude", "latitude", ZONE, valid_only=True)
    back = geo.add_lonlat(projected.select("event_id", "easting", "northing"), "easting", "northing", ZONE)
    return back.select("event_id", _coordinate(F.col("lon"), 7, "longitude"), _coordinate(F.col("lat"), 7, "latitude"))


@query
def buffer_rings(spark, sf_dir):
    projected = ports.project_ports(given.ports(spark, sf_dir), ZONE)
    ringed = ports.buffer_ports(projected, RADIUS_M, ZONE)
    vertices = ringed.select("port_id", F.posexplode("ring").alias("vertex", "v"))
    return vertices.select(
        "port_id", "vertex", _coordinate(F.col("v.x"), 6, "lon"), _coordinate(F.col("v.y"), 6, "lat")
    )


@query
def ports_envelope(spark, sf_dir):
    kept = ports.project_ports(ports.without_size(given.ports(spark, sf_dir)), ZONE)
    envelope = ports.ring_envelope(ports.buffer_ports(kept, RADIUS_M, ZONE))
    return rounded(envelope, 6, "xmin", "xmax", "ymin", "ymax")


# Voyages


@query
def prev_port(spark, sf_dir):
    return voyages.sessionize(_in_port(spark, sf_dir)).select("event_id", "port_id", "prev_port", "prev_time")


@query
def session_flags(spark, sf_dir):
    return voyages.sessionize(_in_port(spark, sf_dir)).select("event_id", "port_id", "is_new_session")


@query
def sessionize(spark, sf_dir):
    return voyages.sessionize(_in_port(spark, sf_dir)).select(
        "event_id", "mmsi", "vessel_name", "ts", "port_id", "port_name", "session_id"
    )


@query
def port_stays(spark, sf_dir):
    return flows.stays(given.pings(spark, sf_dir), given.ports(spark, sf_dir))


@query
def journeys(spark, sf_dir):
    legs = flows.journeys(given.pings(spark, sf_dir), given.ports(spark, sf_dir))
    return legs.select("mmsi", "session_id", "arrival_time", "departure_time", "origin_port", "destination_port")


@query
def od_matrix(spark, sf_dir):
    return flows.od_matrix(given.pings(spark, sf_dir), given.ports(spark, sf_dir))


@query
def od_top10(spark, sf_dir):
    return flows.od_matrix(given.pings(spark, sf_dir), given.ports(spark, sf_dir)).limit(10)


# Streaming


def _stream_table(spark: SparkSession, label: str) -> dict[str, str]:
    return {
        "checkpoint": scratch_path(spark, f"{label}-checkpoint"),
        "table": _table_name(label),
        "path": scratch_path(spark, label),
    }


def _stream_out(spark: SparkSession, target: dict[str, str]) -> DataFrame:
    stored = spark.table(target["table"]).withColumnRenamed("event_ts", "ts")
    return _pings_out(stored)


@query
def stream_ingest(spark, sf_dir):
    landing, target = given.write_csv(spark, sf_dir, "landing"), _stream_table(spark, "ingest")
    ingest.ingest(ingest.read_stream(spark, landing), **target, spatial=False)
    return _stream_out(spark, target)


@query
def stream_stored_schema(spark, sf_dir):
    landing, target = given.write_csv(spark, sf_dir, "landing"), _stream_table(spark, "stored")
    location = scratch_path(spark, "schema")
    ingest.stored_schema(spark, landing, location)
    schema = ingest.stored_schema(spark, landing, location)
    ingest.ingest(ingest.read_stream(spark, landing, schema), **target, spatial=False)
    typed = spark.table(target["table"]).withColumns(
        {
            "event_id": F.col("event_id").try_cast("bigint"),
            "mmsi": F.col("mmsi").try_cast("bigint"),
            "ts": F.col("event_ts"),
            "longitude": F.col("longitude").try_cast("double"),
            "latitude": F.col("latitude").try_cast("double"),
        }
    )
    return _pings_out(typed)


@query
def stream_resume(spark, sf_dir):
    landing, target = given.write_csv(spark, sf_dir, "landing"), _stream_table(spark, "resume")
    for _ in range(2):
        ingest.ingest(ingest.read_stream(spark, landing), **target, spatial=False)
    return _stream_out(spark, target)


@query
def stream_rate_limited(spark, sf_dir):
    files = given.file_count(spark, sf_dir)
    landing, target = given.write_csv(spark, sf_dir, "landing", files), _stream_table(spark, "limited")
    ingest.ingest(ingest.read_stream(spark, landing, max_files_per_trigger=files // 2), **target, spatial=False)
    return _stream_out(spark, target)


@query
def stream_enriched(spark, sf_dir):
    landing, target = given.write_csv(spark, sf_dir, "landing"), _stream_table(spark, "enriched")
    ingest.ingest(ingest.read_stream(spark, landing), **target)
    return spark.table(target["table"]).select(
        "event_id",
        F.col("event_ts").alias("ts"),
        "is_valid_geom",
        *[f"hex_res{r}" for r in hexgrid.INGEST_RESOLUTIONS],
    )


@query
def stream_drift_enriched(spark, sf_dir):
    """Files of three column orders into a table, with parsed time, cells and a typed column that only some have."""
    landing, target = given.write_drifting_csv(spark, sf_dir, "drift"), _stream_table(spark, "drift")
    options = {"time_column": "base_date_time", "pattern": ping_files.PING_TIME_PATTERN, "spatial": True, "typed": True}
    ingest.ingest_by_name(spark, landing, **target, max_files_per_trigger=4, **options)
    return spark.table(target["table"]).select(
        "event_id",
        F.col("event_ts").alias("ts"),
        "vessel_name",
        "sog",
        "is_valid_geom",
        *[f"hex_res{r}" for r in hexgrid.INGEST_RESOLUTIONS],
    )
