"""The same results in plain SQL over the given tables, for cross-checking.

Written without the tricks of the Spark side: theta joins instead of grid cells, one window per vessel
instead of time slices, half-plane tests instead of ray casting.
"""

from __future__ import annotations

import math

from tidemark.functions import geo, hexgrid
from tidemark.plans.catalogue import BBOX, HOLE_RADIUS_M, LINK_BASE, LINK_SUFFIXES, ZONE_RADIUS_M, ZONE_VERTICES
from tidemark.plans.given import TABLES

VALID = "longitude IS NOT NULL AND latitude IS NOT NULL AND longitude BETWEEN -180 AND 180 AND latitude BETWEEN -90 AND 90"
ALL_RESOLUTIONS = (6, 7, 8, 9)


def d(value: float) -> str:
    """A double literal."""
    return f"CAST('{value!r}' AS DOUBLE)"


PORTS = """
ports AS (SELECT CAST(n_nationkey AS BIGINT) port_id, n_name port_name,
  CASE WHEN n_nationkey=1 THEN CAST(-124.89 AS DOUBLE) ELSE CAST(-124.9 AS DOUBLE)+(n_nationkey%5)*CAST(0.6 AS DOUBLE) END plon,
  CASE WHEN n_nationkey=1 THEN CAST(47.2 AS DOUBLE) ELSE CAST(47.2 AS DOUBLE)+CAST(floor(n_nationkey/5.0) AS INT)*CAST(0.6 AS DOUBLE) END plat,
  CASE WHEN n_nationkey=24 THEN NULL WHEN n_nationkey%6=5 THEN 'Very Small'
       WHEN n_nationkey%3=0 THEN 'Small' WHEN n_nationkey%3=1 THEN 'Medium' ELSE 'Large' END size
  FROM nation)"""

PINGS = (
    PORTS
    + """,
p0 AS (SELECT *, (user_id*7+CAST(floor((day(ts)-1)/3.0) AS BIGINT)*3)%25 hp FROM events),
pings AS (SELECT event_id, user_id+366000000 mmsi, concat('VESSEL_',CAST(user_id AS VARCHAR(20))) vessel_name, ts,
  CASE WHEN event_id%97=0 THEN NULL
       ELSE plon+(CASE WHEN event_id%2=0 THEN 1 ELSE -1 END)*value/CAST(100 AS DOUBLE)*CAST(0.005 AS DOUBLE) END longitude,
  CASE WHEN event_id%97=0 THEN NULL WHEN event_id%101=0 THEN CAST(95 AS DOUBLE) ELSE plat+value/CAST(100 AS DOUBLE)*CAST(0.02 AS DOUBLE) END latitude
  FROM p0 JOIN ports ON hp=port_id)"""
)


def projection(source: str, lon: str, lat: str, out: str, easting: str, northing: str) -> str:
    """CTE chain appending projected metres (UTM zone 10) to a relation of valid points."""
    terms_e, terms_n = [], []
    for j, a in enumerate(geo.ALPHA, start=1):
        up, down = f"exp({2.0 * j}*eta)", f"exp({-2.0 * j}*eta)"
        terms_e.append(f"{d(a)}*cos({2.0 * j}*xi)*(({up}-{down})/2)")
        terms_n.append(f"{d(a)}*sin({2.0 * j}*xi)*(({up}+{down})/2)")
    k0a = d(geo.SCALE_FACTOR * geo.RECTIFYING_RADIUS_M)
    e = d(geo.ECCENTRICITY)
    return f"""
{out}_1 AS (SELECT *, radians({lon}-({geo.central_meridian(10)})) dl,
  atanh(sin(radians({lat}))) - {e}*atanh({e}*sin(radians({lat}))) u FROM {source}),
{out}_2 AS (SELECT *, (exp(u)-exp(-u))/2 t FROM {out}_1),
{out}_3 AS (SELECT *, atan2(t, cos(dl)) xi, atanh(sin(dl)/sqrt(1+t*t)) eta FROM {out}_2),
{out} AS (SELECT * EXCLUDE (dl, u, t, xi, eta), {d(geo.FALSE_EASTING_M)} + {k0a}*(eta + {" + ".join(terms_e)}) {easting},
  {k0a}*(xi + {" + ".join(terms_n)}) {northing} FROM {out}_3)"""


def unprojection(source: str, easting: str, northing: str, out: str, lon: str, lat: str) -> str:
    """CTE chain appending longitude and latitude to projected points."""
    k0a = d(geo.SCALE_FACTOR * geo.RECTIFYING_RADIUS_M)
    xi0, eta0 = ["xi"], ["eta"]
    for j, b in enumerate(geo.BETA, start=1):
        up, down = f"exp({2.0 * j}*eta)", f"exp({-2.0 * j}*eta)"
        xi0.append(f"{d(b)}*sin({2.0 * j}*xi)*(({up}+{down})/2)")
        eta0.append(f"{d(b)}*cos({2.0 * j}*xi)*(({up}-{down})/2)")
    phi = " + ".join(["chi"] + [f"{d(v)}*sin({2.0 * j}*chi)" for j, v in enumerate(geo.DELTA, start=1)])
    return f"""
{out}_1 AS (SELECT *, {northing}/{k0a} xi, ({easting}-{d(geo.FALSE_EASTING_M)})/{k0a} eta FROM {source}),
{out}_2 AS (SELECT *, {" - ".join(xi0)} xi0, {" - ".join(eta0)} eta0 FROM {out}_1),
{out}_3 AS (SELECT *, asin(sin(xi0)/((exp(eta0)+exp(-eta0))/2)) chi FROM {out}_2),
{out} AS (SELECT * EXCLUDE (xi, eta, xi0, eta0, chi),
  {geo.central_meridian(10)} + degrees(atan2((exp(eta0)-exp(-eta0))/2, cos(xi0))) {lon}, degrees({phi}) {lat} FROM {out}_3)"""


def hexed(source: str, out: str, resolution: int, column: str | None = None) -> str:
    """CTE chain appending the cell of one resolution; NULL where the point is unusable."""
    column = column or f"hex_res{resolution}"
    side = d(hexgrid.cell_side_m(resolution))
    c, r = d(hexgrid.STANDARD_PARALLEL_COS), d(hexgrid.EARTH_RADIUS_M)
    return f"""
{out}_1 AS (SELECT *, CASE WHEN {VALID} THEN {r}*{c}*radians(longitude) END hx,
  CASE WHEN {VALID} THEN {r}/{c}*sin(radians(latitude)) END hy FROM {source}),
{out}_2 AS (SELECT *, {d(math.sqrt(3))}/3*hx/{side} - hy/(3*{side}) qf, 2*hy/(3*{side}) rf FROM {out}_1),
{out}_3 AS (SELECT *, round(qf) rq, round(rf) rr, round(-qf-rf) rs FROM {out}_2),
{out}_4 AS (SELECT *, abs(rq-qf) dq, abs(rr-rf) dr, abs(rs-(-qf-rf)) ds FROM {out}_3),
{out} AS (SELECT * EXCLUDE (hx, hy, qf, rf, rq, rr, rs, dq, dr, ds),
  CAST({resolution} AS BIGINT)*{1 << 56}
  + (CAST(CASE WHEN dq>dr AND dq>ds THEN -rr-rs ELSE rq END AS BIGINT)+{1 << 27})*{1 << 28}
  + (CAST(CASE WHEN NOT (dq>dr AND dq>ds) AND dr>ds THEN -rq-rs ELSE rr END AS BIGINT)+{1 << 27}) {column}
  FROM {out}_4)"""


def centroid(cell: str, resolution: int) -> tuple[str, str]:
    """Longitude and latitude expressions of a cell's middle."""
    side = d(hexgrid.cell_side_m(resolution))
    q = f"(({cell}//{1 << 28})%{1 << 28}-{1 << 27})"
    r = f"({cell}%{1 << 28}-{1 << 27})"
    c, radius = d(hexgrid.STANDARD_PARALLEL_COS), d(hexgrid.EARTH_RADIUS_M)
    lon = f"degrees({side}*{d(math.sqrt(3))}*({q}+{r}/CAST(2 AS DOUBLE))/({radius}*{c}))"
    lat = f"degrees(asin(greatest(-1.0, least(1.0, {side}*1.5*{r}*{c}/{radius}))))"
    return lon, lat


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


PING_OUT = "event_id, mmsi, vessel_name, {ts} ts, round(longitude, 7) longitude, round(latitude, 7) latitude"
PINGS_FULL = PING_OUT.format(ts="ts")
PINGS_SECONDS = PING_OUT.format(ts="date_trunc('second', ts)")

IN_PORT = ",\n".join(
    [
        PINGS,
        projection("(SELECT * FROM ports WHERE size <> 'Very Small')", "plon", "plat", "pp", "pe", "pn"),
        projection(f"(SELECT * FROM pings WHERE {VALID} AND abs(latitude) < 90)", "longitude", "latitude", "pg", "e", "n"),
        """
in_port AS (SELECT event_id, mmsi, vessel_name, ts, pp.port_id, pp.port_name FROM pg JOIN pp
  ON (e-pe)*(e-pe)+(n-pn)*(n-pn) <= 1852.0*1852.0)""",
    ]
)
SESSIONS = (
    IN_PORT
    + """,
lagged AS (SELECT *, lag(port_id) OVER w prev_port, lag(ts) OVER w prev_time FROM in_port
  WINDOW w AS (PARTITION BY mmsi ORDER BY ts, port_id)),
flagged AS (SELECT *, CASE WHEN prev_port IS NULL OR prev_port <> port_id THEN 1 ELSE 0 END is_new_session FROM lagged),
sessions AS (SELECT *, CAST(sum(is_new_session) OVER (PARTITION BY mmsi ORDER BY ts, port_id ROWS UNBOUNDED PRECEDING) AS BIGINT) session_id
  FROM flagged)"""
)
STAYS = (
    SESSIONS
    + """,
stays AS (SELECT *, CAST(floor(epoch(departure_time)) AS BIGINT)-CAST(floor(epoch(arrival_time)) AS BIGINT) duration_seconds FROM (
  SELECT mmsi, vessel_name, port_id, port_name, session_id, min(ts) arrival_time, max(ts) departure_time
  FROM sessions GROUP BY ALL) WHERE duration_seconds > 900)"""
)
JOURNEYS = (
    STAYS
    + """,
legs AS (SELECT * FROM (SELECT *, port_name origin_port,
  lead(port_name) OVER (PARTITION BY mmsi ORDER BY arrival_time, session_id) destination_port FROM stays)
  WHERE destination_port IS NOT NULL AND origin_port <> destination_port)"""
)
OD = JOURNEYS + ",\nod AS (SELECT origin_port, destination_port, count(*) AS count FROM legs GROUP BY 1, 2)"


def _cell_hour(resolution: int) -> str:
    cell = f"hex_res{resolution}"
    return f"""
hourly{resolution} AS (SELECT {cell}, CAST(hour(ts) AS INTEGER) hour_of_day, count(DISTINCT mmsi) unique_vessels,
  count(*) total_records FROM c{resolution} GROUP BY 1, 2)"""


def _hourly(resolution: int) -> str:
    return with_(PINGS, hexed("pings", f"c{resolution}", resolution), _cell_hour(resolution))


def _daily(resolution: int) -> str:
    return _hourly(resolution) + f""",
daily AS (SELECT hex_res{resolution}, CAST(sum(unique_vessels) AS BIGINT) total_unique_vessels,
  CAST(sum(total_records) AS BIGINT) total_records FROM hourly{resolution} GROUP BY 1)"""


def _all_cells(resolutions: tuple[int, ...]) -> str:
    chain, source = [PINGS], "pings"
    for res in resolutions:
        chain.append(hexed(source, f"c{res}", res))
        source = f"c{res}"
    return with_(*chain)


LISTING = """
src AS (SELECT concat('pings-2024-', lpad(CAST(doc_id AS VARCHAR), 12, '0'),
  CASE doc_id%3 WHEN 0 THEN '.csv.zst' WHEN 1 THEN '.zip' ELSE '.txt' END) AS name, n_chars AS length FROM documents),
land AS (SELECT concat('pings-2024-', lpad(CAST(doc_id AS VARCHAR), 12, '0'),
  CASE doc_id%3 WHEN 0 THEN '.csv.zst' WHEN 1 THEN '.zip' ELSE '.txt' END) AS name FROM labels),
wanted AS (SELECT * FROM src WHERE name LIKE '%.csv.zst' OR name LIKE '%.zip'),
pending AS (SELECT * FROM wanted WHERE name NOT IN (SELECT name FROM land))"""

LINKS = f"""
hrefs AS (SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages),
links AS (SELECT page_id, href, concat('{LINK_BASE}/2024/', href) AS url FROM hrefs
  WHERE {" OR ".join(f"ends_with(href, '{s}')" for s in LINK_SUFFIXES)})"""


def _ring(relation: str, vertices: int, radius: float) -> str:
    """CTE with one row per ring vertex in the plane."""
    step = d(2 * math.pi / vertices)
    return f"""
verts AS (SELECT port_id, i vertex, pe + {d(radius)}*cos({step}*i) ve, pn + {d(radius)}*sin({step}*i) vn
  FROM {relation}, (SELECT unnest(range({vertices})) i))"""


def _zones() -> str:
    """Zones as convex polygons: a point is inside when it lies left of every edge."""
    return with_(
        PINGS,
        projection("ports", "plon", "plat", "pp", "pe", "pn"),
        _ring("pp", ZONE_VERTICES, ZONE_RADIUS_M),
        unprojection("verts", "ve", "vn", "ring", "vlon", "vlat"),
        f"""
edges AS (SELECT a.port_id, a.vlon x1, a.vlat y1, b.vlon x2, b.vlat y2 FROM ring a JOIN ring b
  ON a.port_id=b.port_id AND b.vertex=(a.vertex+1)%{ZONE_VERTICES}),
sides AS (SELECT event_id, mmsi, port_id zone_id,
  min(CASE WHEN (x2-x1)*(latitude-y1)-(y2-y1)*(longitude-x1) > 0 THEN 1 ELSE 0 END) inside
  FROM pings JOIN edges ON abs(longitude-x1) < 0.1 AND abs(latitude-y1) < 0.1 WHERE {VALID}
  GROUP BY ALL HAVING count(*) = {ZONE_VERTICES})
SELECT event_id, mmsi, zone_id FROM sides WHERE inside = 1""",
    )


def _zones_with_holes() -> str:
    """The even-odd test over all edges of both rings of every zone."""
    rings = [("outer", ZONE_RADIUS_M), ("hole", HOLE_RADIUS_M)]
    step = d(2 * math.pi / ZONE_VERTICES)
    vertices = " UNION ALL ".join(
        f"SELECT port_id, '{name}' part, i vertex, pe + {d(radius)}*cos({step}*i) ve, pn + {d(radius)}*sin({step}*i) vn "
        f"FROM pp, (SELECT unnest(range({ZONE_VERTICES})) i)"
        for name, radius in rings
    )
    return with_(
        PINGS,
        projection("ports", "plon", "plat", "pp", "pe", "pn"),
        f"\nverts AS ({vertices})",
        unprojection("verts", "ve", "vn", "ring", "vlon", "vlat"),
        f"""
edges AS (SELECT a.port_id, a.vlon x1, a.vlat y1, b.vlon x2, b.vlat y2 FROM ring a JOIN ring b
  ON a.port_id=b.port_id AND a.part=b.part AND b.vertex=(a.vertex+1)%{ZONE_VERTICES}),
near AS (SELECT event_id, mmsi, longitude, latitude, port_id FROM pings JOIN pp
  ON abs(longitude-plon) < 0.1 AND abs(latitude-plat) < 0.1 WHERE {VALID})
SELECT event_id, mmsi, near.port_id zone_id FROM near JOIN edges ON near.port_id=edges.port_id
  WHERE (y1 > latitude) <> (y2 > latitude) AND longitude < x1 + (latitude-y1)*(x2-x1)/(y2-y1)
  GROUP BY ALL HAVING count(*) % 2 = 1""",
    )


def _null_rows() -> str:
    columns = ("event_id", "mmsi", "vessel_name", "ts", "longitude", "latitude")
    return " UNION ALL ".join(
        f"SELECT '{c}' column_name, count(*) FILTER ({c} IS NULL) null_count, "
        f"round(CAST(100 AS DOUBLE)*count(*) FILTER ({c} IS NULL)/count(*), 1) null_percent FROM pings"
        for c in columns
    )


def _report() -> str:
    columns = ("event_id", "mmsi", "vessel_name", "ts", "longitude", "latitude")
    checks = {
        "total_rows": "count(*)",
        "unique_vessels": "count(DISTINCT mmsi)",
        "min_time": "floor(epoch(min(ts)))",
        "max_time": "floor(epoch(max(ts)))",
        "min_lat": "min(latitude)",
        "max_lat": "max(latitude)",
        "min_lon": "min(longitude)",
        "max_lon": "max(longitude)",
        "valid_geom": f"count(*) FILTER ({VALID})",
        "invalid_geom": f"count(*) FILTER (longitude IS NOT NULL AND latitude IS NOT NULL AND NOT ({VALID}))",
        "missing_geom": "count(*) FILTER (longitude IS NULL OR latitude IS NULL)",
        **{f"nulls_{c}": f"count(*) FILTER ({c} IS NULL)" for c in columns},
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", round(CAST({value} AS DOUBLE), 7) AS value FROM pings"
        for name, value in checks.items()
    )


def _profile() -> str:
    columns = (
        ("event_id", "int", "event_id"),
        ("mmsi", "int", "mmsi"),
        ("vessel_name", "string", "vessel_name"),
        ("base_date_time", "timestamp", "ts"),
        ("longitude", "double", "longitude"),
        ("latitude", "double", "latitude"),
    )
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' column_name, '{dtype}' data_type, count({source}) non_null FROM pings"
        for i, (name, dtype, source) in enumerate(columns)
    )


def _color_channels() -> str:
    lon, lat = centroid("hex_res8", 8)
    return (
        _daily(8)
        + f""",
known AS (SELECT * FROM daily WHERE hex_res8 IS NOT NULL),
b AS (SELECT ln(1+min(total_unique_vessels)) lo, ln(1+max(total_unique_vessels)) hi,
  CAST(sum(total_unique_vessels) AS BIGINT) all_vessels, CAST(sum(total_records) AS BIGINT) all_records FROM known),
s AS (SELECT known.*, b.all_vessels, b.all_records,
  CASE WHEN hi > lo THEN (ln(1+total_unique_vessels)-lo)/(hi-lo) ELSE 0 END nv FROM known, b)
SELECT hex_res8, lpad(lower(to_hex(hex_res8)), 15, '0') cell_hex, total_unique_vessels, total_records,
  round(nv, 6) normalized_vessels, round({lon}, 6) cell_lon, round({lat}, 6) cell_lat, 255 r,
  CAST(trunc(CASE WHEN nv < 0.5 THEN 255-90*(nv*2) ELSE 165*(1-(nv-0.5)*2) END) AS INTEGER) g, 0 b, 255 a,
  all_vessels, all_records FROM s"""
    )


def build() -> dict[str, str]:
    pings_only = with_(PINGS)
    lon7, lat7 = centroid("hex_res7", 7)
    lon9, lat9 = centroid("hex_res9", 9)
    drifted = f"""{pings_only} SELECT event_id, mmsi, CASE WHEN event_id % 3 <> 2 THEN vessel_name END vessel_name,
  date_trunc('second', ts) ts, round(longitude, 7) longitude, round(latitude, 7) latitude,
  CASE WHEN event_id % 3 = 1 THEN event_id % 30 END sog FROM pings"""
    counts = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", 1::BIGINT files, count(*) \"rows\" FROM {t}" for t in TABLES)
    sql = {
        "scan_csv_reordered": drifted,
        "stream_schema_drift": drifted,
        "file_manifest": counts,
        "replace_self": f"{pings_only} SELECT {PINGS_FULL}, event_id * 2 AS _x FROM pings WHERE event_id % 2 = 0",
        "scan_pings": f"{pings_only} SELECT {PINGS_FULL} FROM pings",
        "schema_profile": f"{pings_only} {_profile()}",
        "feature_source": with_(PORTS, projection("ports", "plon", "plat", "pp", "pe", "pn"))
        + " SELECT port_id, 26910 crs, round(pe, 3) easting, round(pn, 3) northing FROM pp",
        "link_extract": with_(LINKS) + " SELECT page_id, href, url FROM links",
        "write_overwrite": f"{pings_only} SELECT {PINGS_FULL} FROM pings",
        "enrich_table": _all_cells(ALL_RESOLUTIONS)
        + f""" SELECT event_id, date_trunc('second', ts) ts,
  CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN {VALID} END is_valid_geom,
  hex_res6, hex_res7, hex_res8, hex_res9 FROM c9""",
        "write_ports": with_(PORTS)
        + " SELECT port_id, port_name, round(plon, 6) plon, round(plat, 6) plat, size FROM ports WHERE size <> 'Very Small'",
        "agg_all_resolutions": _all_cells(ALL_RESOLUTIONS)
        + " "
        + " UNION ALL ".join(
            f"""SELECT {r} AS resolution, hex_res{r} AS cell, CAST(hour(ts) AS INTEGER) hour_of_day,
  count(DISTINCT mmsi) unique_vessels, count(*) total_records FROM c9 GROUP BY ALL"""
            for r in ALL_RESOLUTIONS
        ),
        "add_missing_columns": f"{pings_only} SELECT {PINGS_FULL}, CAST(NULL AS BOOLEAN) is_valid_geom, "
        "CAST(NULL AS BIGINT) hex_res9 FROM pings",
        "backfill_idempotent": with_(PINGS, hexed("pings", "c9", 9)) + " SELECT event_id, hex_res9 FROM c9",
        "backfill_staged": with_(PINGS, hexed("pings", "c9", 9)) + " SELECT event_id, hex_res9 FROM c9",
        "write_zclustered": f"{pings_only} SELECT {PINGS_FULL} FROM pings",
        "release_next_n": with_(LISTING)
        + " SELECT name, concat('/history/', name) path, length FROM pending ORDER BY name LIMIT 50",
        "parse_ts_default": "SELECT event_id, ts AS event_ts FROM events",
        "parse_ts_pattern": "SELECT event_id, date_trunc('second', ts) AS \"timestamp\" FROM events",
        "ports_expand": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "ports_not_very_small": with_(PORTS)
        + " SELECT port_id, port_name, round(plon, 6) plon, round(plat, 6) plat, size FROM ports WHERE size <> 'Very Small'",
        "bbox_filter": f"{pings_only} SELECT {PINGS_FULL} FROM pings WHERE longitude BETWEEN {d(BBOX.xmin)} AND {d(BBOX.xmax)} "
        f"AND latitude BETWEEN {d(BBOX.ymin)} AND {d(BBOX.ymax)}",
        "valid_points": f"{pings_only} SELECT {PINGS_FULL} FROM pings WHERE {VALID}",
        "sample_rows": f"{pings_only} SELECT {PINGS_FULL} FROM pings ORDER BY event_id LIMIT 10",
        "pings_in_ports": with_(IN_PORT) + " SELECT * FROM in_port",
        "pings_in_ports_two_zones": with_(IN_PORT) + " SELECT * FROM in_port",
        "od_matrix_from_features": with_(OD) + " SELECT * FROM od ORDER BY count DESC, origin_port, destination_port",
        "ports_from_features": with_(PORTS, projection("ports", "plon", "plat", "pp", "pe", "pn"))
        + """ SELECT port_id, port_name, size, round(plon, 6) plon, round(plat, 6) plat, round(pe, 3) easting, round(pn, 3) northing,
  CAST(port_id AS VARCHAR) "OID", CAST(port_id * 10 AS VARCHAR) "WPIN", concat('Region ', port_id % 5) "REGION",
  port_name "PORT", concat('XX ', port_id) "UN_LOCODE", lower(port_name) "COUNTRY", 'Sea' "WORLD_WATE",
  CASE WHEN port_id % 2 = 0 THEN 'Coastal' END "TYPE", round(plat, 6) "LAT", round(plon, 6) "LON" FROM pp""",
        "pings_in_zones": _zones(),
        "pings_in_feature_zones": _zones_with_holes(),
        "pending_files": with_(LISTING) + " SELECT name, concat('/history/', name) path, length FROM pending",
        "pending_decompress": with_(LISTING)
        + """, stem AS (SELECT name, replace(replace(name, '.csv.zst', '.csv'), '.zip', '.csv') csv_name FROM wanted),
there AS (SELECT replace(replace(name, '.csv.zst', '.csv'), '.zip', '.csv') csv_name FROM land)
SELECT name, csv_name FROM stem WHERE csv_name NOT IN (SELECT csv_name FROM there)""",
        "pending_urls": with_(LINKS)
        + """, there AS (SELECT split_part(href, '/', -1) AS name FROM hrefs WHERE contains(page_url, 'example.org'))
SELECT DISTINCT url, split_part(url, '/', -1) AS name FROM links WHERE split_part(url, '/', -1) NOT IN (SELECT name FROM there)""",
        "landing_full": with_(LISTING)
        + """ SELECT (SELECT count(*) FROM wanted) source_files, (SELECT count(*) FROM pending) missing_files,
  (SELECT count(*) FROM wanted) > 0 AND (SELECT count(*) FROM pending) = 0 landing_full""",
        "row_count": "SELECT count(*) AS row_count FROM events",
        "unique_vessels": "SELECT count(DISTINCT user_id) AS unique_vessels FROM events",
        "null_profile": f"{pings_only} SELECT * FROM ({_null_rows()}) WHERE null_count > 0",
        "time_range": "SELECT min(ts) min_time, max(ts) max_time FROM events",
        "geo_bounds": f"""{pings_only} SELECT round(min(latitude), 7) min_lat, round(max(latitude), 7) max_lat,
  round(min(longitude), 7) min_lon, round(max(longitude), 7) max_lon FROM pings""",
        "bounds_center": f"""{pings_only} SELECT round((min(latitude)+max(latitude))/2, 6) center_lat,
  round((min(longitude)+max(longitude))/2, 6) center_lon FROM pings""",
        "validity_summary": f"""{pings_only} SELECT CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN {VALID} END is_valid_geom,
  count(*) AS count FROM pings GROUP BY 1""",
        "dq_report": f"{pings_only} {_report()}",
        "cell_daily_sum": _daily(7) + " SELECT * FROM daily",
        "cell_daily_unique": with_(PINGS, hexed("pings", "c7", 7))
        + " SELECT hex_res7, count(DISTINCT mmsi) daily_unique, count(*) total_records FROM c7 GROUP BY 1",
        "cell_stats": _hourly(8)
        + """ SELECT count(*) hourly_rows, count(DISTINCT hex_res8) distinct_cells,
  count(DISTINCT hour_of_day) distinct_hours FROM hourly8""",
        "distinct_cells": _hourly(8) + " SELECT DISTINCT hex_res8 FROM hourly8",
        "vessel_stats": _daily(8)
        + """, k AS (SELECT CAST(total_unique_vessels AS DOUBLE) v FROM daily WHERE hex_res8 IS NOT NULL)
SELECT count(*) AS count, round(avg(v), 6) mean, round(stddev_samp(v), 6) std, min(v) AS min,
  round(quantile_cont(v, 0.25), 6) p25, round(quantile_cont(v, 0.5), 6) p50, round(quantile_cont(v, 0.75), 6) p75,
  max(v) AS max FROM k""",
        "cells_center": _hourly(7)
        + f""", k AS (SELECT DISTINCT hex_res7 FROM hourly7 WHERE hex_res7 IS NOT NULL)
SELECT round(avg({lat7}), 6) center_lat, round(avg({lon7}), 6) center_lon FROM k""",
        "cell_colors": _color_channels(),
        "cell_hex": with_(PINGS, hexed("pings", "c9", 9))
        + " SELECT event_id, lpad(lower(to_hex(hex_res9)), 15, '0') cell_hex FROM c9",
        "hex_cells": _all_cells(tuple(range(6, 12)))
        + " SELECT event_id, hex_res6, hex_res7, hex_res8, hex_res9, hex_res10, hex_res11 FROM c11",
        "cell_centroids": with_(PINGS, hexed("pings", "c9", 9))
        + f" SELECT DISTINCT hex_res9, round({lon9}, 6) cell_lon, round({lat9}, 6) cell_lat FROM c9 WHERE hex_res9 IS NOT NULL",
        "resolution_info": _all_cells(ALL_RESOLUTIONS)
        + " "
        + " UNION ALL ".join(
            f"""SELECT {r} AS resolution, count(DISTINCT hex_res{r}) cells, count(*) records,
  CAST({zoom} AS DOUBLE) zoom, '{text}' description FROM c9"""
            for r, zoom, text in (
                (6, 4.0, "~36 km² per hex - Continental/ocean-wide patterns"),
                (7, 5.0, "~5 km² per hex - Regional shipping lanes"),
                (8, 5.5, "~0.7 km² per hex - Port areas and coastal zones"),
                (9, 6.0, "~0.1 km² per hex - Detailed vessel movements"),
            )
        ),
        "point_geom": f"{pings_only} SELECT event_id, round(longitude, 7) x, round(latitude, 7) y FROM pings",
        "point_wkt": f"""{pings_only} SELECT event_id, CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL
  THEN printf('POINT(%.7f %.7f)', longitude, latitude) END wkt FROM pings""",
        "project_utm": with_(
            PINGS,
            projection(f"(SELECT * FROM pings WHERE {VALID} AND abs(latitude) < 90)", "longitude", "latitude", "pg", "e", "n"),
        )
        + " SELECT event_id, round(e, 4) easting, round(n, 4) northing FROM pings LEFT JOIN (SELECT event_id, e, n FROM pg) USING (event_id)",
        "unproject_utm": f"{pings_only} SELECT event_id, round(longitude, 7) longitude, round(latitude, 7) latitude "
        f"FROM pings WHERE {VALID} AND abs(latitude) < 90",
        "buffer_rings": with_(
            PORTS,
            projection("ports", "plon", "plat", "pp", "pe", "pn"),
            _ring("pp", 32, 1852.0),
            unprojection("verts", "ve", "vn", "ring", "vlon", "vlat"),
        )
        + " SELECT port_id, CAST(vertex AS INTEGER) vertex, round(vlon, 6) lon, round(vlat, 6) lat FROM ring",
        "ports_envelope": with_(
            PORTS,
            projection("(SELECT * FROM ports WHERE size <> 'Very Small')", "plon", "plat", "pp", "pe", "pn"),
            _ring("pp", 32, 1852.0),
            unprojection("verts", "ve", "vn", "ring", "vlon", "vlat"),
        )
        + " SELECT round(min(vlon), 6) xmin, round(max(vlon), 6) xmax, round(min(vlat), 6) ymin, round(max(vlat), 6) ymax FROM ring",
        "prev_port": with_(SESSIONS) + " SELECT event_id, port_id, prev_port, prev_time FROM sessions",
        "session_flags": with_(SESSIONS) + " SELECT event_id, port_id, is_new_session FROM sessions",
        "sessionize": with_(SESSIONS)
        + " SELECT event_id, mmsi, vessel_name, ts, port_id, port_name, session_id FROM sessions",
        "port_stays": with_(STAYS) + " SELECT * FROM stays",
        "journeys": with_(JOURNEYS)
        + " SELECT mmsi, session_id, arrival_time, departure_time, origin_port, destination_port FROM legs",
        "od_matrix": with_(OD) + " SELECT * FROM od ORDER BY count DESC, origin_port, destination_port",
        "od_top10": with_(OD) + " SELECT * FROM od ORDER BY count DESC, origin_port, destination_port LIMIT 10",
        "stream_drift_enriched": _all_cells((9, 10, 11))
        + f""" SELECT event_id, date_trunc('second', ts) ts, CASE WHEN event_id % 3 <> 2 THEN vessel_name END vessel_name,
  CASE WHEN event_id % 3 = 1 THEN event_id % 30 END sog,
  CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN {VALID} END is_valid_geom,
  hex_res9, hex_res10, hex_res11 FROM c11""",
        "pending_by_ledger": """
WITH m AS (SELECT doc_id, concat('archive-', doc_id % 10) path, concat('m', doc_id) member,
  CAST(n_chars % 20 + 1 AS BIGINT) expected_rows FROM documents),
c AS (SELECT m.*, CASE WHEN l.doc_id IS NULL THEN NULL WHEN m.doc_id % 2 <> 0 AND m.doc_id % 3 = 0 AND expected_rows > 1
  THEN expected_rows - 1 ELSE expected_rows END committed_rows FROM m LEFT JOIN labels l USING (doc_id))
SELECT path, member, expected_rows, committed_rows FROM c WHERE committed_rows IS NULL OR committed_rows < expected_rows""",
        "stream_enriched": _all_cells((9, 10, 11))
        + f""" SELECT event_id, date_trunc('second', ts) ts,
  CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN {VALID} END is_valid_geom,
  hex_res9, hex_res10, hex_res11 FROM c11""",
    }
    for name in ("scan_csv", "scan_csv_zst", "scan_csv_zip", "stream_ingest", "stream_stored_schema", "stream_resume", "stream_rate_limited"):
        sql[name] = f"{pings_only} SELECT {PINGS_SECONDS} FROM pings"
    for res in ALL_RESOLUTIONS:
        sql[f"cell_hour_res{res}"] = f"{_hourly(res)} SELECT * FROM hourly{res}"
    return sql
