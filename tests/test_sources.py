from __future__ import annotations

import datetime as dt
import json
import struct
import zipfile

import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, IsNotNull

from tidemark.operators import filesets
from tidemark.plans import flows
from tidemark.sources import archives, features, pings
from tidemark.sources.pings import scan_csv, with_parsed_time
from tidemark.streaming import ingest

HEADER = "event_id,mmsi,vessel_name,base_date_time,longitude,latitude"
GOOD = ['1,366000001,"A, ""B""",2024-03-01T00:00:01,-123.5,48.5', "2,366000002,,bad time,-123.25,"]
BAD = "3,not a number,C,2024-03-01T00:00:03,-123,48"
TEXT = "\n".join([HEADER, *GOOD, BAD]) + "\n"
EXPECTED = [
    (1, 366000001, 'A, "B"', dt.datetime(2024, 3, 1, 0, 0, 1), -123.5, 48.5),
    (2, 366000002, None, None, -123.25, None),
    (3, None, "C", dt.datetime(2024, 3, 1, 0, 0, 3), -123.0, 48.0),
]


def result(df):
    rows = with_parsed_time(df).select("event_id", "mmsi", "vessel_name", "ts", "longitude", "latitude").collect()
    return sorted(tuple(r) for r in rows)


def test_csv_with_unreadable_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT)
    (tmp_path / "short.csv").write_text(HEADER + "\n4,5\n")
    (tmp_path / "ignored.txt").write_text("x\ny\n")
    df = scan_csv(spark, str(tmp_path), keep_corrupt=True)
    assert result(df) == [*EXPECTED, (4, 5, None, None, None, None)]
    corrupt = df.filter(F.col("corrupt_record").isNotNull()).select("event_id", "corrupt_record")
    assert sorted((r["event_id"], r["corrupt_record"]) for r in corrupt.collect()) == [(3, BAD), (4, "4,5")]


def test_plain_and_compressed_files_together(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT)
    (tmp_path / "b.csv.zst").write_bytes(zstandard.compress(TEXT.encode()))
    (tmp_path / "c.zip").write_bytes(b"not looked at")
    assert result(scan_csv(spark, str(tmp_path))) == sorted(EXPECTED * 2)


def test_inferred_time_is_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + "1,2,x,2024-03-01T00:00:01,1.5,2.5\n")
    df = scan_csv(spark, str(tmp_path), schema=None)
    assert dict(df.dtypes)["base_date_time"] == "timestamp"
    assert with_parsed_time(df).first()["ts"] == dt.datetime(2024, 3, 1, 0, 0, 1)


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in members.items():
            out.writestr(name, text)


def test_zip_members(spark, tmp_path, monkeypatch):
    archive(tmp_path / "a.zip", {"one.csv": TEXT, "two.csv": TEXT.replace("\n", "\r\n"), "skip.txt": "x"})
    archive(tmp_path / "b.zip", {"../../evil.csv": TEXT.rstrip("\n"), "empty.csv": "", "bare.csv": HEADER})
    df = archives.scan_zip(spark, str(tmp_path))
    assert result(df) == sorted(EXPECTED * 3)
    assert {r["member"] for r in df.select("member").distinct().collect()} == {"one.csv", "two.csv", "../../evil.csv"}
    assert not list(tmp_path.parent.rglob("evil.csv"))


def test_lines_survive_any_chunk_size(monkeypatch):
    import io

    text = "".join(f"línea {i} 🚢\n" for i in range(50)) + "last"
    for size in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(archives, "CHUNK_BYTES", size)
        assert "\n".join(archives._text_blocks(io.BytesIO(text.encode()))).split("\n") == text.split("\n")


REORDERED = "mmsi,base_date_time,Longitude,latitude,sog,vessel_name\n366000003,2024-03-01T00:00:05,1.5,2.5,9,Z\n"


def check_names(df):
    rows = {r["mmsi"]: r for r in with_parsed_time(df).collect()}
    assert df.columns[:6] == HEADER.split(",") and "sog" in df.columns
    new, old = rows[366000003], rows[366000001]
    assert (new["event_id"], new["vessel_name"], new["longitude"], new["latitude"], new["sog"]) == (None, "Z", 1.5, 2.5, "9")
    assert new["ts"] == dt.datetime(2024, 3, 1, 0, 0, 5) and (old["event_id"], old["sog"], old["longitude"]) == (1, None, -123.5)
    assert len(rows) == 4


@pytest.mark.parametrize("keep_corrupt", [False, True])
def test_columns_are_found_by_name(spark, tmp_path, keep_corrupt):
    (tmp_path / "a.csv").write_text(TEXT)
    (tmp_path / "b.csv.zst").write_bytes(zstandard.compress(REORDERED.encode()))
    (tmp_path / "empty.csv").write_text("")
    check_names(scan_csv(spark, str(tmp_path), keep_corrupt=keep_corrupt))


def test_zip_columns_are_found_by_name(spark, tmp_path):
    archive(tmp_path / "a.zip", {"one.csv": TEXT, "two.csv": REORDERED, "empty.csv": ""})
    check_names(archives.scan_zip(spark, str(tmp_path)).drop("path", "member"))


def test_stream_columns_are_found_by_name(spark, tmp_path):
    landing, check, out = (str(tmp_path / n) for n in ("landing", "check", "out"))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.csv").write_text(TEXT)
    assert ingest.ingest_by_name(spark, landing, check, out).count() == 3
    (tmp_path / "landing" / "b.csv").write_text(REORDERED)
    check_names(ingest.ingest_by_name(spark, landing, check, out))
    assert ingest.ingest_by_name(spark, landing, check, out).count() == 4


def test_a_stream_by_position_refuses_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(REORDERED)
    query = ingest.read_stream(spark, str(tmp_path)).writeStream.format("memory").queryName("refused").trigger(availableNow=True)
    with pytest.raises(Exception):
        query.start().awaitTermination()


def test_header_names():
    assert pings.header_names("\ufeffa, b ,,\"c,d\"\r\n") == ("a", "b", "_c2", "c,d")
    with pytest.raises(ValueError, match="twice"):
        pings.header_names("a,B,b")


def test_members_are_dealt_by_size(spark, tmp_path):
    for i in range(40):
        archive(tmp_path / f"{i}.zip", {f"m{i}.csv": HEADER + "\n" + "1,2,x,,1,2\n" * (i + 1)})
    members = archives.list_members(spark, str(tmp_path)).cache()
    counts = archives.dealt_members(members).groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) == 40 and {r["count"] for r in counts} == {1}
    sizes = archives.dealt_members(members, 8).groupBy(F.spark_partition_id()).agg(F.sum("member_bytes").alias("n")).collect()
    assert len(sizes) == 8 and max(r["n"] for r in sizes) < 1.5 * min(r["n"] for r in sizes)
    assert archives.scan_zip(spark, str(tmp_path)).count() == 40 * 41 // 2


def test_ledger_counts_rows_and_unreadable_rows(spark, tmp_path):
    archive(tmp_path / "a.zip", {"one.csv": TEXT, "two.csv": TEXT + BAD + "\n"})
    ledger = filesets.ingest_ledger(archives.scan_zip(spark, str(tmp_path)))
    assert sorted((r["member"], r["rows"], r["corrupt_rows"]) for r in ledger.collect()) == [("one.csv", 3, 1), ("two.csv", 4, 2)]


PROPERTIES = {
    "OID": "12.0", "WPIN": "34.0", "REGION": "North", "PORT": "Sandy Cove", "UN_LOCODE": "XX SND", "COUNTRY": "Nowhere",
    "WORLD_WATE": "Sea", "SIZE": "Small", "TYPE": "Coastal", "LAT": 49.5, "LON": -124.5,
}


def collection(name, coordinates, epsg=26910, kind="Point"):
    return json.dumps(
        {
            "type": "FeatureCollection",
            "name": name,
            "crs": {"type": "name", "properties": {"name": f"urn:ogc:def:crs:EPSG::{epsg}"}},
            "features": [{"type": "Feature", "geometry": {"type": kind, "coordinates": coordinates}, "properties": PROPERTIES}],
        }
    )


def test_features_to_ports(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "p.geojson").write_text(collection("ports", [361694.859, 5503334.002]))
    archive(tmp_path / "z.zip", {"ports.geojson": collection("ports", [500000.0, 5500000.0]), "readme.txt": "x"})
    found = features.read_features(spark, str(tmp_path), "ports")
    assert [f.name for f in found.schema] == ["geometry", "crs", "properties"]
    assert found.rdd.getNumPartitions() == 2
    rows = flows.ports_from_features(features.with_point_xy(found), 10).orderBy("plon").collect()
    assert [r["port_name"] for r in rows] == ["Sandy Cove", "Sandy Cove"]
    assert (rows[0]["plon"], rows[0]["plat"]) == pytest.approx((-124.916667, 49.666667), abs=1e-6)
    assert rows[1]["plon"] == pytest.approx(-123.0)


@pytest.mark.parametrize("option", ["path", "layer_name"])
def test_feature_options_are_mandatory(option):
    options = {"path": "/x", "layer_name": "y"}
    del options[option]
    with pytest.raises(ValueError, match=option):
        features.FeatureReader(options)


def test_unknown_layer_is_an_error(spark, tmp_path):
    (tmp_path / "p.geojson").write_text(collection("other", [1.0, 2.0]))
    with pytest.raises(Exception, match="has no layer ports"):
        features.read_features(spark, str(tmp_path), "ports").collect()


def test_polygon_bytes_and_point_only_decoding(spark):
    wkb = features.to_wkb({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1], [0, 0]]]})
    assert struct.unpack("<BII", wkb[:9]) == (1, 3, 1) and len(wkb) == 9 + 4 + 4 * 16
    big_endian = struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    df = spark.createDataFrame([(big_endian,), (None,)], "geometry binary").coalesce(1)
    assert [(r["easting"], r["northing"]) for r in features.with_point_xy(df).collect()] == [(3.0, 4.0), (None, None)]
    with pytest.raises(Exception, match="expected a point"):
        features.with_point_xy(spark.createDataFrame([(wkb,)], "geometry binary")).collect()


def test_epsg_of_documents():
    assert features.epsg_of({}) == 4326
    assert features.epsg_of({"crs": {"properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}}) == 4326
    assert features.epsg_of({"crs": {"properties": {"name": "EPSG:26910"}}}) == 26910
    with pytest.raises(ValueError, match="unknown crs"):
        features.epsg_of({"crs": {"properties": {"name": "local grid"}}})


def test_table_by_name_or_folder(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spark.range(5).createOrReplaceTempView("five")
    assert pings.scan_table(spark, str(tmp_path / "t")).count() == 3
    assert pings.scan_table(spark, "five").count() == 5


def test_feature_folders_that_are_missing_or_empty(spark, tmp_path):
    with pytest.raises(Exception, match="no feature files"):
        features.read_features(spark, str(tmp_path / "none"), "ports").collect()
    assert features.read_features(spark, str(tmp_path), "ports").count() == 0


def test_points_of_either_byte_order(spark):
    rows = [(struct.pack("<BIdd", 1, 1, 1.5, 2.5),), (None,), (struct.pack(">BIdd", 0, 1, 3.5, -4.5),)]
    found = features.with_point_xy(spark.createDataFrame(rows, "geometry binary"))
    assert {(r["easting"], r["northing"]) for r in found.collect()} == {(1.5, 2.5), (None, None), (3.5, -4.5)}
    assert features.epsg_of({"crs": None}) == 4326


def test_every_kind_of_geometry_is_encoded(spark, tmp_path):
    square, hole = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]
    kinds = {
        "Polygon": [square, hole],
        "MultiPolygon": [[square, hole], [[[9, 9], [10, 9], [9, 10], [9, 9]]]],
        "MultiPoint": [[1, 2], [3, 4]],
        "MultiLineString": [[[0, 0], [1, 1]], [[2, 2], [3, 3], [4, 4]]],
        "Circle": [1, 2, 3],
        "Point": [],
    }
    lines = [{"geometry": {"type": k, "coordinates": c}, "properties": {"kind": k}} for k, c in kinds.items()]
    lines += [{"geometry": {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}]}, "properties": {"kind": "GeometryCollection"}}]
    lines += [{"geometry": None, "properties": {"kind": "none"}}]
    (tmp_path / "all.geojsonl").write_text("\n".join(map(json.dumps, lines)))
    found = features.read_features(spark, str(tmp_path), "all")
    decoded = found.select(F.get_json_object("properties", "$.kind").alias("kind"), "geometry", features.wkb_rings("geometry").alias("rings"))
    rows = {r.kind: r for r in decoded.collect()}
    assert len(rows) == len(lines)
    assert {k for k, r in rows.items() if r.geometry is None} == {"Circle", "Point", "none"}
    assert {k for k, r in rows.items() if r.rings is not None} == {"Polygon", "MultiPolygon"}
    rings = [[[int(v.x), int(v.y)] for v in ring] for ring in rows["MultiPolygon"].rings]
    assert rings == [square, hole, [[9, 9], [10, 9], [9, 10], [9, 9]]]
    assert rows["MultiPoint"].geometry[:9] == struct.pack("<BII", 1, 4, 2) and len(rows["MultiLineString"].geometry) == 9 + 18 + 5 * 16


def test_rings_of_either_byte_order_and_broken_bytes():
    ring = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]
    big = struct.pack(">BIII", 0, 3, 1, 3) + b"".join(struct.pack(">dd", *p) for p in ring)
    assert [tuple(p) for p in features.polygon_rings(big)[0]] == ring
    assert features.polygon_rings(big[:-5]) is None and features.polygon_rings(b"") is None
    nested = struct.pack("<BII", 1, 6, 1) + big
    assert len(features.polygon_rings(nested)) == 1
    assert features.polygon_rings(struct.pack("<BII", 1, 6, 1) + struct.pack("<BIdd", 1, 1, 0, 0)) is None


@pytest.mark.parametrize("split", [1, 37, 100, 5000])
def test_line_files_are_split_without_losing_or_repeating_lines(tmp_path, split):
    lines = [json.dumps({"geometry": None, "properties": {"n": i, "pad": "ü" * (i % 40)}}, ensure_ascii=False) for i in range(60)]
    (tmp_path / "l.geojsonl").write_text("\n".join(lines) + "\n\n", encoding="utf-8")
    reader = features.FeatureReader({"path": str(tmp_path), "layer_name": "l", "split_bytes": str(split)})
    parts = reader.partitions()
    assert len(parts) == -(-(tmp_path / "l.geojsonl").stat().st_size // split)
    found = [json.loads(p)["n"] for part in parts for _, _, p in reader.read(part)]
    assert found == list(range(60))


def test_filters_on_crs_reach_the_files(spark, tmp_path):
    projected = {"properties": {"name": "EPSG:26910"}}
    lines = [{"geometry": {"type": "Point", "coordinates": [i, 1]}, "properties": {"n": i}} | ({"crs": projected} if i % 3 == 0 else {}) for i in range(30)]
    (tmp_path / "p.geojsonl").write_text("\n".join(map(json.dumps, lines)))
    found = features.read_features(spark, str(tmp_path), "p", split_bytes=300)
    assert found.rdd.getNumPartitions() > 5
    for condition, expected in (("crs = 26910", 10), ("crs IN (26910, 26911)", 10), ("crs = 4326", 20), ("crs = 4326 AND crs = 26910", 0), ("crs IS NOT NULL", 30), ("crs <> 4326", 10)):
        assert found.where(condition).count() == expected, condition
    reader = features.FeatureReader({"path": str(tmp_path), "layer_name": "p"})
    assert list(reader.pushFilters([EqualTo(("crs",), 26910), IsNotNull(("crs",))])) == [IsNotNull(("crs",))]
    parsed = []
    reader._parsed = lambda lines, own=reader._parsed: (parsed.append(x) or x for x in own(lines))
    assert len([r for part in reader.partitions() for r in reader.read(part)]) == 10 and len(parsed) == 10


def test_only_wanted_columns_are_built(spark, tmp_path):
    (tmp_path / "p.geojsonl").write_text(json.dumps({"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"n": 1}}))
    found = features.read_features(spark, str(tmp_path), "p", columns=("crs", "properties"))
    assert [tuple(r) for r in found.collect()] == [(4326, '{"n": 1}')]
    reader = features.FeatureReader({"path": str(tmp_path), "layer_name": "p", "columns": "crs"})
    assert list(reader.read(reader.partitions()[0])) == [(None, 4326, None)]
    with pytest.raises(ValueError, match="columns"):
        features.FeatureReader({"path": str(tmp_path), "layer_name": "p", "columns": "shape"})


def test_zones_must_be_in_the_expected_crs(spark, tmp_path):
    (tmp_path / "z.geojsonl").write_text(json.dumps({"geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 1]]]}, "properties": {"id": "a"}}))
    found = features.read_features(spark, str(tmp_path), "z")
    (zone,) = flows.zones_from_features(found, "id").collect()
    assert zone.zone_id == "a" and [(v.x, v.y) for v in zone.rings[0]] == [(0, 0), (1, 0), (0, 1)]
    with pytest.raises(Exception, match="expected EPSG:26910, got EPSG:4326"):
        flows.zones_from_features(found, "id", 10).collect()


@pytest.mark.parametrize("tasks", [None, 2])
def test_members_of_several_headers_are_opened_once(spark, tmp_path, monkeypatch, tasks):
    opened, own = tmp_path / "opened", archives._texts
    opened.mkdir()

    def counted(batches):
        import uuid

        for block in own(batches):
            (opened / uuid.uuid4().hex).write_text("|".join(map(str, (block.column("path")[0], block.column("member")[0]))))
            yield block

    monkeypatch.setattr(archives, "_texts", counted)
    orders = [HEADER, REORDERED.split("\n")[0], "event_id,mmsi,speed"]
    rows = {HEADER: TEXT.split("\n", 1)[1], orders[1]: REORDERED.split("\n", 1)[1], orders[2]: "7,1,9\n"}
    for i in range(4):
        archive(tmp_path / f"{i}.zip", {f"m{k}.csv": header + "\n" + rows[header] for k, header in enumerate(orders)})
    found = archives.scan_zip(spark, str(tmp_path), tasks=tasks)
    assert "speed" in found.columns
    count = found.count()
    names = [f.read_text() for f in opened.iterdir()]
    assert len(names) == len(set(names)) == 12
    assert count == 4 * sum(len([x for x in text.split("\n") if x.strip()]) for text in rows.values())
