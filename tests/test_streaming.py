from __future__ import annotations

import uuid

import pytest

from tidemark.sources.schemas import PING_FILE_SCHEMA
from tidemark.streaming import ingest

HEADER = "event_id,mmsi,vessel_name,base_date_time,longitude,latitude\n"


def write(folder, name, ids):
    rows = "".join(f"{i},3660{i:05d},V{i},2024-03-01T00:00:{i % 60:02d},-123.4,48.6\n" for i in ids)
    (folder / name).write_text(HEADER + rows)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


@pytest.fixture
def target(tmp_path):
    return {"checkpoint": str(tmp_path / "checkpoint"), "table": f"s_{uuid.uuid4().hex}", "path": str(tmp_path / "out")}


def ids(spark, target):
    return sorted(r["event_id"] for r in spark.table(target["table"]).select("event_id").collect())


def test_only_new_files_are_added(spark, landing, target):
    write(landing, "a.csv", range(3))
    ingest.ingest(ingest.read_stream(spark, str(landing)), **target)
    assert ids(spark, target) == [0, 1, 2]
    ingest.ingest(ingest.read_stream(spark, str(landing)), **target)
    assert ids(spark, target) == [0, 1, 2]
    write(landing, "b.csv", range(3, 5))
    (landing / "c.zip").write_bytes(b"not a csv")
    ingest.ingest(ingest.read_stream(spark, str(landing)), **target)
    spark.catalog.refreshTable(target["table"])
    assert ids(spark, target) == [0, 1, 2, 3, 4]


def test_rate_limit_makes_one_batch_per_file(spark, landing, target):
    for i in range(3):
        write(landing, f"{i}.csv", [i])
    query = ingest.ingest(ingest.read_stream(spark, str(landing), max_files_per_trigger=1), **target, spatial=False)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert ids(spark, target) == [0, 1, 2]


def test_spatial_columns_can_be_left_out(spark, landing, target):
    write(landing, "a.csv", [1])
    ingest.ingest(ingest.read_stream(spark, str(landing)), **target, spatial=False)
    assert spark.table(target["table"]).columns == [*PING_FILE_SCHEMA.names, "event_ts"]


def test_enriched_stream_equals_enriched_batch(spark, landing, target):
    write(landing, "a.csv", range(5))
    ingest.ingest(ingest.read_stream(spark, str(landing)), **target)
    from tidemark.sources.pings import scan_csv, with_parsed_time

    batch = ingest.enriched(with_parsed_time(scan_csv(spark, str(landing)), target="event_ts"))
    assert sorted(spark.table(target["table"]).collect()) == sorted(batch.collect())


def test_unreadable_time_becomes_null(spark, landing, target):
    (landing / "a.csv").write_text(HEADER + "1,2,V,not a time,-123.4,48.6\n")
    ingest.ingest(ingest.read_stream(spark, str(landing)), **target, spatial=False)
    assert spark.table(target["table"]).first()["event_ts"] is None


def test_schema_is_inferred_once(spark, landing, tmp_path):
    write(landing, "a.csv", [1])
    location = str(tmp_path / "schema")
    first = ingest.stored_schema(spark, str(landing), location)
    assert {f.dataType.simpleString() for f in first} == {"string"}
    (landing / "b.csv").write_text("another,header\n1,2\n")
    assert ingest.stored_schema(spark, str(landing), location) == first
    typed = ingest.stored_schema(spark, str(landing), str(tmp_path / "typed"), infer_types=True)
    assert typed != first


def test_read_files_can_be_archived(spark, landing, target, tmp_path):
    archive = tmp_path / "archive"
    write(landing, "a.csv", [1])
    ingest.ingest(ingest.read_stream(spark, str(landing), archive_dir=str(archive)), **target, spatial=False)
    write(landing, "b.csv", [2])
    ingest.ingest(ingest.read_stream(spark, str(landing), archive_dir=str(archive)), **target, spatial=False)
    assert ids(spark, target) == [1, 2]


def by_name(spark, landing, tmp_path, **options):
    return ingest.ingest_by_name(spark, str(landing), str(tmp_path / "checkpoint"), str(tmp_path / "rows"), **options)


def test_a_file_keeps_its_own_batch_column(spark, landing, tmp_path):
    (landing / "a.csv").write_text("event_id,batch,_Batch2\n1,seven,x\n")
    rows = by_name(spark, landing, tmp_path)
    assert [(r["event_id"], r["batch"], r["_Batch2"]) for r in rows.collect()] == [(1, "seven", "x")]
    (landing / "b.csv").write_text("batch,event_id\neight,2\n")
    assert {(r["event_id"], r["batch"]) for r in by_name(spark, landing, tmp_path).collect()} == {(1, "seven"), (2, "eight")}


@pytest.mark.parametrize("table", [False, True])
def test_an_empty_landing_gives_an_empty_table(spark, landing, tmp_path, table):
    name = f"s_{uuid.uuid4().hex}" if table else None
    rows = by_name(spark, landing, tmp_path, table=name, time_column="base_date_time", spatial=True)
    assert rows.count() == 0 and {"event_id", "event_ts", "is_valid_geom", "corrupt_record"} <= set(rows.columns)
    write(landing, "a.csv", [4])
    assert [r["event_id"] for r in by_name(spark, landing, tmp_path, table=name, time_column="base_date_time", spatial=True).collect()] == [4]


def test_extra_columns_are_typed_once_and_added_to_the_table(spark, landing, tmp_path):
    options = {"table": f"s_{uuid.uuid4().hex}", "time_column": "base_date_time", "typed": True}
    write(landing, "a.csv", [1])
    assert "sog" not in by_name(spark, landing, tmp_path, **options).columns
    (landing / "b.csv").write_text("sog,note,event_id,seen\n5,abc,2,2024-01-01 00:00:00\n6,,3,\n")
    kinds = dict(by_name(spark, landing, tmp_path, **options).dtypes)
    assert (kinds["sog"], kinds["note"], kinds["seen"]) == ("bigint", "string", "timestamp_ntz")
    (landing / "c.csv").write_text("event_id,SOG\n4,fast\n5,9\n")
    rows = {r["event_id"]: r for r in by_name(spark, landing, tmp_path, **options).collect()}
    assert {i: r["sog"] for i, r in rows.items()} == {1: None, 2: 5, 3: 6, 4: None, 5: 9}
    assert rows[1]["event_ts"] is not None and rows[2]["note"] == "abc"
    assert by_name(spark, landing, tmp_path, **options).count() == 5


def test_a_repeated_batch_reads_the_log_before_it(spark, tmp_path):
    from tidemark.streaming import schema_log

    log = str(tmp_path / "log")
    assert schema_log.logged(spark, log) == []
    schema_log.add(spark, log, 3, {"a": "bigint", "b b": "string"})
    schema_log.add(spark, log, 5, {"c": "double"})
    schema_log.add(spark, log, 5, {"c": "double", "d": "string"})
    assert [f.name for f in schema_log.logged(spark, log)] == ["a", "b b", "c", "d"]
    assert [f.name for f in schema_log.logged(spark, log, 5)] == ["a", "b b"]
