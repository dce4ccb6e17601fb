from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geo, hexgrid
from tidemark.sinks import tables

SCHEMA = "id bigint, day int, longitude double, latitude double, hex_res9 bigint"
USABLE = lambda: geo.is_valid_lonlat(F.col("longitude"), F.col("latitude"))


def cells(df):
    return hexgrid.add_cells(df, (9,))


def stored(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_backfill_touches_only_partitions_with_work(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, 1, -123.4, 48.6, None), (2, 1, -123.4, 48.6, 77), (3, 2, -123.4, 48.6, 88), (4, 3, None, 48.6, None), (5, None, -123.4, 48.6, None)]
    df = stored(spark, path, rows)
    before = files(path)
    once = tables.backfill(df, cells, ("hex_res9",), USABLE(), path, "day")
    after = files(path)
    assert {os.path.basename(os.path.dirname(f)) for f in before - after} == {"day=1", "day=__HIVE_DEFAULT_PARTITION__"}
    values = {r["id"]: r["hex_res9"] for r in once.collect()}
    assert (values[2], values[3], values[4]) == (77, 88, None)
    assert values[1] == values[5] is not None
    again = tables.backfill(spark.read.parquet(path), cells, ("hex_res9",), USABLE(), path, "day")
    assert files(path) == after
    assert {r["id"]: r["hex_res9"] for r in again.collect()} == values


def test_publish_can_read_what_it_replaces(spark, tmp_path):
    root, view = str(tmp_path / "v"), f"v_{uuid.uuid4().hex}"
    tables.publish_version(spark.range(5).toDF("id"), root, view)
    for _ in range(2):
        tables.publish_version(spark.table(view).withColumn("id", F.col("id") + 1), root, view)
    assert sorted(r["id"] for r in spark.table(view).collect()) == [2, 3, 4, 5, 6]


def test_replace_changes_the_schema(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    tables.replace_table(spark.range(3).toDF("a"), name, str(tmp_path / "t"))
    got = tables.replace_table(spark.createDataFrame([("x",)], "b string"), name, str(tmp_path / "t"))
    assert got.columns == ["b"] and got.count() == 1


def test_missing_columns_are_added_once(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    tables.replace_table(spark.range(3).toDF("Id"), name, str(tmp_path / "t"))
    assert tables.add_missing_columns(spark, name, {"id": "bigint", "flag": "boolean"}) == ["flag"]
    assert tables.add_missing_columns(spark, name, {"id": "bigint", "flag": "boolean"}) == []
    assert [tuple(r) for r in spark.table(name).orderBy("Id").collect()] == [(0, None), (1, None), (2, None)]


def test_morton_key_interleaves_bits(spark):
    rows = [(-180.0, -90.0), (180.0, -90.0), (-180.0, 90.0), (180.0, 90.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "lon double, lat double").coalesce(1)
    got = [r[0] for r in df.select(tables.morton_key(F.col("lon"), F.col("lat"))).collect()]
    assert got == [0, 0x55555555, 0xAAAAAAAA, 0xFFFFFFFF, None]


def test_clustered_files_split_a_crowded_position(spark, tmp_path):
    crowd = spark.range(30_000).select("id", F.lit(-123.4).alias("longitude"), F.lit(48.6).alias("latitude"))
    spread = spark.range(30_000, 45_000).select("id", (F.col("id") % 300 - 150.0).alias("longitude"), (F.col("id") % 120 - 60.0).alias("latitude"))
    path = str(tmp_path / "z")
    out = tables.write_clustered(crowd.union(spread), path, files=8)
    assert out.count() == 45_000
    sizes = [r["n"] for r in out.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 45_000 / 8
    boxes = out.groupBy(F.input_file_name()).agg((F.max("longitude") - F.min("longitude")).alias("w"), (F.max("latitude") - F.min("latitude")).alias("h"))
    assert any(r["w"] < 200 and r["h"] < 100 for r in boxes.collect())


PARTS = "id bigint, longitude double, latitude double, hex_res9 bigint, part string"


def partitioned(spark, tmp_path, rows):
    table = f"t_{uuid.uuid4().hex}"
    tables.replace_table(spark.createDataFrame(rows, PARTS), table, str(tmp_path / "t"), ("part",))
    return table


def state(spark, table):
    spark.catalog.refreshTable(table)
    return {r["id"]: (r["hex_res9"], r["part"]) for r in spark.table(table).collect()}


AWKWARD = [
    (1, -123.4, 48.6, None, "a b/c"), (2, -123.4, 48.6, 77, "a b/c"), (3, -123.4, 48.6, 88, "full"), (4, None, 48.6, None, "nothing"),
    (5, -123.4, 48.6, None, None), (6, -123.4, 48.6, None, "it's 100%=\u00fc"),
]


def test_staged_backfill_switches_partitions_with_work(spark, tmp_path):
    table = partitioned(spark, tmp_path, AWKWARD)
    before = files(tmp_path)
    moved = tables.backfill_table(spark, table, cells, ("hex_res9",), USABLE(), "part")
    assert len(moved) == 3 and before <= files(tmp_path)
    after = state(spark, table)
    assert after[1][0] == after[5][0] == after[6][0] is not None and {i: after[i][0] for i in (2, 3, 4)} == {2: 77, 3: 88, 4: None}
    assert {i: p for i, (_, p) in after.items()} == {r[0]: r[4] for r in AWKWARD}
    assert tables.backfill_table(spark, table, cells, ("hex_res9",), USABLE(), "part") == []
    assert state(spark, table) == after


def test_a_killed_backfill_leaves_all_old_rows(spark, tmp_path, monkeypatch):
    table = partitioned(spark, tmp_path, AWKWARD)
    before = state(spark, table)

    def dies(df):
        return cells(df).withColumn("hex_res9", F.when(F.col("id") == 5, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("hex_res9")))

    with pytest.raises(Exception, match="killed"):
        tables.backfill_table(spark, table, dies, ("hex_res9",), USABLE(), "part")
    assert state(spark, table) == before
    # killed after the first of three partitions was switched
    kind, own, calls = type(spark), type(spark).sql, []

    def stops(self, query, *args, **options):
        if query.startswith("ALTER TABLE"):
            calls.append(query)
            if len(calls) > 1:
                raise RuntimeError("killed")
        return own(self, query, *args, **options)

    monkeypatch.setattr(kind, "sql", stops)
    with pytest.raises(RuntimeError, match="killed"):
        tables.backfill_table(spark, table, cells, ("hex_res9",), USABLE(), "part")
    monkeypatch.undo()
    between = state(spark, table)
    assert between.keys() == before.keys() and sum(between[i] != before[i] for i in before) == 1
    assert len(tables.backfill_table(spark, table, cells, ("hex_res9",), USABLE(), "part")) == 2
    assert all(state(spark, table)[i][0] is not None for i in (1, 5, 6))


def test_schemas_are_created_once(spark):
    name = f"s_{uuid.uuid4().hex}"
    for _ in range(2):
        tables.create_schema(spark, name)
    spark.range(2).write.saveAsTable(f"{name}.numbers")
    assert spark.table(f"{name}.numbers").count() == 2
    spark.sql(f"DROP SCHEMA {name} CASCADE")
