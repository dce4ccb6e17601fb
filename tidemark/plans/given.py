"""Pings, ports, listings and input files derived by Spark from the given tables.

Every relation here grows with the tables it reads: one ping per event, one file name per document.
"""

from __future__ import annotations

import math
import zipfile
from collections.abc import Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import geo
from tidemark.operators.ports import project_ports
from tidemark.session import scratch_path
from tidemark.sources.files import open_filesystem

PING_COLUMNS = ("event_id", "mmsi", "vessel_name", "ts", "longitude", "latitude")
ROWS_PER_FILE = 50_000
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@cache
def _schema(path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is read from the file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``port_id, port_name, plon, plat, size``, one per nation."""
    key = F.col("n_nationkey")
    lon = F.lit(-124.9) + (key % 5) * F.lit(0.6)
    lat = F.lit(47.2) + F.floor(key / F.lit(5.0)).cast("int") * F.lit(0.6)
    size = (
        F.when(key == 24, F.lit(None))
        .when(key % 6 == 5, "Very Small")
        .when(key % 3 == 0, "Small")
        .when(key % 3 == 1, "Medium")
        .otherwise("Large")
    )
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("port_id"),
        F.col("n_name").alias("port_name"),
        F.when(key == 1, F.lit(-124.89)).otherwise(lon).alias("plon"),
        F.when(key == 1, F.lit(47.2)).otherwise(lat).alias("plat"),
        size.alias("size"),
    )


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ping per event, placed near a home port that changes every three days."""
    period = F.floor((F.day("ts") - 1) / F.lit(3.0)).cast("bigint")
    events = table(spark, sf_dir, "events").withColumn("_home", (F.col("user_id") * 7 + period * 3) % 25)
    homes = ports(spark, sf_dir).select(F.col("port_id").alias("_home"), "plon", "plat")
    side = F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1)
    lon = F.col("plon") + side * F.col("value") / F.lit(100.0) * F.lit(0.005)
    lat = F.col("plat") + F.col("value") / F.lit(100.0) * F.lit(0.02)
    lost = F.col("event_id") % 97 == 0
    return events.join(homes, "_home").select(
        "event_id",
        (F.col("user_id") + 366000000).alias("mmsi"),
        F.concat(F.lit("VESSEL_"), F.col("user_id").cast("string")).alias("vessel_name"),
        "ts",
        F.when(lost, F.lit(None)).otherwise(lon).alias("longitude"),
        F.when(lost, F.lit(None)).when(F.col("event_id") % 101 == 0, F.lit(95.0)).otherwise(lat).alias("latitude"),
    )


def file_listing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source and landing listings ``(name, path, length)``.

    One source file per document; the files of labelled documents have landed.
    """
    key = F.col("doc_id")
    suffix = F.when(key % 3 == 0, ".csv.zst").when(key % 3 == 1, ".zip").otherwise(".txt")
    name = F.concat(F.lit("pings-2024-"), F.lpad(key.cast("string"), 12, "0"), suffix)
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("length"))
    source = documents.select(name.alias("name"), F.concat(F.lit("/history/"), name).alias("path"), "length")
    landed = table(spark, sf_dir, "labels").select(name.alias("name"), F.concat(F.lit("/landing/"), name).alias("path"))
    return source, landed


def ping_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings in the shape of the input files: time as text with whole seconds."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("base_date_time")
    return pings(spark, sf_dir).select("event_id", "mmsi", "vessel_name", stamp, "longitude", "latitude")


def file_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of input files to write, in step with the number of pings."""
    return max(4, table(spark, sf_dir, "events").count() // ROWS_PER_FILE + 1)


def write_csv(spark: SparkSession, sf_dir: str, label: str, files: int | None = None) -> str:
    """Folder of CSV files with a header."""
    folder = scratch_path(spark, label)
    rows = ping_lines(spark, sf_dir)
    if files:
        rows = rows.repartition(files, "event_id")
    rows.write.option("header", "true").option("escape", '"').csv(folder)
    return folder


#: Column orders of the files that :func:`write_drifting_csv` writes; some lack a column, some have one more.
DRIFTING_COLUMNS = (
    ("event_id", "mmsi", "vessel_name", "base_date_time", "longitude", "latitude"),
    ("mmsi", "base_date_time", "sog", "longitude", "latitude", "event_id", "vessel_name"),
    ("latitude", "longitude", "event_id", "base_date_time", "mmsi"),
)


def write_drifting_csv(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Folder of CSV files of all pings in three column orders, dealt by ``event_id``."""
    folder = scratch_path(spark, label)
    rows = ping_lines(spark, sf_dir).withColumn("sog", F.col("event_id") % 30)
    for i, columns in enumerate(DRIFTING_COLUMNS):
        part = rows.where(F.col("event_id") % len(DRIFTING_COLUMNS) == i).select(*columns)
        part.write.option("header", "true").option("escape", '"').csv(f"{folder}/order{i}")
    return folder


def _csv_text(header: str):
    def line(row: tuple) -> str:
        return ",".join("" if v is None else repr(v) if isinstance(v, float) else str(v) for v in row)

    def render(batch: pa.RecordBatch) -> str:
        return "".join(line(row) + "\n" for row in zip(*(c.to_pylist() for c in batch.columns)))

    return header + "\n", render


def _compress(folder: str, kind: str, header: str):
    """Write each task's rows into one compressed file, batch by batch.

    The file is named after the partition, so a task that runs again replaces what it left behind.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head, render = _csv_text(header)
        stem = f"part-{TaskContext.get().partitionId():05d}"
        first = next(batches, None)
        if first is None:
            return
        filesystem, root = open_filesystem(folder)
        filesystem.create_dir(root)
        if kind == "zst":
            with filesystem.open_output_stream(f"{root}/{stem}.csv.zst", compression="zstd") as out:
                out.write((head + render(first)).encode())
                for batch in batches:
                    out.write(render(batch).encode())
        else:
            with (
                filesystem.open_output_stream(f"{root}/{stem}.zip", compression=None) as out,
                zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive,
            ):
                archive.writestr("notes.txt", "not a data member")
                for i, batch in enumerate(chain([first], batches)):
                    with archive.open(f"pings/{stem}-{i}.csv", "w") as member:
                        member.write((head + render(batch)).encode())
        yield pa.record_batch([pa.array([stem])], names=["stem"])

    return write


def write_compressed(spark: SparkSession, sf_dir: str, label: str, kind: str) -> str:
    """Folder of ``.csv.zst`` files or zip archives, about ``ROWS_PER_FILE`` pings each."""
    folder = scratch_path(spark, label)
    rows = ping_lines(spark, sf_dir)
    rows = rows.repartition(file_count(spark, sf_dir), "event_id")
    written = rows.mapInArrow(_compress(folder, kind, ",".join(rows.columns)), "stem string")
    written.write.format("noop").mode("overwrite").save()
    return folder


def _archive_features(folder: str, layer: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = next(batches, None)
        if first is None:
            return
        stem = f"part-{TaskContext.get().partitionId():05d}"
        filesystem, root = open_filesystem(folder)
        filesystem.create_dir(root)
        with (
            filesystem.open_output_stream(f"{root}/{stem}.zip", compression=None) as out,
            zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive,
            archive.open(f"{layer}.geojsonl", "w") as member,
        ):
            for batch in chain([first], batches):
                for line in batch.column(0).to_pylist():
                    member.write((line + "\n").encode())
        yield pa.record_batch([pa.array([stem])], names=["stem"])

    return write


def write_port_features(spark: SparkSession, sf_dir: str, label: str, layer: str = "ports") -> str:
    """Folder of zipped port features in the projected CRS."""
    folder = scratch_path(spark, label)
    projected = project_ports(ports(spark, sf_dir), 10)
    crs = f"urn:ogc:def:crs:EPSG::{geo.epsg_of_zone(10)}"
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("port_e", "port_n").alias("coordinates")).alias("geometry"),
        F.struct(
            F.col("port_id").cast("string").alias("OID"),
            (F.col("port_id") * 10).cast("string").alias("WPIN"),
            F.concat(F.lit("Region "), F.col("port_id") % 5).alias("REGION"),
            F.col("port_name").alias("PORT"),
            F.concat(F.lit("XX "), F.col("port_id")).alias("UN_LOCODE"),
            F.lower("port_name").alias("COUNTRY"),
            F.lit("Sea").alias("WORLD_WATE"),
            F.col("size").alias("SIZE"),
            F.when(F.col("port_id") % 2 == 0, "Coastal").alias("TYPE"),
            F.col("plat").alias("LAT"),
            F.col("plon").alias("LON"),
        ).alias("properties"),
        F.struct(F.lit("name").alias("type"), F.struct(F.lit(crs).alias("name")).alias("properties")).alias("crs"),
    )
    lines = projected.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))
    written = lines.mapInArrow(_archive_features(folder, layer), "stem string")
    written.write.format("noop").mode("overwrite").save()
    return folder


def write_zone_features(
    spark: SparkSession, sf_dir: str, label: str, radii: tuple[float, float], vertices: int, layer: str = "zones"
) -> str:
    """Folder of zipped features in the projected CRS: around each port a polygon with a hole, every second one as a
    multi-polygon, and a point and a line that are no zones."""
    folder = scratch_path(spark, label)
    projected = project_ports(ports(spark, sf_dir), 10)
    step = geo.double(2 * math.pi / vertices)
    ring = (
        f"transform(sequence(0, {vertices - 1}), i -> array(port_e + {{0}} * cos({step} * i), port_n + {{0}} * sin({step} * i)))"
    )
    rings = F.array(*[F.expr(ring.format(geo.double(radius))) for radius in radii])
    crs = F.lit(f"urn:ogc:def:crs:EPSG::{geo.epsg_of_zone(10)}")

    def lines(rows: DataFrame, kind: str, coordinates) -> DataFrame:
        feature = F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
            F.struct(F.col("port_id").cast("string").alias("OID")).alias("properties"),
            F.struct(F.lit("name").alias("type"), F.struct(crs.alias("name")).alias("properties")).alias("crs"),
        )
        return rows.select(F.to_json(feature).alias("value"))

    odd = F.col("port_id") % 2 == 1
    every = lines(projected.where(odd), "Polygon", rings).unionByName(lines(projected.where(~odd), "MultiPolygon", F.array(rings)))
    every = every.unionByName(lines(projected.limit(1), "Point", F.array("port_e", "port_n")))
    every = every.unionByName(lines(projected.limit(1), "LineString", rings[0]))
    written = every.mapInArrow(_archive_features(folder, layer), "stem string")
    written.write.format("noop").mode("overwrite").save()
    return folder
