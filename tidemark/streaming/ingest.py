"""Incremental ingest of ping files with Structured Streaming."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import geo, hexgrid
from tidemark.functions.columns import put_aside
from tidemark.sources.pings import CSV_GLOB, csv_options, scan_csv_files, with_parsed_time
from tidemark.sinks.ledger import read_if_any
from tidemark.sinks.tables import add_missing_columns
from tidemark.sources.schemas import PING_FILE_SCHEMA, with_corrupt_column
from tidemark.streaming import schema_log

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stored_schema(spark: SparkSession, landing: str, location: str, infer_types: bool = False) -> T.StructType:
    """Schema of the landing files: taken from ``location``, or inferred once and kept there.

    Without type inference every column is text and only the header is looked at.
    """
    try:
        kept = spark.read.text(location).first()["value"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        reader = spark.read.options(**csv_options(None)).option("pathGlobFilter", CSV_GLOB)
        reader = reader.option("recursiveFileLookup", "true").option("inferSchema", str(infer_types).lower())
        kept = reader.csv(landing).schema.json()
        spark.createDataFrame([(kept,)], "value string").coalesce(1).write.text(location)
    return T.StructType.fromJson(json.loads(kept))


def read_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType = PING_FILE_SCHEMA,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Unbounded DataFrame over ping files as they land. A file whose header differs from ``schema`` ends the query.

    :func:`ingest_by_name` takes files of any column order instead.

    ``max_files_per_trigger`` releases files gradually; ``archive_dir`` moves files away once read.
    """
    reader = spark.readStream.schema(schema).options(**csv_options(schema)).option("pathGlobFilter", CSV_GLOB)
    reader = reader.option("enforceSchema", "false")
    reader = reader.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.csv(landing)


def ingest_by_name(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    path: str,
    schema: T.StructType = PING_FILE_SCHEMA,
    max_files_per_trigger: int | None = None,
    keep_corrupt: bool = True,
    table: str | None = None,
    time_column: str | None = None,
    pattern: str | None = None,
    spatial: bool = False,
    resolutions: tuple[int, ...] = hexgrid.INGEST_RESOLUTIONS,
    typed: bool = False,
) -> DataFrame:
    """Append the landing files not seen yet to a parquet folder, columns found by each file's header; returns it.

    The stream carries file names only. Each batch's files are read as :func:`scan_csv` reads them, so reordered,
    missing and added columns are handled by name, and written to a folder of their own, which a repeated batch replaces.
    Columns beyond the schema are logged beside the checkpoint when they first appear: as text, or ``typed`` once by the
    values of that batch. With ``table``, the folder is registered under that name and gets every new column.

    ``time_column`` is parsed to ``event_ts``, ``spatial`` appends point, validity and cells. An empty landing folder
    gives an empty table. Columns of the files may have any name.
    """
    names = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", CSV_GLOB)
    names = names.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        names = names.option("maxFilesPerTrigger", str(max_files_per_trigger))
    log = f"{checkpoint.rstrip('/')}-columns"
    base = with_corrupt_column(schema) if keep_corrupt else schema

    def prepared(rows: DataFrame) -> DataFrame:
        rows = with_parsed_time(rows, time_column, "event_ts", pattern) if time_column else rows
        return enriched(rows, resolutions) if spatial else rows

    def append(files: DataFrame, batch: int) -> None:
        session = files.sparkSession
        rows = scan_csv_files(session, files, schema, keep_corrupt)
        known = schema_log.logged(session, log, batch)
        seen = {f.name.lower() for f in [*base, *known]}
        fresh = [c for c in rows.columns if c.lower() not in seen]
        if fresh:
            types = schema_log.chosen_types(rows, fresh) if typed else dict.fromkeys(fresh, "string")
            schema_log.add(session, log, batch, types)
            known = schema_log.logged(session, log, batch + 1)
        present = {c.lower(): c for c in rows.columns}
        later = {f.name: F.col(f"`{present[f.name.lower()]}`").try_cast(f.dataType) for f in known if f.name.lower() in present}
        rows = rows.select(*[F.col(f"`{c.name}`") for c in base], *[column.alias(name) for name, column in later.items()])
        prepared(rows).write.mode("overwrite").parquet(f"{path}/batch-{batch:012d}")

    query = (
        names.load(landing)
        .select("path")
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    known = schema_log.logged(spark, log)
    stored_as = prepared(spark.createDataFrame([], T.StructType([*base, *known]))).schema
    if table:
        return _registered(spark, table, path, stored_as)
    found = read_if_any(spark, path, stored_as)
    return spark.createDataFrame([], stored_as) if found is None else found


def _registered(spark: SparkSession, table: str, path: str, schema: T.StructType) -> DataFrame:
    """The folder as a table with the schema's columns; columns that came later stand last."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION '{path}'")
    add_missing_columns(spark, table, {f.name: f.dataType.simpleString() for f in schema})
    spark.catalog.refreshTable(table)
    return spark.table(table)


def enriched(
    pings: DataFrame,
    resolutions: tuple[int, ...] = hexgrid.INGEST_RESOLUTIONS,
    lon: str = "longitude",
    lat: str = "latitude",
) -> DataFrame:
    """Append point, validity and cells; usable on batch and streaming input alike."""
    pings, now, back = put_aside(pings, "_lon|_lat")
    x, y = F.col(now(lon)).try_cast("double"), F.col(now(lat)).try_cast("double")
    located = pings.withColumns({"point_geom": geo.point(x, y), "is_valid_geom": geo.is_valid_lonlat(x, y)})
    located = hexgrid.add_cells(located.withColumns({"_lon": x, "_lat": y}), resolutions, "_lon", "_lat")
    return back(located.drop("_lon", "_lat"))


def ingest(
    stream: DataFrame,
    checkpoint: str,
    table: str,
    path: str | None = None,
    time_column: str = "base_date_time",
    spatial: bool = True,
    resolutions: tuple[int, ...] = hexgrid.INGEST_RESOLUTIONS,
    pattern: str | None = None,
) -> StreamingQuery:
    """Append everything available to a table and wait for the end.

    The checkpoint remembers which files are done, so running again adds only new files.
    """
    prepared = with_parsed_time(stream, time_column, "event_ts", pattern)
    if spatial:
        prepared = enriched(prepared, resolutions)
    writer = (
        prepared.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if path:
        writer = writer.option("path", path)
    query = writer.toTable(table)
    query.awaitTermination()
    return query
