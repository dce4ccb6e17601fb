"""Table writes: replace, publish, schema evolution, back-fill, clustered layout."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import put_aside
from tidemark.session import scratch_path

MORTON_BITS = 16


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def replace_table(df: DataFrame, table: str, path: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Re-create a parquet table, schema included.

    The new rows are written beside the old ones before the name is given to them, so ``df`` may read the table
    itself, and nothing is lost if the write fails. Old rows stay below ``path`` until :func:`drop_old_versions`.
    """
    spark = df.sparkSession
    version = _write_version(df, path or scratch_path(spark, "table"), partition_by)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(version).schema)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts} LOCATION '{version}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def _write_version(df: DataFrame, root: str, partition_by: tuple[str, ...]) -> str:
    """Write ``df`` to a folder of its own below ``root``, beside whatever ``df`` reads; returns the folder."""
    version = f"{root}/v-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    return version


def drop_old_versions(spark: SparkSession, root: str, keep: DataFrame) -> list[str]:
    """Delete the versions below ``root`` that hold none of the files ``keep`` reads; returns the folders deleted.

    Only folders named like versions are touched. Readers of an older version must have ended.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    filesystem = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    used = [f for f in keep.inputFiles()]
    found = [s.getPath() for s in filesystem.listStatus(hadoop) if s.isDirectory() and s.getPath().getName().startswith("v-")]
    old = [p for p in found if not any(f"/{p.getName()}/" in f for f in used)]
    for path in old:
        filesystem.delete(path, True)
    return [p.getName() for p in old]


def publish_version(
    df: DataFrame, root: str, view: str, partition_by: tuple[str, ...] = (), durable: bool = False
) -> DataFrame:
    """Write a new version next to the older ones, then point the view at it.

    ``df`` may read the current version: nothing it depends on is overwritten, and readers see either the
    old or the complete new version. A ``durable`` view is kept in the catalog and seen by every session.
    """
    spark = df.sparkSession
    version = _write_version(df, root, partition_by)
    if durable:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{version}`")
        return spark.table(view)
    published = spark.read.parquet(version)
    published.createOrReplaceTempView(view)
    return published


def add_missing_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> list[str]:
    """Add the columns the table lacks (name to type, matched without regard to case); returns those added."""
    present = {c.lower() for c in spark.table(table).columns}
    missing = {c: t for c, t in columns.items() if c.lower() not in present}
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in missing.items())})")
    return list(missing)


def filled(df: DataFrame, compute: Callable[[DataFrame], DataFrame], columns: tuple[str, ...]) -> DataFrame:
    """Fill NULLs of ``columns`` with what ``compute`` puts there, leaving values that are already present."""
    kept = {f"_kept_{c}": F.col(c) for c in columns}
    computed = compute(df.withColumns(kept).drop(*columns))
    merged = computed.withColumns({c: F.coalesce(F.col(f"_kept_{c}"), F.col(c)) for c in columns})
    return merged.select(*df.columns)


def backfill(
    df: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    columns: tuple[str, ...],
    when: Column,
    path: str,
    partition_by: str,
) -> DataFrame:
    """Fill NULLs in a partitioned parquet folder, rewriting only partitions that have something to fill.

    ``when`` tells which rows have a value at all; others stay NULL and do not cause a rewrite. The driver
    only sees the names of the partitions to rewrite, which then prune the second scan.
    """
    empty = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    touched = [row[0] for row in df.filter(empty & when).select(partition_by).distinct().collect()]
    if not touched:
        return df
    chosen = F.col(partition_by).isin([value for value in touched if value is not None])
    if None in touched:
        chosen = chosen | F.col(partition_by).isNull()
    (
        filled(df.filter(chosen), compute, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0].rstrip("/")


def backfill_table(
    spark: SparkSession,
    table: str,
    compute: Callable[[DataFrame], DataFrame],
    columns: tuple[str, ...],
    when: Column,
    partition_by: str,
) -> list[str]:
    """Fill NULLs in a partitioned parquet table without overwriting anything; returns the new folders.

    Partitions that have something to fill are found by a join and written, filled, to a folder of their own beside the
    table's. Only when that write has committed is each partition pointed at its new folder, so a crash before leaves the
    table as it was, and a crash between two partitions leaves each of them either old or new; running again goes on with
    the rest. Folders that partitions have left stay until they are deleted by hand. ``when`` is as for :func:`backfill`.
    """
    rows = spark.table(table)
    empty = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    touched = rows.filter(empty & when).select(F.col(partition_by).alias("_touched")).distinct()
    chosen = rows.join(touched, F.col(partition_by).eqNullSafe(F.col("_touched")), "left_semi")
    version = _write_version(filled(chosen, compute, columns), f"{_location(spark, table)}-filled", (partition_by,))
    written = spark.read.schema(rows.schema).parquet(version)
    folders = written.groupBy(partition_by).agg(F.min("_metadata.file_path").alias("file"))
    moved = []
    for value, file in folders.collect():  # a row for each partition, as in the catalog
        folder = unquote(file).rpartition("/")[0]
        literal = "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {table} PARTITION (`{partition_by}` = {literal}) SET LOCATION '{folder}'")
        moved.append(folder)
    spark.catalog.refreshTable(table)
    return moved


def _spread_bits(value: Column) -> Column:
    """Insert a zero bit before each of the low 16 bits (fixed masks)."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return value


def morton_key(lon: Column, lat: Column) -> Column:
    """Interleaved bits of the position in the longitude/latitude rectangle; NULL without coordinates."""
    top = (1 << MORTON_BITS) - 1

    def grid(value: Column, low: float, width: float) -> Column:
        scaled = F.floor((value - F.lit(low)) / F.lit(width) * F.lit(float(top)))
        return F.when(value.isNotNull(), F.least(F.greatest(scaled, F.lit(0)), F.lit(top)).cast("bigint"))

    return _spread_bits(grid(lon, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread_bits(grid(lat, -90.0, 180.0)), 1))


def write_clustered(
    df: DataFrame, path: str, files: int | None = None, lon: str = "longitude", lat: str = "latitude"
) -> DataFrame:
    """Write parquet so that nearby points share files and row groups.

    Ranges are cut on (key, row hash): a position holding a large share of all rows is spread over
    several files instead of filling one.
    """
    df, now, back = put_aside(df, "_[zh]")
    keyed = df.withColumns({"_z": morton_key(F.col(now(lon)), F.col(now(lat))), "_h": F.xxhash64(*df.columns)})
    ranges = keyed.repartitionByRange(files, "_z", "_h") if files else keyed.repartitionByRange("_z", "_h")
    back(ranges.sortWithinPartitions("_z").drop("_z", "_h")).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
