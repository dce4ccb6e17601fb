"""Ping tables and ping CSV files, plain or zstd-compressed."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import PING_TIME_PATTERN, parse_ts
from tidemark.sources.files import open_filesystem
from tidemark.sources.listing import list_files
from tidemark.sources.schemas import CORRUPT_COLUMN, PING_FILE_SCHEMA, with_corrupt_column

CSV_GLOB = "*.{csv,csv.zst}"


def scan_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a parquet folder when the name contains a slash."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def csv_options(schema: T.StructType | None) -> dict[str, str]:
    """Reader options shared by batch, stream and archive ingest."""
    options = {"header": "true", "escape": '"', "mode": "PERMISSIVE"}
    if schema is not None and CORRUPT_COLUMN in schema.names:
        options["columnNameOfCorruptRecord"] = CORRUPT_COLUMN
        options["columnPruning"] = "false"  # count the fields of a line, whichever are selected
    return options


def header_names(line: str) -> tuple[str, ...]:
    """Column names of a header line. Nameless columns are called by their place; a name used twice is an error."""
    found = [name.strip() for name in next(csv.reader([line.lstrip("\ufeff").rstrip("\r\n")]), [])]
    names = tuple(name or f"_c{i}" for i, name in enumerate(found))
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"a column name occurs twice in header {line!r}")
    return names


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("path").to_pylist()
        lines = []
        for path in paths:
            filesystem, name = open_filesystem(path)
            compression = "zstd" if name.endswith(".zst") else None
            line = b""
            with filesystem.open_input_stream(name, compression=compression) as stream:
                while b"\n" not in line and (more := stream.read(1 << 16)):
                    line += more
            lines.append(line.split(b"\n")[0].decode("utf-8", "replace"))
        yield pa.record_batch([pa.array(paths), pa.array(lines, pa.string())], names=["path", "line"])


def files_by_header(files: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Paths of ``files`` (a column ``path``) by their header. Tasks read the first lines; empty files are left out.

    The driver gets a path and a header for each file, as it does when it lists a folder to be read.
    """
    found = defaultdict(list)
    for row in files.select("path").mapInArrow(_first_lines, "path string, line string").toLocalIterator():
        if row["line"].strip():
            found[header_names(row["line"])].append(row["path"])
    return dict(sorted(found.items()))


def named_schema(header: tuple[str, ...], schema: T.StructType, text: bool = False) -> T.StructType:
    """The columns of a header in file order: those of ``schema`` with its names and types, others as text."""
    known = {f.name.lower(): f for f in schema}
    fields = [known.get(n.lower(), T.StructField(n, T.StringType())) for n in header]
    return T.StructType([T.StructField(f.name, T.StringType() if text else f.dataType) for f in fields])


def by_name(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """All rows of the frames: the columns of ``schema``, NULL where a frame lacks one, then all others."""
    lacking = [
        df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}) for df in frames
    ]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lacking)
    last = [CORRUPT_COLUMN] if CORRUPT_COLUMN in whole.columns else []
    extra = [c for c in whole.columns if c not in schema.names and c not in last]
    return whole.select(*schema.names, *extra, *last)


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = PING_FILE_SCHEMA,
    keep_corrupt: bool = False,
    sampling_ratio: float = 1.0,
    glob: str = CSV_GLOB,
) -> DataFrame:
    """Ping files below a folder. Without a schema the types are inferred from a share of the rows.

    With a schema, columns are found by the names in each file's header, whatever their order: columns of the schema
    that a file lacks are NULL, and columns beyond the schema follow as text. Files of one header are read together.

    ``.csv.zst`` files are decoded by Spark as they are read; each is one task because the format cannot
    be split.
    """
    if schema is None:
        reader = spark.read.options(**csv_options(None)).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        return reader.option("inferSchema", "true").option("samplingRatio", str(sampling_ratio)).csv(path)
    return scan_csv_files(spark, list_files(spark, path, glob), schema, keep_corrupt)


def scan_csv_files(
    spark: SparkSession, files: DataFrame, schema: T.StructType = PING_FILE_SCHEMA, keep_corrupt: bool = False
) -> DataFrame:
    """As :func:`scan_csv`, for the files named in a listing's column ``path``."""
    frames = []
    for header, paths in files_by_header(files).items():
        named = named_schema(header, schema, text=keep_corrupt)
        as_read = with_corrupt_column(named) if keep_corrupt else named
        raw = spark.read.options(**csv_options(as_read)).schema(as_read).csv(paths)
        frames.append(_typed(raw, named_schema(header, schema)) if keep_corrupt else raw)
    empty = spark.createDataFrame([], with_corrupt_column(schema) if keep_corrupt else schema)
    return by_name(frames or [empty], schema)


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text fields; a line with a wrong number of fields or an uncastable one is kept as text.

    Spark's own corrupt-record column only looks at the selected fields, this one at all of them.
    """
    failed = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in schema]
    line = F.when(reduce(lambda a, b: a | b, failed), F.to_csv(F.struct(*schema.names)))
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema],
        F.coalesce(F.col(CORRUPT_COLUMN), line).alias(CORRUPT_COLUMN),
    )


def with_parsed_time(
    df: DataFrame, source: str = "base_date_time", target: str = "ts", pattern: str | None = PING_TIME_PATTERN
) -> DataFrame:
    """Append the parsed time; unreadable values become NULL. A column that already is a time is only cast."""
    if isinstance(df.schema[source].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(target, F.col(source).cast("timestamp_ntz"))
    return df.withColumn(target, parse_ts(F.col(source), pattern))
