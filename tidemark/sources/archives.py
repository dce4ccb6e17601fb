"""CSV members of zip archives.

Spark lists the archives, spreads (archive, member) pairs over tasks by size, and each task streams its member's
text in blocks; the JVM cuts and parses the lines with the same options as plain CSV. Nothing is extracted to disk
and no member is held in memory as a whole. Member names are data, never paths.
"""

from __future__ import annotations

import codecs
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path
from tidemark.sources.files import open_filesystem
from tidemark.sources.listing import list_files
from tidemark.sources.pings import by_name, csv_options, header_names, named_schema
from tidemark.sources.schemas import CORRUPT_COLUMN, PING_FILE_SCHEMA, with_corrupt_column

CHUNK_BYTES = 4 << 20

_MEMBER_FIELDS = pa.schema([("path", pa.string()), ("member", pa.string()), ("member_bytes", pa.int64()), ("header", pa.string())])
_TEXT_FIELDS = pa.schema([("path", pa.string()), ("member", pa.string()), ("header", pa.string()), ("text", pa.string())])


def _header_line(archive: zipfile.ZipFile, member: str) -> str:
    with archive.open(member) as stream:
        return stream.readline().decode("utf-8-sig", "replace").rstrip("\r\n")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            filesystem, name = open_filesystem(path)
            with filesystem.open_input_file(name) as handle, zipfile.ZipFile(handle) as archive:
                csvs = [m for m in archive.infolist() if m.filename.endswith(".csv")]
                found = [(path, m.filename, m.file_size, _header_line(archive, m.filename)) for m in csvs]
            columns = list(zip(*found)) or [(), (), (), ()]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _MEMBER_FIELDS)], schema=_MEMBER_FIELDS)


def _text_blocks(stream) -> Iterator[str]:
    """A stream's text in blocks of whole lines."""
    decode = codecs.getincrementaldecoder("utf-8-sig")(errors="replace").decode
    rest = ""
    while chunk := stream.read(CHUNK_BYTES):
        block, cut, tail = (rest + decode(chunk)).rpartition("\n")
        if cut:
            yield block
        rest = tail
    rest += decode(b"", final=True)
    if rest:
        yield rest


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member's text behind its header line, in blocks; the JVM cuts the lines."""
    for batch in batches:
        for path, member, header in zip(*(batch.column(c).to_pylist() for c in ("path", "member", "header"))):
            filesystem, name = open_filesystem(path)
            with filesystem.open_input_file(name) as handle, zipfile.ZipFile(handle) as archive, archive.open(member) as stream:
                stream.readline()
                for block in _text_blocks(stream):
                    yield pa.record_batch([pa.array([x], pa.string()) for x in (path, member, header, block)], schema=_TEXT_FIELDS)


def list_members(spark: SparkSession, folder: str) -> DataFrame:
    """``path, member, member_bytes, header`` of the CSV members of every zip archive below a folder."""
    archives = list_files(spark, folder, "*.zip").select("path")
    return archives.mapInArrow(_members, "path string, member string, member_bytes bigint, header string")


def dealt_members(members: DataFrame, tasks: int | None = None) -> DataFrame:
    """``members`` (kept, as it is read more than once) in partitions of about equal bytes, one for each if not told.

    Members are numbered by size and dealt in turn, forwards and backwards, so that a partition's large members
    stand with small ones. The number of partitions is explicit, which adaptive execution leaves alone.
    """
    tasks = tasks or max(1, members.count())
    place = F.row_number().over(Window.orderBy(F.desc("member_bytes"), "path", "member")) - 1  # a row per member
    lap, seat = F.floor(place / tasks), place % tasks
    dealt = members.withColumn("_part", F.when(lap % 2 == 0, seat).otherwise(tasks - 1 - seat).cast("int"))
    return dealt.repartitionById(tasks, F.col("_part")).drop("_part")


def scan_zip(
    spark: SparkSession, folder: str, schema: T.StructType = PING_FILE_SCHEMA, tasks: int | None = None
) -> DataFrame:
    """Rows of all CSV members, with ``path, member`` and ``corrupt_record`` for lines that do not fit.

    Columns are found by the names in each member's header; those that a member lacks are NULL, and others than the
    schema's follow as text. Every member is decoded once; ``tasks`` are shared out among the orders of columns.
    """
    listing = scratch_path(spark, "members")
    list_members(spark, folder).write.parquet(listing)
    members = spark.read.parquet(listing).where(F.trim("header") != "")
    headers = members.groupBy("header").count().orderBy("header").collect()  # a row for each order of columns
    total, frames = sum(r["count"] for r in headers), []
    for header, many in headers:
        # members are chosen by header before they are dealt, so each is opened once whatever the headers
        own = members.where(F.col("header") == header)
        share = many if tasks is None else max(1, tasks * many // total)
        texts = dealt_members(own, share).mapInArrow(_texts, "path string, member string, header string, text string")
        lines = texts.select("path", "member", F.explode(F.split("text", "\r?\n")).alias("line"))
        lines = lines.withColumn("line", F.rtrim("line", F.lit("\r"))).where("line <> ''")
        full = with_corrupt_column(named_schema(header_names(header), schema))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
        parsed = lines.select("path", "member", F.from_csv("line", ddl, csv_options(full) | {"header": "false"}).alias("r"))
        frames.append(parsed.select("path", "member", "r.*"))
    place = T.StructType([T.StructField("path", T.StringType()), T.StructField("member", T.StringType())])
    whole = T.StructType([*place, *schema])
    return by_name(frames or [spark.createDataFrame([], with_corrupt_column(whole))], whole)
