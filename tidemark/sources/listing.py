"""File listings as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

LISTING_COLUMNS = "path string, name string, length bigint, modification_time timestamp"


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """``path, name, length, modification_time`` of every file below a folder; file contents are not read.

    A folder that does not exist lists as empty. Any other failure is raised.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_COLUMNS)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )


def with_rows(files: DataFrame, rows: DataFrame) -> DataFrame:
    """``table, files, rows``: how many files of each table are listed, and the rows read from them.

    ``files`` has ``table, path``; ``rows`` has ``path, rows`` of the files that were read. Paths are compared from
    the table's name on, as listings and readers may spell a scheme differently. A file without rows counts with 0.
    """
    short = lambda path: F.regexp_extract(path, r"([^/]+\.parquet(?:/.*)?)$", 1)
    counted = rows.select(short("path").alias("_read"), "rows")
    joined = files.join(counted, short("path") == F.col("_read"), "left")
    return joined.groupBy("table").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
