"""Rows committed together with a ledger of what they came from, and pending work judged by that ledger.

A batch is a folder of rows and, written after it, a folder of ledger rows: one for each (path, member) with the number of
rows and of unreadable lines. Rows count only once their ledger stands, so a batch that broke off is as if it had never
begun, and a batch that is repeated after its ledger stands changes nothing. A member may be read again in a later batch;
its rows from the latest one replace the earlier ones. Whether a file's name exists somewhere decides nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.filesets import ingest_ledger

LEDGER_SCHEMA = "path string, member string, rows bigint, corrupt_rows bigint, batch bigint"


def read_if_any(spark: SparkSession, path: str, schema: StructType | str | None) -> DataFrame | None:
    """What is stored below a folder, or None where there is nothing."""
    try:
        reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def commit(parsed: DataFrame, root: str, batch: int) -> bool:
    """Write rows with ``path, member, corrupt_record`` as a batch; returns False if that batch had been committed before.

    ``member`` may be NULL, for plain files. The ledger is counted from the rows as they were written.
    """
    spark = parsed.sparkSession
    if not ledger(spark, root).where(F.col("batch") == batch).isEmpty():
        return False
    folder = f"{root}/rows/{batch:012d}"
    parsed.withColumn("_ledger_batch", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(folder)
    counted = ingest_ledger(spark.read.parquet(folder)).withColumn("batch", F.lit(batch).cast("bigint"))
    counted.write.mode("overwrite").parquet(f"{root}/ledger/{batch:012d}")
    return True


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """All ledger rows: ``path, member, rows, corrupt_rows, batch``. Nothing committed: no rows."""
    found = read_if_any(spark, f"{root}/ledger", LEDGER_SCHEMA)
    return spark.createDataFrame([], LEDGER_SCHEMA) if found is None else found


def latest(entries: DataFrame) -> DataFrame:
    """The ledger row of each member's last batch."""
    last = Window.partitionBy("path", "member").orderBy(F.desc("batch"))
    return entries.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").drop("_nth")


def committed_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of every member's last committed batch, or None if nothing was ever written.

    A batch holds few members beside its rows, so the ledger is joined by batch and member; a member's rows spread over
    tasks as they were written.
    """
    rows = read_if_any(spark, f"{root}/rows", None)
    if rows is None:
        return None
    valid = latest(ledger(spark, root)).select(F.col("path").alias("_path"), F.col("member").alias("_member"), F.col("batch").alias("_of"))
    same = F.col("path").eqNullSafe(F.col("_path")) & F.col("member").eqNullSafe(F.col("_member")) & (F.col("_ledger_batch") == F.col("_of"))
    return rows.join(valid, same, "left_semi").drop("_ledger_batch")


def pending_by_ledger(members: DataFrame, entries: DataFrame) -> DataFrame:
    """Members ``path, member, expected_rows`` with fewer committed rows than expected, or none; appends ``committed_rows``.

    Unreadable lines count as committed, as they are kept. A NULL ``expected_rows`` asks for any committed batch.
    """
    done = latest(entries).select(F.col("path").alias("_path"), F.col("member").alias("_member"), F.col("rows").alias("committed_rows"))
    same = F.col("path").eqNullSafe(F.col("_path")) & F.col("member").eqNullSafe(F.col("_member"))
    judged = members.join(done, same, "left").drop("_path", "_member")
    return judged.where(F.col("committed_rows").isNull() | (F.col("committed_rows") < F.col("expected_rows")))
