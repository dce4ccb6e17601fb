"""Declared schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "corrupt_record"

PING_FILE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("mmsi", T.LongType()),
        T.StructField("vessel_name", T.StringType()),
        T.StructField("base_date_time", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
    ]
)


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """The schema plus the column that receives lines which do not fit it."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
