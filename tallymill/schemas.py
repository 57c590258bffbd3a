"""Declared schemas. Raw records are all strings, so bad values stay visible to the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Field names of the two published layouts of a count record, in file order.
STREAM_FIELDS = ["Wave", "SiteID", "Date", "Weather", "Time", "Day", "Round", "Direction", "Path", "Mode", "Count"]
BATCH_FIELDS = ["Year", "UnqID", "Date", "Weather", "Time", "Day", "Round", "Dir", "Path", "Mode", "Count"]


def string_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in fields])


RAW_STREAM = string_schema(STREAM_FIELDS)
RAW_BATCH = string_schema(BATCH_FIELDS)

# Columns of a message, as the connector names them.
MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)

# Columns of the published table of locations.
LOCATION = T.StructType(
    [
        T.StructField("site_id", T.StringType()),
        T.StructField("location_description", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("functional_area_for_monitoring", T.StringType()),
        T.StructField("road_type", T.StringType()),
        T.StructField("old_site_id_legacy", T.StringType()),
        T.StructField("easting_uk_grid", T.DoubleType()),
        T.StructField("northing_uk_grid", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)


def to_batch_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(STREAM_FIELDS, BATCH_FIELDS)))


def to_stream_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(BATCH_FIELDS, STREAM_FIELDS)))
