"""Schemas of the stored layers."""

from pyspark.sql import types as T

from forumlake.constants import RAW_FIELDS

_TYPES = {"bigint": T.LongType(), "string": T.StringType(), "timestamp": T.TimestampType()}

# Parsed items; ingest_date is the partition column and stays a string.
SILVER = T.StructType(
    [T.StructField(name, _TYPES[kind]) for name, kind in RAW_FIELDS.values()]
    + [
        T.StructField("ingest_date_str", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingest_date", T.StringType()),
    ]
)

# Files and bytes last seen per landed day; one row per day and run.
DAY_STATE = T.StructType(
    [
        T.StructField("ingest_date", T.StringType()),
        T.StructField("file_count", T.LongType()),
        T.StructField("total_bytes", T.LongType()),
        T.StructField("run_id", T.LongType()),
    ]
)

# Landed files a run has parsed; all files of a day per run.
FILE_STATE = T.StructType(
    [
        T.StructField("ingest_date", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("run_id", T.LongType()),
    ]
)

# Look-ups that failed, and later look-ups of the same ids; one row per id and attempt.
LOOKUP_STATE = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Highest item id landed; one row per run.
HIGH_WATER_MARK = T.StructType([T.StructField("last_id", T.LongType())])

# Result of looking ids up: status is ok, missing or failed.
FETCHED = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
