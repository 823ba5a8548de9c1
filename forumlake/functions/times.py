"""Times; every one of them reads the session time zone, which session.configure sets to UTC."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def day_string(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def date_key(ts: Column | str) -> Column:
    """Day as the integer yyyymmdd."""
    return F.date_format(ts, "yyyyMMdd").cast("bigint")


def whole_units(unit: str, start: Column | str, end: Column | str) -> Column:
    """Whole MINUTE, HOUR or DAY (24 h) periods from start to end, cut toward zero; may be negative."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    return F.timestamp_diff(unit, start, end).cast("bigint")


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per day in date_day from start to end, end excluded."""
    first, last = (dt.date.fromisoformat(str(d)[:10]) for d in (start, end))
    return spark.range((last - first).days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_day")
    )
