import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlake.constants import CALENDAR_END, CALENDAR_START, UNKNOWN_USER_KEY, UNKNOWN_USER_NAME
from forumlake.functions import date_key, date_spine, surrogate_key, url_host, whole_units
from forumlake.operators.rollups import author_activity
from forumlake.operators.skew import MAX_HOT_KEYS, MIN_HOT_ROWS, hot_keys


def dim_items(staged: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per item with its key, url host and text length; without text for readers of the view."""
    items = staged.select(
        surrogate_key("item_id").alias("item_key"),
        "item_id",
        "item_type",
        "title",
        *(["text_content"] if with_text else []),
        "url",
        url_host("url").alias("domain"),
        F.col("url").isNotNull().alias("has_url"),
    )
    return items.withColumn("text_length", F.length("text_content").cast("bigint")) if with_text else items


def dim_users(staged: DataFrame) -> DataFrame:
    """One row per author with activity figures, plus the member that stands for a missing author."""
    known = author_activity(staged).select(
        surrogate_key("author").alias("user_key"),
        F.col("author").alias("user_name"),
        "first_post_at_ts",
        "last_post_at_ts",
        "total_posts_count",
        whole_units("DAY", "first_post_at_ts", "last_post_at_ts").alias("author_lifetime_days"),
    )
    unknown = staged.sparkSession.range(1).select(
        F.lit(UNKNOWN_USER_KEY).alias("user_key"),
        F.lit(UNKNOWN_USER_NAME).alias("user_name"),
        F.lit(None).cast("timestamp").alias("first_post_at_ts"),
        F.lit(None).cast("timestamp").alias("last_post_at_ts"),
        F.lit(0).cast("bigint").alias("total_posts_count"),
        F.lit(None).cast("bigint").alias("author_lifetime_days"),
    )
    return known.unionByName(unknown)


def hot_users(users: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """Authors to salt in a join, from the post counts the dimension already has.

    The missing author is always one of them: its count is 0 there although it may
    stand behind any number of stories.
    """
    unknown = users.filter(F.col("user_key") == UNKNOWN_USER_KEY).select(key).distinct()
    return hot_keys(users, key, "total_posts_count", min_rows, max_keys).unionByName(unknown).distinct()


def dim_dates(
    spark: SparkSession, start: str | dt.date = CALENDAR_START, end: str | dt.date = CALENDAR_END
) -> DataFrame:
    """Calendar days, end excluded, with the integer key the story fact carries."""
    return date_spine(spark, start, end).withColumn("date_key", date_key("date_day"))


def observed_dates(items: DataFrame, ts: str = "created_at") -> DataFrame:
    """Calendar from the first to the last day that occurs in the items; no day if none has a time."""
    first, last = items.agg(F.to_date(F.min(ts)), F.to_date(F.max(ts))).first()
    if first is None:
        return dim_dates(items.sparkSession).limit(0)
    return dim_dates(items.sparkSession, first, last + dt.timedelta(days=1))
