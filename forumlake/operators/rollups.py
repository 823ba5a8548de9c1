"""Aggregates that shrink the data before it meets anything else."""

from pyspark.sql import DataFrame, functions as F


def comment_rollup(items: DataFrame) -> DataFrame:
    """First comment time and number of direct comments per parent, in one aggregation.

    Comments are summed up in the map tasks first, so a story with a third of all comments
    reaches its reducer as one row per task. Parents of any kind are kept: a left join from
    stories picks the right ones, which saves a semi join over all comments.
    """
    return (
        items.filter((F.col("item_type") == "comment") & F.col("parent_id").isNotNull())
        .groupBy(F.col("parent_id").alias("story_id"))
        .agg(F.min("created_at").alias("first_comment_at"), F.count(F.lit(1)).alias("total_comments"))
    )


def author_activity(items: DataFrame) -> DataFrame:
    """First and last post and number of posts per author, all item types."""
    return (
        items.filter(F.col("author").isNotNull())
        .groupBy("author")
        .agg(
            F.min("created_at").alias("first_post_at_ts"),
            F.max("created_at").alias("last_post_at_ts"),
            F.count(F.lit(1)).alias("total_posts_count"),
        )
    )
