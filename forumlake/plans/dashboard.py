"""Dashboard queries over the reporting view."""

from pyspark.sql import DataFrame, functions as F

from forumlake.operators.topk import top_k


def in_date_range(view: DataFrame, first=None, last=None) -> DataFrame:
    """The global date control; both ends count."""
    day = F.col("created_at_date")
    if first is not None:
        view = view.filter(day >= F.lit(first).cast("date"))
    if last is not None:
        view = view.filter(day <= F.lit(last).cast("date"))
    return view


def drill_down(df: DataFrame, day=None, item_type: str | None = None, author: str | None = None) -> DataFrame:
    """Filters by day, item type and author, each optional, on items that have those columns."""
    if day is not None:
        df = df.filter(F.to_date("created_at") == F.lit(day).cast("date"))
    if item_type is not None:
        df = df.filter(F.col("item_type") == item_type)
    if author is not None:
        df = df.filter(F.col("author") == author)
    return df


def kpi_tiles(view: DataFrame) -> DataFrame:
    """Distinct stories and authors, mean comments and mean minutes to the first comment, in one row."""
    return view.agg(
        F.count_distinct("item_id").alias("total_stories"),
        F.count_distinct("user_key").alias("active_authors"),
        F.avg("total_comments").alias("avg_comments_per_story"),
        F.avg("time_to_first_comment_minutes").alias("avg_minutes_to_first_comment"),
    )


def activity_trend(view: DataFrame) -> DataFrame:
    """Distinct stories and authors per day."""
    return view.groupBy("created_at_date").agg(
        F.count_distinct("item_id").alias("stories"), F.count_distinct("user_key").alias("authors")
    )


def top_domains(view: DataFrame, k: int = 10) -> DataFrame:
    counts = view.groupBy("story_domain").agg(F.count("item_id").alias("stories"))
    return top_k(counts, ["stories"], ["story_domain"], k)


def top_stories(view: DataFrame, k: int = 10) -> DataFrame:
    """By summed score; stories with the same title by the same author count as one."""
    sums = view.groupBy("title", "user_name").agg(
        F.sum("score").alias("score"), F.sum("total_comments").alias("total_comments")
    )
    return top_k(sums, ["score"], ["title", "user_name"], k)


def top_authors(view: DataFrame, k: int = 10) -> DataFrame:
    sums = view.groupBy("user_name", "author_lifetime_days", "total_posts_count").agg(F.sum("score").alias("score"))
    return top_k(sums, ["score"], ["user_name"], k)
