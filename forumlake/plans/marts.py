from pyspark.sql import DataFrame, functions as F

from forumlake.operators.ordered import exact_quantiles


def _by_day(facts: DataFrame) -> DataFrame:
    return facts.withColumn("story_date", F.to_date("created_at"))


def daily_story_metrics(facts: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Stories, mean direct comments (stories without any left out) and approximate median score per day.

    The median is an element of the data, off by at most 1/accuracy of the day's stories in
    rank. All three aggregates merge partial results of the map tasks. The order of days is
    for reading; a stored table has none.
    """
    return (
        _by_day(facts)
        .groupBy("story_date")
        .agg(
            F.count("item_key").alias("stories_per_day"),
            F.avg("total_comments").alias("avg_comments_per_story"),
            F.approx_percentile("score", 0.5, accuracy).alias("median_story_score"),
        )
        .orderBy(F.desc("story_date"))
    )


def daily_active_authors(facts: DataFrame) -> DataFrame:
    """Authors with a story per day; the missing author counts as one.

    Spark first reduces to one row per day and author over all tasks, so a busy day is
    spread over many tasks before it is counted.
    """
    return (
        _by_day(facts)
        .groupBy("story_date")
        .agg(F.count_distinct("user_key").alias("active_authors_per_day"))
        .orderBy(F.desc("story_date"))
    )


def daily_median_score(facts: DataFrame) -> DataFrame:
    """Exact median score per day, for days too large for the sketch's error to be acceptable."""
    return exact_quantiles(_by_day(facts), "score", {"median_story_score": "0.5"}, ["story_date"])
