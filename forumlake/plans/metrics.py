"""Business metrics over staged items and the story fact."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from forumlake.constants import UNKNOWN_USER_KEY
from forumlake.functions import whole_units
from forumlake.operators.ordered import exact_quantiles, ranked
from forumlake.operators.rollups import comment_rollup
from forumlake.operators.skew import MAX_HOT_KEYS, MIN_HOT_ROWS, hot_keys, salted_join
from forumlake.operators.topk import top_k


def period_start(ts: str, period: str) -> Column:
    """First day of the DAY, WEEK, MONTH or YEAR a timestamp falls into."""
    return F.date_trunc(period, ts).cast("date").alias("period")


def author_scores(facts: DataFrame, **hot) -> DataFrame:
    """Authors ranked by the summed score of their stories; equal sums share a rank."""
    sums = facts.groupBy("user_key").agg(F.sum("score").alias("total_score"), F.count(F.lit(1)).alias("stories"))
    return ranked(sums, "total_score", ["user_key"], **hot)


def with_author_score(facts: DataFrame, min_rows: int = MIN_HOT_ROWS, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """Every story with the total score of its author.

    Written as aggregate and join, not as a window over the author: a window would put all
    stories of a busy author into one task.
    """
    sums = facts.groupBy("user_key").agg(F.sum("score").alias("author_score"), F.count(F.lit(1)).alias("_stories"))
    hot = hot_keys(sums, "user_key", "_stories", min_rows, max_keys)
    return salted_join(facts, sums.drop("_stories"), "user_key", "left", hot, ["item_key"])


def author_lifetimes(users: DataFrame) -> DataFrame:
    """Days between first and last post and number of posts, for real authors."""
    return users.filter(F.col("user_key") != UNKNOWN_USER_KEY).select(
        "user_name", "first_post_at_ts", "last_post_at_ts", "author_lifetime_days", "total_posts_count"
    )


def minutes_to_first_comment(facts: DataFrame) -> DataFrame:
    """Mean minutes from a story to its first comment, and the number of stories that got one."""
    return facts.agg(
        F.avg("time_to_first_comment_minutes").alias("avg_minutes"),
        F.count("time_to_first_comment_minutes").alias("stories"),
    )


def first_comment_distribution(facts: DataFrame) -> DataFrame:
    """Exact median, 90th and 99th percentile of the minutes to the first comment."""
    return exact_quantiles(
        facts, "time_to_first_comment_minutes", {"median_minutes": "0.5", "p90_minutes": "0.9", "p99_minutes": "0.99"}
    )


def engagement(staged: DataFrame, days: int = 7, period: str | None = None) -> DataFrame:
    """Stories, stories with a comment, and stories with one within `days` days, with the percentage.

    A story has a comment in time exactly if its first one is, so the comment rollup is enough
    and no comment is joined to a story. With `period` it is a funnel per period of the story.
    """
    stories = (
        staged.filter(F.col("item_type") == "story")
        .select("item_id", "created_at")
        .join(comment_rollup(staged), F.col("item_id") == F.col("story_id"), "left")
    )
    in_time = F.col("first_comment_at") <= F.col("created_at") + F.make_dt_interval(F.lit(days))
    grouped = stories.groupBy(period_start("created_at", period)) if period else stories.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("stories"),
        F.count("first_comment_at").alias("commented_stories"),
        F.count_if(in_time).alias("engaged_stories"),
    ).withColumn("engaged_pct", F.try_divide(F.lit(100.0) * F.col("engaged_stories"), F.col("stories")))


def comments_by_age(staged: DataFrame, days: int = 7, unit: str = "HOUR", slices: int = 28) -> DataFrame:
    """story_id, age (whole units, cut toward zero), comments: direct comments in a story's first `days` days.

    Comments from the story's time on to exactly `days` days later count; ages without any have no row. Time is cut into
    slices of the window: a story stands in each slice its window meets, a comment in one, and they are joined on
    story and slice. So the comments of a much discussed story are spread over as many keys as there are slices, and
    earlier or later ones meet no story.
    """
    width = days * 86400 * 1_000_000 // slices

    def slice_of(ts: Column) -> Column:
        return F.floor(F.unix_micros(ts) / F.lit(width)).cast("bigint")

    end = F.col("created_at") + F.make_dt_interval(F.lit(days))
    stories = staged.filter((F.col("item_type") == "story") & F.col("created_at").isNotNull()).select(
        F.col("item_id").alias("story_id"),
        "created_at",
        end.alias("until"),
        F.explode(F.sequence(slice_of(F.col("created_at")), slice_of(end))).alias("slice"),
    )
    comments = staged.filter((F.col("item_type") == "comment") & F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("story_id"), F.col("created_at").alias("said_at"), slice_of(F.col("created_at")).alias("slice")
    )
    # Comments of one second become one row before they are shuffled.
    counted = comments.groupBy("story_id", "slice", "said_at").agg(F.count(F.lit(1)).alias("n"))
    met = counted.join(stories, ["story_id", "slice"]).filter(F.col("said_at").between(F.col("created_at"), F.col("until")))
    age = whole_units(unit, "created_at", "said_at").alias("age")
    return met.groupBy("story_id", age).agg(F.sum("n").alias("comments"))


def comment_rate(items: DataFrame, period: str | None = None) -> DataFrame:
    """Comments per story, overall or per period; NULL for a period without stories."""
    grouped = items.groupBy(period_start("created_at", period)) if period else items.groupBy()
    return grouped.agg(
        F.count_if(F.col("item_type") == "comment").alias("comments"),
        F.count_if(F.col("item_type") == "story").alias("stories"),
    ).withColumn("comments_per_story", F.try_divide(F.col("comments").cast("double"), F.col("stories")))


def peak_hours(items: DataFrame) -> DataFrame:
    """Items per hour of day and type."""
    return items.groupBy(F.hour("created_at").cast("bigint").alias("hour"), "item_type").agg(
        F.count(F.lit(1)).alias("items")
    )


def comment_velocity(staged: DataFrame, as_of=None, k: int = 10) -> DataFrame:
    """Top stories by direct comments per hour between their creation and `as_of`.

    The docs ask for the figure without a formula; this one counts a story younger than an
    hour as one hour old. `as_of` defaults to the newest item of the feed.
    """
    now = F.lit(as_of).cast("timestamp") if as_of is not None else staged.agg(F.max("created_at")).scalar()
    stories = (
        staged.filter(F.col("item_type") == "story")
        .select("item_id", "created_at", "score")
        .join(comment_rollup(staged), F.col("item_id") == F.col("story_id"))
        .withColumn("as_of", now)
        .withColumn("hours", F.greatest(whole_units("HOUR", "created_at", "as_of"), F.lit(1).cast("bigint")))
        .withColumn("comments_per_hour", F.col("total_comments") / F.col("hours"))
    )
    best = top_k(stories, ["comments_per_hour", "score"], ["item_id"], k)
    return best.select("item_id", "score", "total_comments", "hours", "comments_per_hour")


def lifetime_curve(
    staged: DataFrame, unit: str = "DAY", min_rows: int = MIN_HOT_ROWS, max_keys: int = MAX_HOT_KEYS
) -> DataFrame:
    """Comments by age of their story in whole units, with the running total.

    The join of comments to stories is salted for stories with very many comments. The
    window at the end runs over one row per age, which the calendar bounds.
    """
    comments = staged.filter((F.col("item_type") == "comment") & F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("story_id"), F.col("item_id").alias("comment_id"), F.col("created_at").alias("said_at")
    )
    stories = staged.filter(F.col("item_type") == "story").select(F.col("item_id").alias("story_id"), "created_at")
    hot = hot_keys(comments, "story_id", min_rows=min_rows, max_keys=max_keys)
    aged = salted_join(comments, stories, "story_id", "inner", hot, ["comment_id"])
    by_age = aged.groupBy(whole_units(unit, "created_at", "said_at").alias("age")).agg(
        F.count(F.lit(1)).alias("comments")
    )
    so_far = Window.partitionBy(F.lit(0)).orderBy("age").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by_age.withColumn("comments_so_far", F.sum("comments").over(so_far))


def author_cohorts(items: DataFrame) -> DataFrame:
    """Authors active per month, by the month of their first post.

    Reduced to one row per author and month first, which bounds the window over an author
    by the number of months.
    """
    months = (
        items.filter(F.col("author").isNotNull() & F.col("created_at").isNotNull())
        .groupBy("author", F.date_trunc("MONTH", "created_at").cast("date").alias("active_month"))
        .agg(F.count(F.lit(1)).alias("posts"))
    )
    first = F.min("active_month").over(Window.partitionBy("author"))
    return (
        months.withColumn("cohort_month", first)
        .groupBy("cohort_month", "active_month")
        .agg(F.count(F.lit(1)).alias("authors"), F.sum("posts").alias("posts"))
    )


def author_features(staged: DataFrame) -> DataFrame:
    """Per author: posts by type, scores of stories, direct replies received, first and last post."""
    replies = comment_rollup(staged)
    posts = staged.filter(F.col("author").isNotNull()).select("item_id", "author", "item_type", "score", "created_at")
    is_story = F.col("item_type") == "story"
    return (
        posts.join(replies, F.col("item_id") == F.col("story_id"), "left")
        .groupBy("author")
        .agg(
            F.count(F.lit(1)).alias("posts"),
            F.count_if(is_story).alias("stories"),
            F.count_if(F.col("item_type") == "comment").alias("comments"),
            F.sum(F.when(is_story, F.col("score"))).alias("story_score"),
            F.max(F.when(is_story, F.col("score"))).alias("best_score"),
            F.coalesce(F.sum("total_comments"), F.lit(0)).alias("replies_received"),
            F.min("created_at").alias("first_post_at"),
            F.max("created_at").alias("last_post_at"),
        )
    )
