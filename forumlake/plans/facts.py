from pyspark.sql import DataFrame, functions as F

from forumlake.constants import NO_DOMAIN, UNKNOWN_USER_KEY, UNKNOWN_USER_NAME
from forumlake.functions import date_key, surrogate_key, whole_units
from forumlake.operators.rollups import comment_rollup
from forumlake.operators.skew import salted_join
from forumlake.plans.dims import hot_users


def _stories_with_comments(staged: DataFrame) -> DataFrame:
    """Stories left joined to the comment rollup: both sides have one row per id."""
    stories = staged.filter(F.col("item_type") == "story")
    return stories.join(comment_rollup(staged), F.col("item_id") == F.col("story_id"), "left")


def _measures() -> list:
    return [
        date_key("created_at").alias("created_date_key"),
        "created_at",
        "score",
        "total_comments",
        whole_units("MINUTE", "created_at", "first_comment_at").alias("time_to_first_comment_minutes"),
    ]


def fct_stories(staged: DataFrame) -> DataFrame:
    """One row per story; total_comments and the minutes are NULL, not 0, without comments.

    Both dimension keys are functions of columns the story already has, and both dimensions
    are built from the same staged items, so looking them up cannot change the result. Only
    an author who bears the name of the missing-author member would make the lookup ambiguous;
    the uniqueness check on dim_users.user_name reports that, and fct_stories_joined, which
    build_models then takes, keeps the lookup.
    """
    return _stories_with_comments(staged).select(*fact_columns())


def fact_columns() -> list:
    """The fact's columns, from stories joined to their comment rollup."""
    return [
        F.when(F.col("item_id").isNotNull(), surrogate_key("item_id")).alias("item_key"),
        F.when(F.col("author").isNull(), F.lit(UNKNOWN_USER_KEY)).otherwise(surrogate_key("author")).alias("user_key"),
        *_measures(),
    ]


def fct_stories_joined(staged: DataFrame, items: DataFrame, users: DataFrame, **hot) -> DataFrame:
    """The same fact with keys looked up in the dimensions, for dimensions kept elsewhere."""
    stories = _stories_with_comments(staged).withColumn(
        "user_name", F.coalesce("author", F.lit(UNKNOWN_USER_NAME))
    )
    keyed = stories.join(items.select("item_id", "item_key"), "item_id", "left")
    with_users = salted_join(
        keyed, users.select("user_name", "user_key"), "user_name", "left",
        hot_users(users, "user_name", **hot), ["item_id"],
    )
    return with_users.select("item_key", "user_key", *_measures())


def story_analytics(facts: DataFrame, items: DataFrame, users: DataFrame, **hot) -> DataFrame:
    """Stories with their item and author attributes, one wide row each."""
    authors = users.select("user_key", "user_name", "author_lifetime_days", "total_posts_count")
    stories = facts.join(items.select("item_key", "item_id", "title", "url", "domain"), "item_key", "left")
    wide = salted_join(stories, authors, "user_key", "left", hot_users(users, "user_key", **hot), ["item_key"])
    return wide.select(
        "item_key", "item_id", "title", "url",
        F.coalesce("domain", F.lit(NO_DOMAIN)).alias("story_domain"),
        "user_key", "user_name", "author_lifetime_days", "total_posts_count",
        "created_at", F.to_date("created_at").alias("created_at_date"),
        "score", "total_comments", "time_to_first_comment_minutes",
    )
