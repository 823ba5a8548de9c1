"""Mergeable summaries per story day: counts, sums, and sketches of distinct values and of quantiles.

A dashboard range is answered by merging one row per day instead of reading the stories. Sums and counts are exact;
distinct counts and quantiles have the error the functions state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from forumlake.plans.dashboard import in_date_range

#: log2 of the registers of a distinct count (relative standard error 1.04 / sqrt of them: 0.8 %), of the entries of a
#: sketch for set operations (1 / sqrt: 0.8 % of the union), and the quantile sketch's size (rank error 0.4 %).
DISTINCT_BITS, SET_BITS, QUANTILE_SIZE = 14, 14, 800


def day_summaries(view: DataFrame) -> DataFrame:
    """One row per created_at_date of the reporting view, made with partial results of the map tasks."""
    minutes = "time_to_first_comment_minutes"
    return view.groupBy("created_at_date").agg(
        F.count("item_id").alias("stories"),
        F.hll_sketch_agg("item_id", DISTINCT_BITS).alias("story_sketch"),
        F.hll_sketch_agg("user_key", DISTINCT_BITS).alias("author_sketch"),
        F.theta_sketch_agg("user_key", SET_BITS).alias("author_set"),
        F.sum("total_comments").alias("comments"),
        F.count("total_comments").alias("commented_stories"),
        F.sum(minutes).alias("minutes"),
        F.count(minutes).alias("answered_stories"),
        F.kll_sketch_agg_bigint("score", QUANTILE_SIZE).alias("score_sketch"),
        F.kll_sketch_agg_bigint(minutes, QUANTILE_SIZE).alias("minutes_sketch"),
    )


def kpi_tiles(days: DataFrame, first=None, last=None) -> DataFrame:
    """The dashboard's tiles for a date range from its day rows; both counts are estimates, both means are exact."""
    shown = in_date_range(days, first, last)

    def distinct(sketch: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0))

    return shown.agg(
        distinct("story_sketch").alias("total_stories"),
        distinct("author_sketch").alias("active_authors"),
        F.try_divide(F.sum("comments"), F.sum("commented_stories")).alias("avg_comments_per_story"),
        F.try_divide(F.sum("minutes"), F.sum("answered_stories")).alias("avg_minutes_to_first_comment"),
    )


def quantiles(days: DataFrame, sketch: str, shares: dict[str, float], first=None, last=None) -> DataFrame:
    """Quantiles of a date range from its day rows' sketches (score_sketch or minutes_sketch); NULL without values.

    `shares` maps an output column to a share. A result is a value of the data whose rank is off by at most the
    sketch's error.
    """
    merged = in_date_range(days, first, last).agg(F.kll_merge_agg_bigint(sketch).alias("_sketch"))
    found = F.coalesce(F.kll_sketch_get_n_bigint("_sketch"), F.lit(0)) > 0
    return merged.select(
        *[
            F.when(found, F.kll_sketch_get_quantile_bigint("_sketch", F.lit(share))).alias(name)
            for name, share in shares.items()
        ]
    )


def authors_of_both(days: DataFrame, one: tuple, other: tuple) -> DataFrame:
    """Estimated authors of two date ranges, of both, and of the first only (each range: first and last day)."""
    def union(limits: tuple) -> Column:
        day = F.col("created_at_date")
        return F.theta_union_agg(F.when(day.between(*(F.lit(x).cast("date") for x in limits)), F.col("author_set")))

    sets = days.agg(union(one).alias("a"), union(other).alias("b"))

    def size(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0))

    return sets.select(
        size(F.col("a")).alias("first_authors"),
        size(F.col("b")).alias("second_authors"),
        size(F.theta_intersection("a", "b")).alias("both_authors"),
        size(F.theta_difference("a", "b")).alias("first_only_authors"),
    )
