"""The marts kept up to date from the ingest days that changed, without reading the other ones.

Kept are: each item's newest version per ingest day, by ranges of item ids; which of those ranges a day has items in;
current comments, by ranges of their story's id; the fact and the daily marts, by story day.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

from forumlake.operators.versions import latest_version
from forumlake.plans import marts, staging
from forumlake.plans.facts import fact_columns
from forumlake.schemas import SILVER
from forumlake.session import stored
from forumlake.sources.parts import NONE, id_part, names, read_parts, replace_parts

IDS_PER_PART = 1_000_000

_VERSIONS = StructType([f for f in SILVER if f.name not in staging.TEXTS])
_DAY_RANGES = StructType([StructField("ingest_date", StringType()), StructField("id_range", StringType())])
_COMMENTS = StructType(
    [StructField("item_id", LongType()), StructField("parent_id", LongType()), StructField("created_at", TimestampType())]
)
_FACTS = StructType(
    [
        StructField("item_id", LongType()),
        StructField("item_key", StringType()),
        StructField("user_key", StringType()),
        StructField("created_date_key", LongType()),
        StructField("created_at", TimestampType()),
        StructField("score", LongType()),
        StructField("total_comments", LongType()),
        StructField("time_to_first_comment_minutes", LongType()),
    ]
)
_METRICS = StructType(
    [
        StructField("story_date", DateType()),
        StructField("stories_per_day", LongType()),
        StructField("avg_comments_per_story", DoubleType()),
        StructField("median_story_score", LongType()),
    ]
)
_AUTHORS = StructType([StructField("story_date", DateType()), StructField("active_authors_per_day", LongType())])


class Refreshed(NamedTuple):
    """What a run touched: ranges of item ids, ranges of ids of commented items, story days."""

    id_ranges: list[str]
    story_ranges: list[str]
    story_days: list[str]


def _story_day(created_at: str = "created_at") -> Column:
    return F.coalesce(F.date_format(created_at, "yyyy-MM-dd"), F.lit(NONE))


def _newest(versions: DataFrame) -> DataFrame:
    """What staging takes of an item, from its newest version of each ingest day."""
    return latest_version(versions, ["item_id"], ["ingest_date", "source_file"], staging.TIES)


def _only(rows: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows with (or, as left_anti, without) one of the ids in item_id; null is an id."""
    wanted = ids.select(F.col(ids.columns[0]).alias("_id")).distinct()
    return rows.join(wanted, F.col("item_id").eqNullSafe(F.col("_id")), how)


def refresh(
    spark: SparkSession, items: DataFrame, days: list[str], store: str, run: int, ids_per_part: int = IDS_PER_PART
) -> Refreshed:
    """Bring the marts up to date after the given ingest days of `items` (silver) were written, replaced or emptied.

    Touched are items that the days held in the last run or hold now, stories among them or with such a comment
    then or now, and the story days of these then and now. Only their ranges and days are read and replaced. Runs have
    rising numbers; one that died is repeated with its number. The driver sees names of ranges and days.
    """
    of_id = id_part("item_id", ids_per_part)
    delivered = items.filter(F.col("ingest_date").isin(days)).select(*_VERSIONS.names)
    new = stored(latest_version(delivered, ["item_id", "ingest_date"], ["source_file"], staging.TIES))
    day_ranges = new.select("ingest_date", of_id.alias("id_range")).distinct()
    known_ranges = read_parts(spark, f"{store}/day_ranges", _DAY_RANGES, days, run)
    ranges = names(day_ranges.unionByName(known_ranges), F.col("id_range"))

    # All versions of the touched ranges, before and after.
    old = stored(read_parts(spark, f"{store}/versions", _VERSIONS, ranges, run))
    replaced = F.col("ingest_date").isin(days)
    replace_parts(old.filter(~replaced).unionByName(new), f"{store}/versions", of_id, ranges, run)
    replace_parts(day_ranges, f"{store}/day_ranges", F.col("ingest_date"), days, run)
    touched = stored(old.filter(replaced).select("item_id").union(new.select("item_id")).distinct())
    before = stored(_newest(_only(old, touched)))
    after = stored(_newest(_only(read_parts(spark, f"{store}/versions", _VERSIONS, ranges, run + 1), touched)))

    # Comments move with their stories' ranges.
    said = (F.col("item_type") == "comment") & F.col("parent_id").isNotNull()
    was, now = (df.filter(said).select(*_COMMENTS.names) for df in (before, after))
    of_parent = id_part("parent_id", ids_per_part)
    story_ranges = names(was.unionByName(now), of_parent)
    kept = _only(read_parts(spark, f"{store}/comments", _COMMENTS, story_ranges, run), touched, "left_anti")
    replace_parts(kept.unionByName(now), f"{store}/comments", of_parent, story_ranges, run)

    # Stories that changed themselves or by a comment, then and now.
    is_story = F.col("item_type") == "story"
    own = before.filter(is_story).select("item_id").union(after.filter(is_story).select("item_id"))
    stories = stored(own.union(was.select("parent_id")).union(now.select("parent_id")).distinct())
    of_story = names(stories, of_id)
    current = _newest(_only(read_parts(spark, f"{store}/versions", _VERSIONS, of_story, run + 1), stories)).filter(is_story)
    comments = read_parts(spark, f"{store}/comments", _COMMENTS, of_story, run + 1)
    rollup = (
        comments.join(stories, comments["parent_id"] == stories["item_id"], "left_semi")
        .groupBy(F.col("parent_id").alias("story_id"))
        .agg(F.min("created_at").alias("first_comment_at"), F.count(F.lit(1)).alias("total_comments"))
    )
    joined = current.join(rollup, F.col("item_id") == F.col("story_id"), "left")
    rows = stored(joined.select("item_id", *fact_columns()))

    was_on = before.filter(is_story).select(_story_day().alias("day"))
    story_days = names(rows.select(_story_day().alias("day")).union(was_on), F.col("day"))
    unchanged = _only(read_parts(spark, f"{store}/facts", _FACTS, story_days, run), stories, "left_anti")
    replace_parts(unchanged.unionByName(rows), f"{store}/facts", _story_day(), story_days, run)
    facts = read_parts(spark, f"{store}/facts", _FACTS, story_days, run + 1)
    day = F.coalesce(F.col("story_date").cast("string"), F.lit(NONE))
    for name, mart in (("metrics", marts.daily_story_metrics(facts)), ("authors", marts.daily_active_authors(facts))):
        replace_parts(mart, f"{store}/{name}", day, story_days, run)
    return Refreshed(ranges, story_ranges, story_days)


def facts(spark: SparkSession, store: str, days: list[str] | None = None) -> DataFrame:
    """The story fact as the last run left it, or its given story days."""
    return read_parts(spark, f"{store}/facts", _FACTS, days).drop("item_id")


def daily_story_metrics(spark: SparkSession, store: str, days: list[str] | None = None) -> DataFrame:
    return read_parts(spark, f"{store}/metrics", _METRICS, days)


def daily_active_authors(spark: SparkSession, store: str, days: list[str] | None = None) -> DataFrame:
    return read_parts(spark, f"{store}/authors", _AUTHORS, days)
