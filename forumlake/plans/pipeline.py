"""The three batch runs: look up and land, raw to parsed, parsed to models."""

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlake.constants import CALENDAR_END, ITEMS_PER_CHUNK, UNKNOWN_USER_NAME
from forumlake.plans import dashboard, dims, facts, marts, quality, staging
from forumlake.session import setting, stored
from forumlake.sources import bronze, control, releases, silver


def land_new_items(
    spark: SparkSession,
    root: str,
    mark_path: str,
    max_id: int,
    lookup: Callable[[int], dict | None],
    day: dt.date,
    chunk_size: int = ITEMS_PER_CHUNK,
    items_per_run: int | None = None,
    manifest_path: str | None = None,
    source: str = "feed",
) -> tuple[int, DataFrame]:
    """Look up the ids after the high-water mark and those that failed before, land them, then move the mark.

    Returns the number of landed items and the ids whose look-up failed in this run. Failed ids are kept beside the mark
    and taken up again by the next run, so the mark never passes an id for good. With `items_per_run` the oldest ids of
    a backlog are taken and the mark moves to the last of them. Items are looked up once: the result is stored before
    it is landed. A run that dies before the mark moved lands the same ids again; staging keeps one version.
    With `manifest_path` the files landed in this run are added to the manifest.
    """
    last_id, lookups = control.read_mark(spark, mark_path), f"{mark_path.rstrip('/')}-lookups"
    bounds = bronze.run_bounds(last_id, max_id, items_per_run)
    before = stored(control.failed_lookups(spark, lookups))
    ids = bronze.run_ids(spark, last_id, max_id, chunk_size, items_per_run)
    n_before, newest_before = before.agg(F.count(F.lit(1)), F.max("item_id")).first()
    again = before.select("item_id").repartition(min(bronze.MAX_FETCH_TASKS, max(1, -(-n_before // chunk_size))))
    fetched = stored(bronze.fetch_items(ids.unionByName(again), lookup))
    found = bronze.landable(fetched.filter("status = 'ok'"))
    known_files = _day_files(spark, root, day) if manifest_path else None
    bronze.land_items(found, root, day, chunk_size)
    # New ids that did not fail need no look at those that failed before.
    tried = fetched.filter((F.col("status") == "failed") | F.coalesce(F.col("item_id") <= F.lit(newest_before), F.lit(False)))
    tried = tried.join(before.select("item_id", "attempt"), "item_id", "left")
    tried = tried.filter("status = 'failed' OR attempt IS NOT NULL")
    control.write_lookups(tried.withColumn("attempt", F.coalesce("attempt", F.lit(0)) + 1), lookups)
    if manifest_path:
        lines = bronze.landed_lines(spark, root, [f"{day:%Y-%m-%d}"])
        added = lines.join(known_files.select(F.col("path").alias("source_file")), "source_file", "left_anti")
        bronze.write_manifest(bronze.manifest(added, source), manifest_path)
    if bounds:
        control.write_mark(spark, mark_path, bounds[1])
    return found.count(), fetched.filter("status = 'failed'").select("item_id", "error")


def _day_files(spark: SparkSession, root: str, day: dt.date) -> DataFrame:
    """Files already landed for a day; none if nothing has been landed yet."""
    try:
        return stored(bronze.landed_files(spark, f"{root}/{day:%Y/%m/%d}"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")


class DayRun(NamedTuple):
    """Days a run has parsed, and days that lost files and were left alone."""

    parsed: list[str]
    shrunk: list[str]


def parse_changed_days(
    spark: SparkSession, root: str, silver_path: str, state_path: str, run_id: int, reload_shrunk: bool = False
) -> DayRun:
    """Parse every day with a new or changed file in one job, replace it in silver, then record its files.

    A day that only lost files is left alone and reported, unless asked for: reloading it would lose items. Only day
    names come to the driver. Listing reads no contents, but Spark would plan one task per 128 MB of listed files, so
    their number is limited for that job.
    """
    state, files_state = state_path.rstrip("/"), f"{state_path.rstrip('/')}-files"
    with setting(spark, "spark.sql.files.maxPartitionNum", "512"):
        files = stored(bronze.landed_files(spark, root))
    compared = bronze.compare_files(files, control.read_file_state(spark, files_state))
    status = {r.ingest_date: r.status for r in compared.filter("status <> 'unchanged'").collect()}
    shrunk = sorted(d for d, s in status.items() if s == "shrunk")
    days = sorted(d for d, s in status.items() if s != "shrunk" or reload_shrunk)
    landed = {r.ingest_date for r in files.select("ingest_date").distinct().collect()}
    days = [d for d in days if d in landed]  # a day without any file left has nothing to read
    if days:
        # The first run takes every day: then the whole folder is listed instead of each day.
        everything = len(days) == len(landed)
        lines = bronze.landed_lines(spark, root, None if everything else days).filter("ingest_date IS NOT NULL")
        silver.write_items(silver.parse_items(lines), silver_path)
        parsed = files.filter(F.col("ingest_date").isin(days))
        control.write_file_state(parsed, files_state, run_id)
        control.write_day_state(bronze.day_totals(parsed), state, run_id)
    return DayRun(days, [d for d in shrunk if d not in days])


def save_table(df: DataFrame, name: str, key: str | None = None, buckets: int | None = None) -> DataFrame:
    """Store a model as a table, replacing it, and return the stored table.

    With `buckets` the rows are hashed by `key` once, at write time; joins and aggregations
    on that key then need no shuffle. Choose buckets of a few hundred megabytes. The rows are written under another
    name first, so a build that fails leaves the table as it was.
    """
    if buckets:
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    else:
        writer = df.write
    writer.mode("overwrite").format("parquet").option("compression", "zstd").saveAsTable(f"{name}__next")
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")
    return spark.table(name)


def _store_models(items: DataFrame, store: Callable[[str, DataFrame, str | None], DataFrame]) -> dict[str, DataFrame]:
    """Every model, stored by store(name, rows, key) and read back by the next."""
    spark, models = items.sparkSession, {}

    def add(name: str, df: DataFrame, key: str | None = None) -> DataFrame:
        models[name] = store(name, df, key)
        return models[name]

    staged = add("stg_items", staging.staged_items(items), "item_id")
    add("dim_items", dims.dim_items(staged), "item_key")
    add("dim_users", dims.dim_users(staged), "user_key")
    # The calendar goes on to the last day an item was created, if that is later than its usual end.
    newest = staged.agg(F.date_add(F.to_date(F.max("created_at")), 1)).first()[0]
    add("dim_dates", dims.dim_dates(spark, end=max(newest or dt.date.min, dt.date.fromisoformat(CALENDAR_END))))
    # Keys are computed unless an author bears the unknown author's name and only a look-up tells both.
    if models["dim_users"].filter(F.col("user_name") == UNKNOWN_USER_NAME).count() == 1:
        stories = facts.fct_stories(staged)
    else:
        stories = facts.fct_stories_joined(staged, models["dim_items"], models["dim_users"])
    add("fct_stories", stories, "item_key")
    add("daily_story_metrics", marts.daily_story_metrics(models["fct_stories"]))
    add("daily_active_authors", marts.daily_active_authors(models["fct_stories"]))
    # Most items are comments, which the view never looks up.
    stories_only = models["dim_items"].filter("item_type = 'story'")
    wide = facts.story_analytics(models["fct_stories"], stories_only, models["dim_users"])
    add("story_analytics", wide, "item_key")
    return models


def build_models(
    items: DataFrame, staging_schema: str = "silver", schema: str = "gold", buckets: int | None = None
) -> dict[str, DataFrame]:
    """Rebuild all models from parsed items; each is stored once and read back by the next.

    Staging is stored although it is only a view of the parsed items: five models read it, and
    each would repeat the whole deduplication. So is the reporting view: dashboards read it
    often, and it changes only when the models do. Tables are replaced one by one; publish_models replaces all at once.
    """
    for name in (staging_schema, schema):
        items.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name}")

    def store(name: str, df: DataFrame, key: str | None) -> DataFrame:
        return save_table(df, f"{staging_schema if name == 'stg_items' else schema}.{name}", key, buckets if key else None)

    return _store_models(items, store)


def publish_models(items: DataFrame, root: str, release: int, checked: bool = False) -> dict[str, DataFrame]:
    """Build all models as one release and have readers get it: until the last step they get the old set, whole.

    A build that died is repeated under its number; one whose release is complete is not built again. With `checked`
    a release with failing checks is not published, and an error names them.
    """
    spark = items.sparkSession
    if not releases.is_complete(spark, root, release):
        models = _store_models(items, lambda name, df, key: releases.write_table(df, root, release, name))
        failing = check_models(models).select("model", "column", "check").collect() if checked else []
        if failing:
            raise ValueError(f"release {release} fails " + ", ".join(".".join(r) for r in failing))
        releases.complete(spark, root, release, models)
    releases.move_to(spark, root, release)
    return releases.read(spark, root, release)


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """Failures of every declared check that has any."""
    return quality.run_checks(models).filter("failures > 0")


def dashboard_queries(view: DataFrame, first=None, last=None) -> dict[str, DataFrame]:
    """All dashboard queries for one date range."""
    shown = dashboard.in_date_range(view, first, last)
    return {
        "kpi_tiles": dashboard.kpi_tiles(shown),
        "activity_trend": dashboard.activity_trend(shown),
        "top_domains": dashboard.top_domains(shown),
        "top_stories": dashboard.top_stories(shown),
        "top_authors": dashboard.top_authors(shown),
    }
