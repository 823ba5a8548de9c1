"""Registered queries: name -> function of (spark, sf_dir). Each runs library code over whole tables."""

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from forumlake_checks import feed
from forumlake.functions import day_string
from forumlake.operators import intervals, thread_store
from forumlake.operators.threads import expand_threads
from forumlake.operators.versions import latest_version
from forumlake.plans import dashboard, dims, facts, history, incremental, marts, metrics, quality, sketches, staging
from forumlake.plans.pipeline import build_models, land_new_items, parse_changed_days, publish_models
from forumlake.session import configure, dropped_shuffles, new_dir, small_splits, stored
from forumlake.sources import bronze, control, layout, releases, silver
from forumlake.streaming import jobs

#: Columns of the view that day rows are made of.
DAY_COLUMNS = ["created_at_date", "item_id", "user_key", "score", "total_comments", "time_to_first_comment_minutes"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    """Register a query; times are shown as plain UTC times, means to six digits."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = function(configure(spark), sf_dir)
        columns = []
        for field in df.schema:
            column = F.col(field.name)
            if isinstance(field.dataType, T.TimestampType):
                column = column.cast("timestamp_ntz")
            elif isinstance(field.dataType, T.DoubleType):
                column = F.round(column, 6)
            columns.append(column.alias(field.name))
        return df.select(*columns)

    QUERIES[function.__name__] = run
    return function


def _staged(spark, sf_dir, texts=()):
    return staging.staged_items(feed.feed(spark, sf_dir), list(texts))


def _stored_staged(spark, sf_dir, texts=()):
    """Staged items for queries that read them more than once, stored as build_models stores them."""
    return stored(_staged(spark, sf_dir, texts))


def _facts(spark, sf_dir):
    return facts.fct_stories(_stored_staged(spark, sf_dir))


def _view(spark, sf_dir):
    staged = _stored_staged(spark, sf_dir, ["title", "url"])
    users = stored(dims.dim_users(staged))
    return facts.story_analytics(facts.fct_stories(staged), dims.dim_items(staged, with_text=False), users)


# Staging, dimensions, fact, marts, view


@query
def staged_items(spark, sf_dir):
    return _staged(spark, sf_dir, staging.TEXTS)


@query
def staged_event_states(spark, sf_dir):
    return staging.staged_items(feed.event_items(spark, sf_dir))


@query
def latest_event_per_user(spark, sf_dir):
    events = feed.table(spark, sf_dir, "events")
    return latest_version(events, ["user_id", "event_type"], ["ts", "event_id"])


@query
def latest_lineitem(spark, sf_dir):
    lines = feed.table(spark, sf_dir, "lineitem")
    return latest_version(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def item_history(spark, sf_dir):
    return staging.item_history(feed.feed(spark, sf_dir))


@query
def event_state_history(spark, sf_dir):
    return staging.item_history(feed.event_items(spark, sf_dir))


def _coarse_states(spark, sf_dir):
    """Event items whose figures are coarse, so that a state often stays for several days."""
    items = feed.event_items(spark, sf_dir)
    return items.withColumns({"score": F.expr("descendants div 50"), "descendants": F.expr("descendants div 34")})


@query
def item_state_intervals(spark, sf_dir):
    return history.item_intervals(_coarse_states(spark, sf_dir))


@query
def intervals_by_delivery(spark, sf_dir):
    """Three deliveries: the last days first, some items twice, late days that split known intervals."""
    items, store = _coarse_states(spark, sf_dir), new_dir(spark, "history")
    third = F.pmod(F.xxhash64("source_file"), F.lit(3))
    deliveries = ((third == 0) & (F.col("ingest_date") > "2024-01-10"), third != 1, (third == 1) | (F.col("item_id") % 5 == 0))
    for run, part in enumerate(deliveries, 1):
        history.refresh(spark, items.filter(part), store, run, ids_per_part=20_000)
    return history.read_intervals(spark, store)


@query
def states_as_of(spark, sf_dir):
    """The state that every item had in the middle of the month."""
    return intervals.as_of(history.item_intervals(_coarse_states(spark, sf_dir)), "2024-01-15")


@query
def events_with_state_before(spark, sf_dir):
    """Every event with the state its item had three days before; none before it was first seen."""
    items = _coarse_states(spark, sf_dir)
    made = stored(history.item_intervals(items))
    events = items.select("source_file", "item_id", F.date_sub("ingest_date", 3).cast("string").alias("asked_day"))
    found = intervals.join_as_of(events, made, "item_id", "asked_day")
    return found.select("source_file", "item_id", "asked_day", "score", "descendants", "first_day")


@query
def comments_on_stories(spark, sf_dir):
    comments = staging.comments_on(_stored_staged(spark, sf_dir))
    return comments.select("item_id", "parent_id", "author", "created_at", "score")


@query
def dim_items(spark, sf_dir):
    return dims.dim_items(_staged(spark, sf_dir, staging.TEXTS))


@query
def dim_users(spark, sf_dir):
    return dims.dim_users(_staged(spark, sf_dir))


@query
def dim_dates(spark, sf_dir):
    return dims.observed_dates(feed.feed(spark, sf_dir))


@query
def fct_stories(spark, sf_dir):
    return _facts(spark, sf_dir)


@query
def fct_stories_joined(spark, sf_dir):
    staged = _stored_staged(spark, sf_dir, ["title", "url"])
    items, users = dims.dim_items(staged, with_text=False), stored(dims.dim_users(staged))
    return facts.fct_stories_joined(staged, items, users)


@query
def daily_story_metrics(spark, sf_dir):
    return marts.daily_story_metrics(_facts(spark, sf_dir))


@query
def daily_active_authors(spark, sf_dir):
    return marts.daily_active_authors(_facts(spark, sf_dir))


@query
def daily_median_score(spark, sf_dir):
    return marts.daily_median_score(_facts(spark, sf_dir))


@query
def story_analytics(spark, sf_dir):
    return _view(spark, sf_dir)


# Dashboard


@query
def kpi_tiles(spark, sf_dir):
    return dashboard.kpi_tiles(_view(spark, sf_dir))


@query
def kpi_tiles_1997(spark, sf_dir):
    return dashboard.kpi_tiles(dashboard.in_date_range(_view(spark, sf_dir), "1997-01-01", "1997-12-31"))


def _within(estimate, exact, share: float):
    return F.abs(estimate - exact) <= share * exact


@query
def kpi_tiles_from_days(spark, sf_dir):
    """Tiles of all days and of 1997 from one row per day, beside the exact ones; estimates within 3 %."""
    view = stored(_view(spark, sf_dir).select(*DAY_COLUMNS))
    days = stored(sketches.day_summaries(view))
    found = []
    for name, limits in (("all", (None, None)), ("1997", ("1997-01-01", "1997-12-31"))):
        estimated = sketches.kpi_tiles(days, *limits).first()
        exact = dashboard.kpi_tiles(dashboard.in_date_range(view, *limits))
        found.append(
            exact.select(
                F.lit(name).alias("range"),
                "total_stories",
                "active_authors",
                _within(F.lit(estimated.total_stories), F.col("total_stories"), 0.03).alias("stories_within"),
                _within(F.lit(estimated.active_authors), F.col("active_authors"), 0.03).alias("authors_within"),
                F.lit(estimated.avg_comments_per_story).alias("avg_comments_per_story"),
                F.lit(estimated.avg_minutes_to_first_comment).alias("avg_minutes_to_first_comment"),
            )
        )
    return found[0].unionByName(found[1])


@query
def authors_of_two_years(spark, sf_dir):
    """Authors of 1996, of 1997, of both and of 1996 only, beside the estimates from the days' sets."""
    view = stored(_view(spark, sf_dir).select(*DAY_COLUMNS))
    ranges = ("1996-01-01", "1996-12-31"), ("1997-01-01", "1997-12-31")
    near = sketches.authors_of_both(sketches.day_summaries(view), *ranges).first()
    year = F.year("created_at_date")
    per_author = view.groupBy("user_key").agg(F.max(year == 1996).alias("a"), F.max(year == 1997).alias("b"))
    exact = per_author.agg(
        F.count_if("a").alias("first_authors"),
        F.count_if("b").alias("second_authors"),
        F.count_if(F.col("a") & F.col("b")).alias("both_authors"),
        F.count_if(F.col("a") & ~F.col("b")).alias("first_only_authors"),
    )
    union = F.col("first_authors") + F.col("second_authors") - F.col("both_authors")
    within = [F.abs(F.lit(near[c]) - F.col(c)) <= 0.03 * union for c in exact.columns]
    return exact.withColumn("within", reduce(lambda a, b: a & b, within))


@query
def quantiles_from_days(spark, sf_dir):
    """Median and p90 of scores and of minutes to the first comment in 1997 from the days' sketches: the share of
    values below each and up to each must hold the wanted share, give or take one percent."""
    view = stored(_view(spark, sf_dir).select(*DAY_COLUMNS))
    days, limits = stored(sketches.day_summaries(view)), ("1997-01-01", "1997-12-31")
    shown, found = dashboard.in_date_range(view, *limits), []
    for value, sketch in (("score", "score_sketch"), ("time_to_first_comment_minutes", "minutes_sketch")):
        near = sketches.quantiles(days, sketch, {"median": 0.5, "p90": 0.9}, *limits).first()

        def holds(estimate, share, of=value):
            below = F.count_if(F.col(of) < F.lit(estimate)) / F.count(of)
            up_to = F.count_if(F.col(of) <= F.lit(estimate)) / F.count(of)
            return (below <= share + 0.01) & (up_to >= share - 0.01)

        found.append(
            shown.agg(
                F.lit(value).alias("value"),
                F.count(value).alias("n"),
                holds(near.median, 0.5).alias("median_within"),
                holds(near.p90, 0.9).alias("p90_within"),
            )
        )
    return found[0].unionByName(found[1])


@query
def activity_trend(spark, sf_dir):
    return dashboard.activity_trend(_view(spark, sf_dir))


@query
def top_domains(spark, sf_dir):
    return dashboard.top_domains(_view(spark, sf_dir))


@query
def top_stories(spark, sf_dir):
    return dashboard.top_stories(_view(spark, sf_dir))


@query
def top_authors(spark, sf_dir):
    return dashboard.top_authors(_view(spark, sf_dir))


@query
def drill_down(spark, sf_dir):
    items = dashboard.drill_down(_staged(spark, sf_dir), day="1997-01-03", item_type="story", author="src1")
    return items.select("item_id", "author", "created_at", "score")


@query
def drill_down_laid_out(spark, sf_dir):
    """The same on items laid out by day and author, with bloom filters on author and id."""
    path = new_dir(spark, "laid-out")
    layout.write_for_skipping(_staged(spark, sf_dir), path, "created_at", "author", "item_id", files=8)
    items = spark.read.parquet(path).filter("created_at >= '1997-01-03' AND created_at < '1997-01-04'")
    items = dashboard.drill_down(items, item_type="story", author="src1")
    return items.select("item_id", "author", "created_at", "score")


# Metrics


@query
def author_scores(spark, sf_dir):
    return metrics.author_scores(_facts(spark, sf_dir))


@query
def story_with_author_score(spark, sf_dir):
    scored = metrics.with_author_score(_facts(spark, sf_dir))
    return scored.select("item_key", "user_key", "score", "author_score")


@query
def author_lifetimes(spark, sf_dir):
    return metrics.author_lifetimes(dims.dim_users(_staged(spark, sf_dir)))


@query
def minutes_to_first_comment(spark, sf_dir):
    return metrics.minutes_to_first_comment(_facts(spark, sf_dir))


@query
def first_comment_distribution(spark, sf_dir):
    return metrics.first_comment_distribution(_facts(spark, sf_dir))


@query
def engagement_7d(spark, sf_dir):
    return metrics.engagement(_stored_staged(spark, sf_dir))


@query
def comments_by_hour(spark, sf_dir):
    return metrics.comments_by_age(_stored_staged(spark, sf_dir))


@query
def engagement_funnel(spark, sf_dir):
    return metrics.engagement(_stored_staged(spark, sf_dir), period="MONTH")


@query
def comment_rate(spark, sf_dir):
    return metrics.comment_rate(_staged(spark, sf_dir))


@query
def comment_rate_per_day(spark, sf_dir):
    return metrics.comment_rate(_staged(spark, sf_dir), period="DAY")


@query
def peak_hours(spark, sf_dir):
    return metrics.peak_hours(_staged(spark, sf_dir))


@query
def comment_velocity(spark, sf_dir):
    return metrics.comment_velocity(_stored_staged(spark, sf_dir))


@query
def lifetime_curve(spark, sf_dir):
    return metrics.lifetime_curve(_stored_staged(spark, sf_dir))


@query
def author_cohorts(spark, sf_dir):
    return metrics.author_cohorts(_staged(spark, sf_dir))


@query
def author_features(spark, sf_dir):
    return metrics.author_features(_stored_staged(spark, sf_dir))


# Data quality


@query
def dq_not_null(spark, sf_dir):
    return quality.not_null(_staged(spark, sf_dir), "author").select("item_id", "item_type", "created_at")


@query
def dq_unique(spark, sf_dir):
    return quality.unique(feed.feed(spark, sf_dir), "item_id")


@query
def dq_unique_one_day(spark, sf_dir):
    return quality.unique(feed.event_items(spark, sf_dir), "item_id", "ingest_date = '2024-01-05'")


@query
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(_staged(spark, sf_dir), "item_type", ["story", "comment"])


@query
def dq_relationships(spark, sf_dir):
    staged = _stored_staged(spark, sf_dir)
    return quality.relationships(staged, "parent_id", staged.filter("item_type = 'story'"), "item_id")


@query
def dq_report(spark, sf_dir):
    silver_items = feed.feed(spark, sf_dir)
    with small_splits(spark), dropped_shuffles(spark):
        staged = stored(staging.staged_items(silver_items, ["title", "url"]), compression="zstd")
    items = dims.dim_items(staged, with_text=False)  # row by row from staging, so not stored again
    with dropped_shuffles(spark):
        users, stories = (stored(df, compression="zstd") for df in (dims.dim_users(staged), facts.fct_stories(staged)))
        view = stored(facts.story_analytics(stories, items.filter("item_type = 'story'"), users), compression="zstd")
    models = {"stg_items": staged, "dim_items": items, "dim_users": users, "fct_stories": stories}
    models["dim_dates"] = dims.dim_dates(spark)  # begins after the first orders, which the report shows
    models["daily_story_metrics"] = marts.daily_story_metrics(stories)
    models["daily_active_authors"] = marts.daily_active_authors(stories)
    models["story_analytics"] = view
    # The parsed items before deduplication, against checks that do find something.
    models["parsed_items"] = silver_items
    raw_checks = {
        "item_id": ["not_null", "unique", ("where", "ingest_date = '1996-03-13'", "unique")],
        "author": [
            "not_null",
            ("in", "dim_users", "user_name"),
            ("where", "item_type = 'job'", "not_null"),
            ("where", "item_type = 'comment'", ("in", "dim_items", "item_id")),
        ],
        "item_type": [("accepted", ["story"])],
    }
    return quality.run_checks(models, {**quality.CHECKS, "parsed_items": raw_checks})


@query
def dq_missing_rates(spark, sf_dir):
    return quality.missing_rates(feed.feed(spark, sf_dir))


@query
def dq_missing_days(spark, sf_dir):
    items = feed.feed(spark, sf_dir)
    return quality.missing_days(items.filter("item_type = 'job'"), dims.observed_dates(items))


@query
def dq_latency(spark, sf_dir):
    events = feed.table(spark, sf_dir, "events").select(
        day_string("ts").alias("ingest_date"), F.col("ts").cast("timestamp").alias("written_at")
    )
    return quality.ingestion_latency(events, events.agg(F.max("written_at")).scalar(), "ingest_date", "written_at")


@query
def dq_volumes(spark, sf_dir):
    return quality.ingestion_volumes(feed.feed(spark, sf_dir))


# Landing and parsing


@query
def id_chunks(spark, sf_dir):
    orders = feed.table(spark, sf_dir, "orders")
    last, newest = orders.agg(F.count_if(F.col("o_orderstatus") == "F"), F.max("o_orderkey")).first()
    return bronze.id_chunks(spark, last, newest, chunk_size=1000, items_per_run=None)


@query
def run_ids_with_landed_lines(spark, sf_dir):
    lines = feed.event_lines(spark, sf_dir)
    landed = lines.withColumn("item_id", F.get_json_object("value", "$.id").cast("bigint"))
    newest = feed.table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    found = bronze.enrich_from_landed(bronze.run_ids(spark, -1, newest, items_per_run=None), landed)
    event = F.get_json_object("value", "$.title")
    return found.select("item_id", F.col("value").isNotNull().alias("landed"), event.alias("title"))


@query
def missing_ids(spark, sf_dir):
    labels = feed.table(spark, sf_dir, "labels")
    newest = feed.table(spark, sf_dir, "documents").agg(F.max("doc_id")).first()[0]
    return bronze.missing_ids(spark, labels, 0, newest, "doc_id")


@query
def parse_lines(spark, sf_dir):
    """Event lines, and whole document texts as lines that are no JSON."""
    texts = feed.table(spark, sf_dir, "documents").select(
        F.col("text").alias("value"),
        F.concat(F.lit("documents-"), F.col("doc_id").cast("string")).alias("source_file"),
        F.lit("1997-01-01").alias("ingest_date"),
    )
    return silver.parse_items(feed.event_lines(spark, sf_dir).unionByName(texts))


@query
def landing_roundtrip(spark, sf_dir):
    root = new_dir(spark, "bronze")
    bronze.land_items(feed.event_lines(spark, sf_dir), root)
    items = silver.parse_items(bronze.landed_lines(spark, root))
    return items.select("item_id", "author", "created_at", "score", "ingest_date")


@query
def landed_manifest(spark, sf_dir):
    """File names differ from run to run, so the manifests are summed up per day."""
    root = new_dir(spark, "bronze")
    bronze.land_items(feed.event_lines(spark, sf_dir), root)
    files = bronze.manifest(bronze.landed_lines(spark, root), "events")
    return files.groupBy(bronze.day_of_path(F.col("path")).alias("ingest_date")).agg(
        F.sum("item_count").alias("item_count"),
        F.min("id_range.start").alias("start_id"),
        F.max("id_range.end").alias("end_id"),
    )


@query
def landed_days(spark, sf_dir):
    root = new_dir(spark, "bronze")
    bronze.land_items(feed.event_lines(spark, sf_dir), root)
    return bronze.landed_days(bronze.landed_files(spark, root))


def _landed_days(spark, sf_dir):
    """Events as files: one per event, its value in cents as size."""
    return bronze.day_totals(
        feed.table(spark, sf_dir, "events").select(
            day_string("ts").alias("ingest_date"), F.round(F.col("value") * 100).cast("bigint").alias("length")
        )
    )


@query
def changed_days(spark, sf_dir):
    """Events as files against files known before: some new, some of another length, some gone, some days unknown."""
    day, number = F.col("ingest_date"), F.col("event_id")
    events = feed.table(spark, sf_dir, "events").withColumn("ingest_date", day_string("ts"))
    length = F.round(F.col("value") * 100).cast("bigint")
    files = events.select("ingest_date", "event_id", number.cast("string").alias("path"), length.alias("length"))
    known = files.filter((day < "2024-01-26") & ~((day < "2024-01-06") & (number % 7 == 0)))
    known = known.withColumn("length", F.col("length") + F.when((day < "2024-01-06") & (number % 7 == 1), 5000).otherwise(0))
    gone = files.filter((day >= "2024-01-16") & (day < "2024-01-26") & (number % 5 == 0))
    known = known.unionByName(gone.withColumn("path", F.concat(F.lit("gone-"), "path")))
    return bronze.compare_files(files, known)


@query
def landed_backlog(spark, sf_dir):
    """A backlog of twice as many ids as line items, taken in bounded runs; look-ups fail and succeed the next time."""
    root, mark = new_dir(spark, "bronze"), new_dir(spark, "mark")
    newest = 2 * feed.table(spark, sf_dir, "lineitem").count()

    def down(item_id):
        if item_id % 97 == 0:
            raise OSError("down")
        return {"id": item_id}

    def up(item_id):
        return {"id": item_id}

    per_run = -(-newest // 3)
    for lookup in (down, up, down, up):
        land_new_items(spark, root, mark, newest, lookup, dt.date(2024, 1, 1), items_per_run=per_run)
    ids = bronze.landed_lines(spark, root).select(F.get_json_object("value", "$.id").cast("bigint").alias("item_id"))
    return (
        ids.groupBy(F.floor(F.col("item_id") / 1000).cast("bigint").alias("thousand"), "item_id")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .groupBy("thousand")
        .agg(F.sum("n_lines").alias("n_lines"), F.count("item_id").alias("n_ids"))
        .withColumn("mark", F.lit(control.read_mark(spark, mark)).cast("bigint"))
    )


@query
def high_water_mark(spark, sf_dir):
    """The newest order of each status as the mark of one run after the other, in any order."""
    path = new_dir(spark, "mark")
    newest = feed.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.max("o_orderkey").alias("m"))
    for row in newest.orderBy("o_orderstatus").collect():
        control.write_mark(spark, path, row.m)
    return spark.range(1).select(F.lit(control.read_mark(spark, path)).cast("bigint").alias("last_id"))


@query
def landed_without_empty(spark, sf_dir):
    """Lines of which every other one is empty in one of five ways: none of those is landed."""
    root, number = new_dir(spark, "bronze"), F.get_json_object("value", "$.id").cast("bigint") % 10
    empty = F.element_at(F.array(F.lit(None), F.lit(""), F.lit("null"), F.lit("{}"), F.lit("  ")), (number + 1).cast("int"))
    lines = feed.event_lines(spark, sf_dir).withColumn("value", F.when(number >= 5, F.col("value")).otherwise(empty))
    bronze.land_items(lines, root)
    return bronze.landed_lines(spark, root).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_lines"))


@query
def built_models(spark, sf_dir):
    """All models stored as tables of two schemas and read back by name."""
    schemas = [f"{name}_{uuid.uuid4().hex}" for name in ("silver", "gold")]
    for name in schemas:
        spark.sql(f"CREATE DATABASE {name} LOCATION '{new_dir(spark, 'tables')}'")
    build_models(feed.feed(spark, sf_dir), *schemas)
    names = ["dim_items", "dim_users", "fct_stories", "daily_story_metrics", "daily_active_authors", "story_analytics"]
    tables = {"stg_items": f"{schemas[0]}.stg_items"} | {n: f"{schemas[1]}.{n}" for n in names}
    counts = [spark.table(t).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("model", F.lit(n)) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts).select("model", "n_rows")


#: What each model of a release is summed up to, beside its rows.
_TOTALS = {
    "stg_items": "sum(score)",
    "dim_items": "sum(text_length)",
    "dim_users": "sum(total_posts_count)",
    "fct_stories": "sum(created_date_key + coalesce(total_comments, 0))",
    "daily_story_metrics": "sum(stories_per_day * median_story_score)",
    "daily_active_authors": "sum(active_authors_per_day)",
    "story_analytics": "sum(length(story_domain) + score)",
}


@query
def published_models(spark, sf_dir):
    """What readers get after a first build, a second one, a third that dies between two models, and going back."""
    root, everything, seen = new_dir(spark, "releases"), feed.feed(spark, sf_dir), {}
    publish_models(everything.filter("source_file <> 'documents'"), root, 1)
    seen["first build"] = releases.read(spark, root)
    publish_models(everything, root, 2)
    seen["second build"] = releases.read(spark, root)
    releases.write_table(_staged(spark, sf_dir).limit(0), root, 3, "stg_items")
    seen["third build died"] = releases.read(spark, root)
    releases.move_to(spark, root, 1)
    seen["went back"] = releases.read(spark, root)
    parts = [
        models[name].agg(F.count(F.lit(1)).alias("n_rows"), F.expr(total).cast("bigint").alias("total"))
        .select(F.lit(step).alias("step"), F.lit(name).alias("model"), "n_rows", "total")
        for step, models in seen.items()
        for name, total in _TOTALS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def replaced_days(spark, sf_dir):
    """Days written once, then those of the errors again without the errors: others stay whole."""
    path = new_dir(spark, "silver")
    items = feed.event_items(spark, sf_dir)
    silver.write_items(items, path)
    late = items.filter("created_at >= '2024-01-10' AND created_at < '2024-01-20'")
    silver.write_items(late.withColumn("score", F.col("score") + 1000), path)
    stored = silver.read_items(spark, path)
    return stored.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("score").alias("score"))


@query
def raw_to_daily_metrics(spark, sf_dir):
    """Land, parse the changed days, deduplicate, build the fact and the daily mart."""
    root, path, state = (new_dir(spark, name) for name in ("bronze", "silver", "state"))
    bronze.land_items(feed.event_lines(spark, sf_dir), root)
    parse_changed_days(spark, root, path, state, run_id=1)
    staged = stored(staging.staged_items(silver.read_items(spark, path), []))
    return marts.daily_story_metrics(facts.fct_stories(staged))


@query
def incremental_marts(spark, sf_dir):
    """Two deliveries: all days without some of their items, then those of six days as a whole, two of them emptied
    and filled again in between. The marts are brought up to date from the days that changed."""
    path, store = new_dir(spark, "silver"), new_dir(spark, "marts")
    items = feed.event_discussion(spark, sf_dir)
    late = [f"2024-01-{d:02d}" for d in (3, 4, 10, 17, 29, 30)]
    held_back = F.col("ingest_date").isin(late) & (F.col("descendants") % 3 == 0)
    silver.write_items(items.filter(~held_back & (F.col("ingest_date") < "2024-01-30")), path)
    every = [r.ingest_date for r in silver.read_items(spark, path).select("ingest_date").distinct().collect()]
    incremental.refresh(spark, silver.read_items(spark, path), every, store, run=1, ids_per_part=1000)
    nothing = silver.read_items(spark, path).limit(0)
    incremental.refresh(spark, nothing, late[:2], store, run=2, ids_per_part=1000)
    silver.write_items(items.filter(F.col("ingest_date").isin(late)), path)
    incremental.refresh(spark, silver.read_items(spark, path), late, store, run=3, ids_per_part=1000)
    metrics_of_day = incremental.daily_story_metrics(spark, store)
    return metrics_of_day.join(incremental.daily_active_authors(spark, store), "story_date")


@query
def day_state(spark, sf_dir):
    """State of two runs: all days, then the days of the second half with other figures."""
    path = new_dir(spark, "state")
    totals = _landed_days(spark, sf_dir)
    control.write_day_state(totals, path, run_id=1)
    again = totals.filter("ingest_date >= '2024-01-16'").withColumn("file_count", F.col("file_count") + 1)
    control.write_day_state(again, path, run_id=2)
    return control.read_day_state(spark, path)


# Threads


@query
def conversation_threads(spark, sf_dir):
    turns = feed.table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    items = turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("item_id"),
        F.when(F.col("turn") > 0, F.col("conv_id") * 1000 + F.col("turn") - 1).alias("parent_id"),
        F.when(F.col("turn") == 0, "story").otherwise("comment").alias("item_type"),
    )
    return expand_threads(items)


def _event_tree(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    parent = F.col("event_id") - 1 - k
    return feed.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("item_id"),
        F.when(parent >= 0, parent).alias("parent_id"),
        F.when(parent >= 0, "comment").when(k > 60, "poll").otherwise("story").alias("item_type"),
    )


@query
def event_threads(spark, sf_dir):
    """Each event answers the one k + 1 places before it: deep, uneven trees."""
    return expand_threads(_event_tree(spark, sf_dir))


@query
def threads_by_delivery(spark, sf_dir):
    """The items of event_threads in three deliveries, children often before their parents, some delivered twice."""
    store, number = new_dir(spark, "threads"), F.col("item_id")
    items = stored(_event_tree(spark, sf_dir))
    for run, part in enumerate((number % 3 == 2, number % 3 == 0, (number % 3 == 1) | (number % 10 == 0))):
        thread_store.add_items(spark, items.filter(part), store, run, ids_per_part=5000)
    return thread_store.read_threads(spark, store)


# Streams


@query
def stream_landed_to_silver(spark, sf_dir):
    root, path, checkpoint = (new_dir(spark, name) for name in ("bronze", "silver", "progress"))
    bronze.land_items(feed.event_lines(spark, sf_dir), root)
    jobs.append_parsed(jobs.landed_stream(spark, root), path, checkpoint).awaitTermination()
    return silver.read_items(spark, path).select("item_id", "author", "created_at", "score", "ingest_date")


@query
def stream_unique_deliveries(spark, sf_dir):
    """Items delivered with copies in one delivery and again in the next: each is appended once."""
    path, checkpoint, arriving = (new_dir(spark, name) for name in ("unique", "progress", "arriving"))
    items = feed.event_items(spark, sf_dir)
    early, again = F.col("descendants") < 60, F.col("descendants") % 3 == 0
    for part in (items.filter(early).unionByName(items.filter(early & again)), items.filter(~early | again)):
        part.write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(items.schema).parquet(arriving)
        jobs.append_unique(stream, path, checkpoint, within="1 day").awaitTermination()
    return spark.read.schema(items.schema).parquet(path).select("item_id", "created_at", "score", "source_file")


@query
def stream_late_days(spark, sf_dir):
    """Signups land in a second delivery; their days are parsed again as a whole."""
    root, path, checkpoint = (new_dir(spark, name) for name in ("bronze", "silver", "progress"))
    lines = feed.event_lines(spark, sf_dir)
    late = F.get_json_object("value", "$.title").startswith("[signup]")
    for part in (~late, late):
        bronze.land_items(lines.filter(part), root)
        jobs.reload_touched_days(jobs.landed_stream(spark, root), root, path, checkpoint).awaitTermination()
    return silver.read_items(spark, path).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("score").alias("score")
    )


@query
def stream_current_items(spark, sf_dir):
    """Item states delivered in two parts, merged into a table of the newest state per item."""
    path, checkpoint, arriving = (new_dir(spark, name) for name in ("current", "progress", "arriving"))
    items = feed.event_items(spark, sf_dir)
    for part in ("descendants >= 50", "descendants < 50"):
        items.filter(part).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(items.schema).parquet(arriving)
        jobs.maintain_current(stream, path, checkpoint, ids_per_bucket=1000).awaitTermination()
    return jobs.read_current(spark, path).select("item_id", "author", "created_at", "score", "ingest_date")


@query
def stream_daily_metrics(spark, sf_dir):
    """Stories delivered in two parts, the older ones last, and some twice."""
    path, checkpoint, arriving = (new_dir(spark, name) for name in ("daily", "progress", "arriving"))
    stories = stored(_facts(spark, sf_dir))
    for part in ("created_at >= '1996-01-01' OR score % 3 = 0", "created_at < '1996-01-01' OR score % 5 = 0"):
        stories.filter(part).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(stories.schema).parquet(arriving)
        jobs.maintain_daily(stream, path, checkpoint).awaitTermination()
    return jobs.read_daily(spark, path)
