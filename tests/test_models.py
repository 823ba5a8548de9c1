import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from forumlake.constants import UNKNOWN_USER_KEY, UNKNOWN_USER_NAME
from forumlake.functions import surrogate_key
from forumlake.plans import dashboard, dims, facts, marts, metrics, quality, staging
from forumlake.plans.pipeline import build_models, check_models, dashboard_queries
from forumlake.schemas import SILVER
from forumlake.session import SPLIT_BYTES, dropped_shuffles, small_splits, stored
from forumlake_checks import queries

T0 = dt.datetime(2025, 10, 5, 12, 0, 0)


def item(item_id, kind, author=None, at=0, parent=None, score=None, url=None, title=None, day="2025-10-05", file="f1"):
    return (item_id, kind, author, T0 + dt.timedelta(seconds=at), title, None, url, parent, score, None, day, file, day)


ITEMS = [
    item(1, "story", "ann", score=1, url="https://a.com/x", title="one"),
    item(2, "story", "bob", score=2, url="http://www.b.org?y", title="two"),
    item(3, "story", None, score=3, title="three"),
    item(4, "story", "ann", at=60, score=10, title="one"),
    item(5, "job", "cat", score=7),
    item(11, "comment", "bob", at=59, parent=1),
    item(12, "comment", "cat", at=60, parent=2),
    item(13, "comment", "cat", at=90, parent=2),
    item(14, "comment", "ann", at=95, parent=12),
    item(15, "comment", "ann", at=-30, parent=4),
    item(16, "comment", "ann", at=5, parent=999),
    item(17, "comment", "dan", at=5, parent=5),
    item(18, "comment", "dan", at=5),
    item(2, "story", "bob", score=1, title="old two", day="2025-10-04"),
    item(4, "story", "ann", at=60, score=9, title="one", file="f0"),
]


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(ITEMS, SILVER)


@pytest.fixture(scope="module")
def staged(silver):
    return staging.staged_items(silver).cache()


def key(spark, value):
    return spark.range(1).select(surrogate_key(F.lit(value))).first()[0]


def test_staging(staged):
    assert staged.count() == 13
    assert {r.item_id: r.score for r in staged.filter("item_type = 'story'").collect()} == {1: 1, 2: 2, 3: 3, 4: 10}


def test_staging_without_texts(spark, rows):
    """Versions of one file that differ in texts, or in more than texts."""
    data = [
        item(1, "story", score=2, title="b"), item(1, "story", score=2, title="a"), item(1, "story", score=1, title="z"),
        item(2, "story", score=5, url="x"), item(2, "story", score=5, url="y"), item(None, None), item(None, "job"),
    ]
    silver = spark.createDataFrame(data, SILVER)
    whole = staging.staged_items(silver)
    assert rows(whole, "item_id", "title", "url") == sorted([(1, "b", None), (2, None, "y"), (None, None, None)], key=str)
    for texts in ([], ["title"], ["title", "url"]):
        narrow = staging.staged_items(silver, texts)
        assert rows(narrow) == rows(whole, *narrow.columns)
    with pytest.raises(ValueError):
        staging.staged_items(silver, ["url"])


def test_comments_on_stories(staged, rows):
    assert rows(staging.comments_on(staged), "item_id") == [(11,), (12,), (13,), (15,)]
    assert rows(staging.comments_on(staged, min_rows=1, max_keys=50), "item_id") == [(11,), (12,), (13,), (15,)]


def test_fact(spark, staged):
    fact = facts.fct_stories(staged)
    by_key = {r.item_key: r for r in fact.collect()}
    got = {i: by_key[key(spark, str(i))] for i in (1, 2, 3, 4)}
    assert len(by_key) == 4
    assert [got[i].total_comments for i in (1, 2, 3, 4)] == [1, 2, None, 1]
    assert [got[i].time_to_first_comment_minutes for i in (1, 2, 3, 4)] == [0, 1, None, -1]
    assert got[3].user_key == UNKNOWN_USER_KEY and got[1].user_key == key(spark, "ann")
    assert got[1].created_date_key == 20251005


def test_fact_with_lookups_equals_fact(staged, rows):
    items, users = dims.dim_items(staged), dims.dim_users(staged)
    expected = rows(facts.fct_stories(staged))
    assert rows(facts.fct_stories_joined(staged, items, users)) == expected
    assert rows(facts.fct_stories_joined(staged, items, users, min_rows=1, max_keys=50)) == expected


def test_author_named_like_the_unknown_member(spark, staged):
    """The lookup is then ambiguous; the uniqueness check says so."""
    odd = spark.createDataFrame([item(50, "story", UNKNOWN_USER_NAME)], SILVER).select(staged.columns)
    more = staged.unionByName(odd)
    users = dims.dim_users(more)
    assert [r.value for r in quality.unique(users, "user_name").collect()] == [UNKNOWN_USER_NAME]
    joined = facts.fct_stories_joined(more, dims.dim_items(more), users)
    assert joined.count() == facts.fct_stories(more).count() + 2
    # The models then keep the look-up, and the checks report it.
    silver = more.select(*SILVER.names)
    models = build_models(silver, "o_silver", "o_gold")
    assert models["fct_stories"].count() == joined.count()
    reported = {(r.model, r["column"], r.check) for r in check_models(models).collect()}
    assert ("dim_users", "user_name", "unique") in reported and ("fct_stories", "item_key", "unique") in reported


def test_users(spark):
    data = [
        item(1, "story", "once"),
        item(2, "story", "midnight", at=12 * 3600 - 60), item(3, "comment", "midnight", at=35 * 3600 - 60),
        item(4, "story", "day"), item(5, "poll", "day", at=24 * 3600),
        item(6, "story", None),
    ]
    users = {r.user_name: r for r in dims.dim_users(spark.createDataFrame(data, SILVER)).collect()}
    assert {n: (u.author_lifetime_days, u.total_posts_count) for n, u in users.items()} == {
        "once": (0, 1), "midnight": (0, 2), "day": (1, 2), UNKNOWN_USER_NAME: (None, 0),
    }
    assert users[UNKNOWN_USER_NAME].first_post_at_ts is None


def test_marts(spark, staged):
    fact = facts.fct_stories(staged)
    day = marts.daily_story_metrics(fact).collect()
    assert [tuple(r) for r in day] == [(dt.date(2025, 10, 5), 4, 4 / 3, 2)]
    assert marts.daily_active_authors(fact).first().active_authors_per_day == 3
    assert marts.daily_median_score(fact).first().median_story_score == 2
    skewed = spark.createDataFrame([(T0, s) for s in (1, 2, 3, 10, None)], "created_at timestamp, score long")
    skewed = skewed.withColumn("item_key", F.lit("k")).withColumn("total_comments", F.lit(None).cast("long"))
    assert marts.daily_story_metrics(skewed).first().median_story_score == 2


def test_view_and_dashboard(staged, rows):
    fact, items, users = facts.fct_stories(staged), dims.dim_items(staged), dims.dim_users(staged)
    view = facts.story_analytics(fact, items, users)
    assert rows(facts.story_analytics(fact, items, users, min_rows=1, max_keys=50)) == rows(view)
    assert len(view.columns) == 14
    assert rows(view, "item_id", "story_domain") == [(1, "a.com"), (2, "www.b.org"), (3, "N/A"), (4, "N/A")]
    shown = dashboard_queries(view, "2025-10-05", "2025-10-05")
    assert tuple(shown["kpi_tiles"].first()) == (4, 3, 4 / 3, 0.0)
    assert tuple(shown["activity_trend"].first()) == (dt.date(2025, 10, 5), 4, 3)
    assert [tuple(r) for r in shown["top_stories"].collect()][0] == ("one", "ann", 11, 2)
    assert [r.user_name for r in shown["top_authors"].collect()] == ["ann", UNKNOWN_USER_NAME, "bob"]
    assert shown["top_domains"].first().story_domain == "N/A"
    assert dashboard.kpi_tiles(dashboard.in_date_range(view, "2025-10-06")).first().total_stories == 0
    assert dashboard.drill_down(staged, "2025-10-05", "story", "ann").count() == 2


def test_metrics(staged, rows):
    fact = facts.fct_stories(staged)
    assert rows(metrics.author_scores(fact), "total_score", "rank") == [(11, 1), (2, 3), (3, 2)]
    scored = metrics.with_author_score(fact, min_rows=1, max_keys=50)
    assert rows(scored, "score", "author_score") == rows(metrics.with_author_score(fact), "score", "author_score")
    assert rows(scored, "score", "author_score") == [(1, 11), (10, 11), (2, 2), (3, 3)]
    assert tuple(metrics.minutes_to_first_comment(fact).first()) == (0.0, 3)
    assert tuple(metrics.engagement(staged).first()) == (4, 3, 3, 75.0)
    assert tuple(metrics.comment_rate(staged).first()) == (8, 4, 2.0)
    curve = [(-1, 1, 1), (0, 1, 2), (1, 2, 4)]
    assert rows(metrics.lifetime_curve(staged, "MINUTE")) == curve
    assert rows(metrics.lifetime_curve(staged, "MINUTE", min_rows=1, max_keys=50)) == curve
    best = metrics.comment_velocity(staged, as_of="2025-10-05 16:30:00").collect()
    assert [(r.item_id, r.hours, r.comments_per_hour) for r in best] == [(2, 4, 0.5), (4, 4, 0.25), (1, 4, 0.25)]
    ann = metrics.author_features(staged).filter("author = 'ann'").first()
    assert (ann.posts, ann.stories, ann.comments, ann.story_score, ann.best_score, ann.replies_received) == (5, 2, 3, 11, 10, 2)


def test_engagement_window(spark):
    week = 7 * 86400
    data = [item(1, "story"), item(2, "story"), item(3, "comment", at=week, parent=1), item(4, "comment", at=week + 1, parent=2)]
    assert tuple(metrics.engagement(spark.createDataFrame(data, SILVER)).first()) == (2, 2, 1, 50.0)
    assert metrics.engagement(spark.createDataFrame([], SILVER)).first().engaged_pct is None
    assert metrics.comment_rate(spark.createDataFrame(data[2:], SILVER)).first().comments_per_story is None


def test_checks(spark, staged, silver, rows):
    assert quality.not_null(staged, "author").count() == 1
    assert rows(quality.unique(silver, "item_id")) == [(2, 2), (4, 2)]
    assert quality.unique(silver, "item_id", "ingest_date = '2025-10-04'").count() == 0
    assert rows(quality.accepted_values(staged, "item_type", ["story", "comment"])) == [("job", 1)]
    assert rows(quality.relationships(staged, "parent_id", staged, "item_id")) == [(999, 1)]
    rates = {r.ingest_date: r for r in quality.missing_rates(silver).collect()}
    assert rates["2025-10-05"].author_missing_rate == 1 / 14 and rates["2025-10-04"].n_rows == 1
    calendar = dims.dim_dates(spark, "2025-10-03", "2025-10-07")
    assert rows(quality.missing_days(silver, calendar)) == [(dt.date(2025, 10, 3),), (dt.date(2025, 10, 6),)]
    written = spark.createDataFrame([("a", T0), ("a", T0 - dt.timedelta(hours=1))], "f string, at timestamp")
    late = quality.ingestion_latency(written, T0 + dt.timedelta(minutes=2), "f", "at")
    assert late.first().latency_seconds == 120
    assert rows(quality.ingestion_volumes(silver)) == [("2025-10-04", 1, 1, 0), ("2025-10-05", 14, 2, 0)]


def test_checks_compare_texts(spark):
    """Numbers and keys travel in other forms than their text; equal are those whose texts are equal, and no others."""
    key = "0123456789abcdef0123456789abcdef"
    texts = [
        "5", "5", "05", " 5", "+5", "-0", "0", "5\n", "9223372036854775807", "9223372036854775808", "99999999999999999999",
        key, key, key.upper(), key + "\n", key[:30], "30" * 16, "00", "", "", None, None, "\u00a7", "null",
    ]
    texts = spark.createDataFrame([(t,) for t in texts], "t string")
    numbers = spark.createDataFrame([(n,) for n in (5, 0, 9223372036854775807, -1, None)], "n long")
    small = spark.createDataFrame([(5,), (5,), (7,)], "n int")
    keys = spark.createDataFrame([(key,), (key.upper(),), ("",), (None,), ("30" * 16,)], "k string")
    models = {"texts": texts, "numbers": numbers, "small": small, "keys": keys}
    checks = {
        "texts": {"t": ["unique", "not_null", ("in", "numbers", "n"), ("in", "keys", "k"), ("where", "t <> '5'", ("in", "numbers", "n"))]},
        "numbers": {"n": ["unique", "not_null", ("in", "texts", "t"), ("in", "small", "n")]},
        "small": {"n": ["unique", ("in", "numbers", "n"), ("accepted", [5])]},
    }
    found = quality.run_checks(models, checks).collect()
    assert len(found) == 12
    for model, column, label, (name, *arguments), where in quality._declared(checks):
        if name == "unique":
            expected = quality.unique(models[model], column, where)
        elif name == "not_null":
            expected = quality.not_null(models[model], column, where)
        elif name == "accepted":
            expected = models[model].filter(~F.col(column).isin(arguments[0]))
        else:
            child, parent = (models[m].select(F.col(c).cast("string").alias("v"), "*") for m, c in ((model, column), arguments))
            expected = quality.relationships(child, "v", parent, "v", where)
        got = [r.failures for r in found if (r.model, r["column"], r.check) == (model, column, label)]
        assert expected.count() in got, (model, column, label, got)


def _shuffled_bytes(df):
    """Bytes that the exchanges of a DataFrame wrote when it was collected."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_values_to_check_travel_once_and_packed(spark, monkeypatch):
    """A key that is unique and referred to is one value of 16 bytes in the shuffle, not two texts of 32."""
    n, summed = 20_000, []
    parent = spark.range(n).select(surrogate_key("id").alias("key"))
    child = parent.select(F.col("key").alias("of"))
    checks = {"parent": {"key": ["unique"]}, "child": {"of": ["unique", ("in", "parent", "key")]}}
    monkeypatch.setattr(quality, "stored", lambda df: summed.append(df) or df, raising=False)
    report = quality.run_checks({"parent": parent, "child": child}, checks)
    assert [r.failures for r in report.collect()] == [0, 0, 0]
    assert _shuffled_bytes(summed[0] if summed else report) < 2 * n * 28


def test_report_stores_no_item_twice(spark, monkeypatch, tmp_path):
    """Items are staging row by row; stored tables are packed, and staging's tasks read a bounded number of bytes."""
    tables = {
        "orders": "1L o_orderkey, 2L o_custkey, 'O' o_orderstatus, 9.5D o_totalprice, TIMESTAMP_NTZ '1996-03-13 00:00:00' o_orderdate, '1-URGENT' o_orderpriority",
        "lineitem": "1L l_orderkey, 3L l_partkey, 4L l_suppkey, 1 l_linenumber, 1D l_quantity, 2D l_extendedprice, TIMESTAMP_NTZ '1996-03-14 00:00:00' l_shipdate, 'A' l_returnflag",
        "pages": "1L page_id, 'https://a.com/x' url, '<p>' html",
        "documents": "1L doc_id, 'a b' text, 'en' lang, 'src1' source, 3L n_chars",
    }
    for name, row in tables.items():
        spark.sql(f"SELECT {row}").write.parquet(f"{tmp_path}/{name}.parquet")
    written = []

    def stored(df, **options):
        written.append((set(df.columns), options, int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b"))))
        return df

    monkeypatch.setattr(queries, "stored", stored)
    report = queries.QUERIES["dq_report"](spark, str(tmp_path))
    failing = {(r.model, r["column"], r.check): r.failures for r in report.collect() if r.failures}
    assert failing == {
        ("fct_stories", "created_date_key", "relationships"): 3,
        ("parsed_items", "author", "relationships where item_type = 'comment'"): 1,
        ("parsed_items", "item_type", "accepted_values"): 1,
    }
    assert not [c for c, _, _ in written if {"item_key", "domain", "has_url"} <= c]
    assert [options for _, options, _ in written] == [{"compression": "zstd"}] * 4
    assert written[0][2] <= SPLIT_BYTES


def test_small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, within in (("134217728b", str(SPLIT_BYTES)), ("1m", "1m"), ("1GB", str(SPLIT_BYTES)), ("4096", "4096")):
            spark.conf.set(key, given)
            with pytest.raises(ValueError), small_splits(spark):
                assert spark.conf.get(key) == within
                raise ValueError
            assert spark.conf.get(key) == given
    finally:
        spark.conf.set(key, before)


def test_dropped_shuffles(spark):
    """Shuffle files are gone when the table is stored, not when the driver's garbage is collected."""

    def files():
        folder = spark._jvm.org.apache.spark.util.Utils.getConfiguredLocalDirs(spark.sparkContext._jsc.sc().conf())[0]
        return {f for f in glob.glob(f"{folder}/**/shuffle_*.data", recursive=True) if os.path.getsize(f)}

    grouped = spark.range(100_000).groupBy("id").count()
    before = files()
    with dropped_shuffles(spark):
        kept = stored(grouped)
    for _ in range(100):  # files are deleted in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert kept.count() == 100_000


def test_build_models(spark, silver, rows):
    models = build_models(silver, "t_silver", "t_gold", buckets=4)
    assert check_models(models).count() == 0
    assert spark.table("t_gold.daily_story_metrics").count() == 1
    assert spark.table("t_gold.story_analytics").count() == 4
    assert spark.table("t_gold.dim_dates").count() == 7669
    again = rows(models["fct_stories"])
    build_models(silver, "t_silver", "t_gold", buckets=4)
    assert rows(spark.table("t_gold.fct_stories")) == again


def test_bucketed_tables_join_without_shuffle(spark, silver):
    models = build_models(silver, "b_silver", "b_gold", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = models["fct_stories"].join(models["dim_items"], "item_key", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
