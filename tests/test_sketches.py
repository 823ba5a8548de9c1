import datetime as dt

import pytest
from pyspark.sql import functions as F

from forumlake.plans import metrics, sketches
from forumlake.schemas import SILVER

COLUMNS = "created_at_date date, item_id long, user_key string, score long, total_comments long, time_to_first_comment_minutes long"


@pytest.fixture(scope="module")
def many(spark):
    """300,000 stories over 300 days, 60,000 authors, a third of the stories by one of them."""
    view = spark.range(300_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int")).alias("created_at_date"),
        F.col("id").alias("item_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(60_000)))).alias("user_key"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)).alias("score"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("total_comments"),
        F.when(F.col("id") % 4 > 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(5_000))).alias("time_to_first_comment_minutes"),
    )
    return view, sketches.day_summaries(view).cache()


def test_tiles_of_any_range(many):
    view, days = many
    for first, last in ((None, None), ("2024-02-01", "2024-02-10"), ("2024-03-01", "2024-03-01")):
        shown = sketches.in_date_range(view, first, last)
        exact = shown.agg(
            F.count_distinct("item_id"), F.count_distinct("user_key"), F.avg("total_comments"), F.avg("time_to_first_comment_minutes")
        ).first()
        near = sketches.kpi_tiles(days, first, last).first()
        assert abs(near.total_stories - exact[0]) <= 0.03 * exact[0]
        assert abs(near.active_authors - exact[1]) <= 0.03 * exact[1]
        assert (near.avg_comments_per_story, near.avg_minutes_to_first_comment) == pytest.approx(tuple(exact[2:]))


def test_quantiles_of_any_range(many):
    view, days = many
    for first, last in ((None, None), ("2024-02-01", "2024-05-10")):
        for value, sketch in (("score", "score_sketch"), ("time_to_first_comment_minutes", "minutes_sketch")):
            near = sketches.quantiles(days, sketch, {"q10": 0.1, "median": 0.5, "p90": 0.9}, first, last).first()
            shown = sketches.in_date_range(view, first, last).filter(f"{value} IS NOT NULL")
            for share, estimate in zip((0.1, 0.5, 0.9), near, strict=True):
                below = shown.agg(F.avg((F.col(value) <= estimate).cast("int"))).first()[0]
                assert abs(below - share) <= 0.01


def test_authors_of_two_ranges(many):
    view, days = many
    one, other = ("2024-01-01", "2024-03-31"), ("2024-03-01", "2024-06-30")
    sets = [{r[0] for r in sketches.in_date_range(view, *x).select("user_key").distinct().collect()} for x in (one, other)]
    exact = len(sets[0]), len(sets[1]), len(sets[0] & sets[1]), len(sets[0] - sets[1])
    for found, wanted in zip(sketches.authors_of_both(days, one, other).first(), exact, strict=True):
        assert abs(found - wanted) <= 0.03 * len(sets[0] | sets[1])


def test_few_values_are_exact_and_none_is_zero(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, 1, "a", 5, None, None), (day, 2, "a", 7, 2, 10), (day, 2, "b", None, 4, None), (None, 3, "c", 1, 1, 1)]
    days = sketches.day_summaries(spark.createDataFrame(rows, COLUMNS))
    assert tuple(sketches.kpi_tiles(days).first()) == (3, 3, 7 / 3, 5.5)
    assert tuple(sketches.kpi_tiles(days, "2024-01-01").first()) == (2, 2, 3.0, 10.0)
    assert tuple(sketches.kpi_tiles(days, "2030-01-01").first()) == (0, 0, None, None)
    assert tuple(sketches.quantiles(days, "score_sketch", {"m": 0.5}).first()) == (5,)
    assert tuple(sketches.quantiles(days, "score_sketch", {"m": 0.5}, "2030-01-01").first()) == (None,)
    assert tuple(sketches.authors_of_both(days, ("2024-01-01", "2024-01-01"), ("2030-01-01", "2030-01-02")).first()) == (2, 0, 0, 2)


T0 = dt.datetime(2025, 1, 1, 12, 30)


def staged(spark, rows):
    made = [(i, kind, "a", at, None, None, None, parent, None, None, "d", "f", "d") for i, kind, at, parent in rows]
    return spark.createDataFrame(made, SILVER)


@pytest.mark.parametrize("slices", [1, 7, 28])
def test_comments_by_age(spark, slices):
    week, hour, tick = dt.timedelta(days=7), dt.timedelta(hours=1), dt.timedelta(microseconds=1)
    said = [T0, T0 - tick, T0 + hour - tick, T0 + hour, T0 + week, T0 + week + tick, T0 + 3 * hour, T0 + 3 * hour, None]
    rows = [(1, "story", T0, None), (2, "job", T0, None), (3, "story", None, None)]
    rows += [(100 + k, "comment", at, 1) for k, at in enumerate(said)]
    rows += [(200, "comment", T0, 2), (201, "comment", T0, 3), (202, "comment", T0, None), (203, "comment", T0, 77)]
    found = metrics.comments_by_age(staged(spark, rows), slices=slices).collect()
    assert sorted(map(tuple, found)) == [(1, 0, 2), (1, 1, 1), (1, 3, 2), (1, 168, 1)]


def test_a_much_discussed_story_is_spread_over_slices(spark):
    rows = [(1, "story", T0, None)] + [(10 + k, "comment", T0 + dt.timedelta(minutes=10 * k), 1) for k in range(900)]
    items = staged(spark, rows)
    per_hour = {r.age: r.comments for r in metrics.comments_by_age(items).collect()}
    assert per_hour == {h: 6 for h in range(150)}
    per_day = {r.age: r.comments for r in metrics.comments_by_age(items, days=2, unit="DAY", slices=8).collect()}
    assert per_day == {0: 144, 1: 144, 2: 1}
