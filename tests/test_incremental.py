"""Marts and threads kept up to date from what changed, against building them from everything."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from forumlake.operators import thread_store
from forumlake.operators.threads import expand_threads
from forumlake.plans import facts, incremental, marts, staging
from forumlake.schemas import SILVER
from forumlake.sources.parts import MAX_ID_PARTS, id_part, names, read_parts, replace_parts

SCHEMA = StructType([StructField("id", LongType()), StructField("day", StringType())])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_parts_are_replaced_emptied_and_repeated(spark, tmp_path):
    path, day = str(tmp_path / "t"), F.col("day")
    assert rows_of(read_parts(spark, path, SCHEMA)) == []
    replace_parts(frame(spark, (1, "a"), (2, "a"), (3, "b")), path, day, ["a", "b"], 1)
    replace_parts(frame(spark, (4, "b")), path, day, ["b", "a"], 2)
    assert rows_of(read_parts(spark, path, SCHEMA)) == [(4, "b")]
    assert rows_of(read_parts(spark, path, SCHEMA, before=2)) == [(1, "a"), (2, "a"), (3, "b")]
    assert rows_of(read_parts(spark, path, SCHEMA, ["a"], before=2)) == [(1, "a"), (2, "a")]
    replace_parts(frame(spark, (5, "b"), (6, "a")), path, day, ["b", "a"], 2)
    assert rows_of(read_parts(spark, path, SCHEMA)) == [(5, "b"), (6, "a")]
    # Rows of a run that died before its log entry are not seen.
    frame(spark, (9, "a")).selectExpr("id", "day", "day AS part", "7L AS run").write.mode("append").partitionBy(
        "part", "run"
    ).parquet(f"{path}/rows")
    assert rows_of(read_parts(spark, path, SCHEMA)) == [(5, "b"), (6, "a")]


def test_other_parts_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_parts(frame(spark, *[(i, f"d{i % 9}") for i in range(90)]), path, F.col("day"), [f"d{i}" for i in range(9)], 1)
    some = read_parts(spark, path, SCHEMA, ["d3", "d4"], before=5)
    assert some.count() == 20
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*part#\d+ IN \(d3,d4\)", plan)


T0 = dt.datetime(2025, 1, 1)


def versions(seed, n, days):
    """Random deliveries: items change their kind, day, author, parent and score from version to version."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        item = rng.choice([None, *range(1, 40)]) if rng.random() < 0.9 else -rng.randint(1, 5)
        day = f"2025-01-{rng.randint(1, days):02d}"
        comment = rng.random() < 0.6
        at = T0 + dt.timedelta(hours=rng.randint(0, 24 * days)) if rng.random() < 0.95 else None
        out.append(
            (item, "comment" if comment else rng.choice(["story", "story", "job"]), rng.choice([None, "ann", "bob"]), at, "t",
             None, None, rng.choice([None, *range(1, 40)]) if comment else None, rng.randint(1, 9), None, day, f"f{k}", day)
        )
    return out


def built(items):
    made = facts.fct_stories(staging.staged_items(items, []))
    return made, marts.daily_story_metrics(made), marts.daily_active_authors(made)


def test_refresh_equals_a_full_build(spark, tmp_path):
    seed = 1
    rng, store, held = random.Random(seed), str(tmp_path / "store"), []
    runs = [(versions(seed, 120, 8), [f"2025-01-{d:02d}" for d in range(1, 9)])]
    runs += [(versions(100 * seed + i, 25, 8), rng.sample([f"2025-01-{d:02d}" for d in range(1, 9)], 2)) for i in range(2)]
    for run, (rows, days) in enumerate(runs):
        held = [r for r in held if r[-1] not in days] + [r for r in rows if r[-1] in days]
        items = spark.createDataFrame(held, SILVER)
        if run == 1:  # a run that died and is repeated
            incremental.refresh(spark, items.filter("item_id % 2 = 0"), days, store, run, ids_per_part=7)
        incremental.refresh(spark, items, days, store, run, ids_per_part=7)
    made, metrics, authors = built(items)
    assert rows_of(incremental.facts(spark, store)) == rows_of(made)
    day = F.col("story_date").isNotNull()
    assert rows_of(incremental.daily_story_metrics(spark, store).filter(day)) == rows_of(metrics.filter(day))
    assert rows_of(incremental.daily_active_authors(spark, store)) == rows_of(authors)


def test_refresh_touches_only_what_changed(spark, tmp_path):
    store = str(tmp_path / "store")
    day = [f"2025-01-{d:02d}" for d in range(1, 11)]

    def row(item, kind, at, parent=None, file="f"):
        return (item, kind, "ann", T0 + dt.timedelta(days=at), "t", None, None, parent, 1, None, day[at], file, day[at])

    first = [row(10 * d, "story", d) for d in range(9)] + [row(10 * d + 1, "comment", d, 10 * d) for d in range(9)]
    incremental.refresh(spark, spark.createDataFrame(first, SILVER), day, store, 1, ids_per_part=10)
    late = [*first, row(205, "comment", 9, 30)]
    found = incremental.refresh(spark, spark.createDataFrame(late, SILVER), [day[9]], store, 2, ids_per_part=10)
    assert found == incremental.Refreshed(["20"], ["3"], [day[3]])
    again = {f.split("/part=")[1].split("/")[0] for f in _files(spark, f"{store}/facts/rows", 2)}
    assert again == {day[3]}
    assert incremental.facts(spark, store, [day[3]]).select("total_comments").collect() == [(2,)]
    gone = incremental.refresh(spark, spark.createDataFrame(first, SILVER).filter("item_id <> 30"), [day[3]], store, 3, 10)
    assert gone.story_days == [day[3]] and incremental.facts(spark, store, [day[3]]).count() == 0
    assert incremental.daily_story_metrics(spark, store).count() == 8


def _files(spark, path, run):
    paths = spark.read.parquet(path).filter(f"run = {run}").select(F.input_file_name()).distinct().collect()
    return [r[0] for r in paths]


def test_names_of_parts(spark):
    assert names(frame(spark, (1, "b"), (2, "a"), (3, "b")), F.col("day")) == ["a", "b"]


THREADS = "item_id long, parent_id long, item_type string"


def wanted(spark, rows):
    return rows_of(expand_threads(spark.createDataFrame(rows, THREADS)).select("root_id", "item_id", "depth"))


def test_deliveries_in_any_order_equal_the_whole(spark, tmp_path):
    hot, rng, store = 1, random.Random(2), str(tmp_path / "threads")
    rows = [(i, None if i < 4 else rng.randint(max(0, i - 5), i - 1), "story" if i < 3 else "comment") for i in range(80)]
    rows += [(100, 101, "comment"), (101, 102, "comment"), (102, 100, "comment"), (103, 102, "comment")]  # a cycle
    rows += [(200, 999, "comment"), (201, 200, "comment"), (5000, 2, "story"), (5001, 5000, "comment")]
    rng.shuffle(rows)
    for run in range(3):
        part = rows[run::3] + (rows[:5] if run == 2 else [])
        df = spark.createDataFrame([*part, (None, 1, "comment")], THREADS)
        if run == 1:  # a run that died and is repeated
            thread_store.add_items(spark, df.limit(7), store, run, ids_per_part=10, min_hot_rows=hot, max_hot_keys=3)
        thread_store.add_items(spark, df, store, run, ids_per_part=10, min_hot_rows=hot, max_hot_keys=3)
    assert rows_of(thread_store.read_threads(spark, store)) == wanted(spark, rows)
    waiting = rows_of(thread_store.waiting_items(spark, store))
    assert waiting == [(200, 999, 1), (201, 999, 2)]


def test_a_cycle_that_closes_over_deliveries_and_a_late_root(spark, tmp_path):
    store = str(tmp_path / "threads")
    deliveries = [
        [(1, 2, "comment"), (11, 10, "comment"), (12, 11, "comment")],
        [(2, 3, "comment"), (13, 12, "comment"), (10, 9, "comment")],
        [(3, 1, "comment"), (9, 8, "comment"), (4, 3, "comment")],
        [(8, None, "story"), (11, None, "story")],
        [],
    ]
    for run, rows in enumerate(deliveries):
        thread_store.add_items(spark, spark.createDataFrame(rows, THREADS), store, run, ids_per_part=5)
    assert rows_of(thread_store.read_threads(spark, store)) == [
        (8, 10, 2), (8, 11, 3), (8, 12, 4), (8, 13, 5), (8, 8, 0), (8, 9, 1),
    ]
    assert rows_of(thread_store.waiting_items(spark, store)) == []


def test_attached_items_are_written_once(spark, tmp_path):
    store = str(tmp_path / "threads")
    first = [(i, i - 1 if i else None, "comment" if i else "story") for i in range(30)]
    thread_store.add_items(spark, spark.createDataFrame(first, THREADS), store, 1, ids_per_part=10)
    thread_store.add_items(spark, spark.createDataFrame([(50, 29, "comment")], THREADS), store, 2, ids_per_part=10)
    rows = spark.read.parquet(f"{store}/state")
    assert [tuple(r) for r in rows.filter("run = 2").select("node", "root", "depth").collect()] == [(50, 0, 30)]
    assert rows.count() == 31


def test_parts_of_many_ranges_stay_few(spark, tmp_path):
    ids = spark.range(-3000, 3000).select(F.col("id").alias("item_id")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS item_id"))
    assert len(names(ids, id_part("item_id", 1))) == MAX_ID_PARTS + 1
    store = str(tmp_path / "threads")
    rows = spark.range(2000).selectExpr("id AS item_id", "IF(id > 0, id - 1, NULL) AS parent_id", "IF(id > 0, 'comment', 'story') AS item_type")
    for run in (0, 1):
        thread_store.add_items(spark, rows.filter(f"item_id % 2 = {1 - run}"), store, run, ids_per_part=1)
    assert sorted(map(tuple, thread_store.read_threads(spark, store).collect())) == [(0, i, i) for i in range(2000)]
    assert spark.read.parquet(f"{store}/state").select("part").distinct().count() == MAX_ID_PARTS
