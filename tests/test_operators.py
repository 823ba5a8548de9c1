import random

import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from forumlake.operators.ordered import exact_quantiles, ranked, running_weight
from forumlake.operators.skew import hot_keys, salted_join
from forumlake.operators.threads import expand_threads
from forumlake.operators.topk import top_k
from forumlake.operators.versions import latest_version, version_history


def test_latest_version_is_total(spark, rows):
    data = [
        (1, "2025-10-01", "a", 5), (1, "2025-10-02", "a", 6),
        (2, "2025-10-01", "a", 1), (2, "2025-10-01", "b", 0),
        (3, "2025-10-01", "a", 1), (3, "2025-10-01", "a", 2),
        (None, "2025-10-01", "a", None), (None, "2025-10-03", "a", None),
    ]
    expected = [(1, "2025-10-02", "a", 6), (2, "2025-10-01", "b", 0), (3, "2025-10-01", "a", 2), (None, "2025-10-03", "a", None)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "id int, day string, file string, score int")
        assert rows(latest_version(df, ["id"], ["day", "file"])) == sorted(expected, key=str)


def test_latest_version_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS id", "id AS day")
    plan = latest_version(df, ["id"], ["day"])._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange") > plan.index("WindowGroupLimit")


def test_version_history(spark, rows):
    data = [(1, "d1", "a", 5), (1, "d1", "b", 7), (1, "d3", "a", 4), (2, "d1", "a", None), (2, "d2", "a", 1)]
    df = spark.createDataFrame(data, "id int, day string, file string, score int")
    got = rows(version_history(df, "id", "day", ["file"], ["score"]))
    assert got == sorted(
        [(1, "d1", 7, None, 1), (1, "d3", 4, -3, 2), (2, "d1", None, None, 1), (2, "d2", 1, None, 2)], key=str
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some on NULL, some keys without a partner."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50)
    left = spark.range(3000).withColumn("k", key.cast("bigint"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))
    return left, right.unionByName(right.filter("k = 5"))


def test_hot_keys_are_bounded(skewed, rows):
    left, _ = skewed
    assert rows(hot_keys(left, "k", min_rows=500, max_keys=10)) == [(7,)]
    for limit in (2, 5, 20):
        assert hot_keys(left, "k", min_rows=1, max_keys=limit).count() < limit
    assert hot_keys(left, "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, rows, how):
    left, right = skewed
    hot = hot_keys(left, "k", min_rows=100, max_keys=100)
    plain = left.join(right, "k", how)
    assert rows(salted_join(left, right, "k", how, hot, ["id"], salts=8).select(plain.columns)) == rows(plain)


def test_salted_join_spreads_the_hot_key(skewed, spark):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = hot_keys(left, "k", min_rows=500, max_keys=10)
        joined = salted_join(left, right, "k", "left", hot, ["id"], salts=16).filter("k = 7")
        assert joined.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_refuses_right_joins(skewed):
    left, right = skewed
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "full", right.select("k"), ["id"])


def _lowest(values, share):
    ordered = sorted(values)
    return next(v for i, v in enumerate(ordered, 1) if i >= share * len(ordered))


@pytest.mark.parametrize("slices", [1, 2, 16])
def test_exact_quantiles_against_sorting(spark, slices):
    rng = random.Random(slices)
    groups = {"a": [rng.randint(0, 30) for _ in range(400)], "b": [5] * 300 + [1, 9], None: [1, 2, 3, 10]}
    data = [(g, v) for g, values in groups.items() for v in values] + [("a", None), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v long")
    got = exact_quantiles(df, "v", {"p50": "0.5", "p90": "0.9", "p0": "0"}, ["g"], slices=slices)
    expected = {g: (_lowest(v, 0.5), _lowest(v, 0.9), min(v)) for g, v in groups.items()}
    assert {r.g: (r.p50, r.p90, r.p0) for r in got.collect()} == expected


def test_median_is_an_element(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10, None)], "v int")
    assert exact_quantiles(df, "v", {"median": "0.5"}).first().median == 2


def test_running_weight(spark, rows):
    df = spark.createDataFrame([(v, v * 2) for v in range(1, 40)], "v long, w long")
    got = rows(running_weight(df, "v", "w", slices=8), "v", "below", "in_group")
    total = sum(v * 2 for v in range(1, 40))
    assert got == sorted([(v, sum(x * 2 for x in range(1, v)), total) for v in range(1, 40)], key=str)


def test_ranked_shares_ranks(spark):
    rng = random.Random(3)
    values = [0] * 300 + [rng.randint(1, 200) for _ in range(300)] + [None] * 5
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    known = [v for v in values if v is not None]
    expected = {i: 1 + (len(known) if v is None else sum(x > v for x in known)) for i, v in enumerate(values)}
    got = ranked(df, "v", ["id"], slices=8, min_rows=50, max_keys=20)
    assert {r.id: r["rank"] for r in got.collect()} == expected


def test_top_k(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None)], "n string, v int")
    best = top_k(df, ["v"], ["n"], 3)
    assert [r.n for r in best.collect()] == ["b", "c", "a"]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


def _walk(items, roots):
    children = {}
    for item, parent, _ in items:
        if item is not None and parent is not None:
            children.setdefault(parent, []).append(item)
    found = set()
    for root in roots:
        level, depth = [root], 0
        while level:
            found |= {(root, i, depth) for i in level}
            level, depth = [c for i in level for c in children.get(i, [])], depth + 1
    return found


def test_threads(spark):
    chain = [(i, i - 1 if i > 1000 else None, "comment" if i > 1000 else "story") for i in range(1000, 1150)]
    wide = [(1, None, "story")] + [(i, 1, "comment") for i in range(2, 40)] + [(i, 5, "comment") for i in range(40, 90)]
    lost = [(300, None, "poll"), (301, 300, "comment"), (302, 9999, "comment"), (303, 302, "comment")]
    cycle = [(400, 401, "comment"), (401, 400, "comment"), (402, 400, "comment"), (None, 1, "comment")]
    items = chain + wide + lost + cycle
    df = spark.createDataFrame(items, "item_id long, parent_id long, item_type string")
    expected = _walk(items, [1000, 1])
    assert {tuple(r) for r in expand_threads(df).collect()} == expected
    # The same with salting switched on for nearly everything, and for one thread only.
    salted = expand_threads(df, min_hot_rows=2, max_hot_keys=500)
    assert {tuple(r) for r in salted.collect()} == expected
    one = expand_threads(df, roots=spark.createDataFrame([(1,), (300,)], "id long"))
    assert {tuple(r) for r in one.collect()} == {e for e in expected if e[0] == 1}


def test_threads_of_near_ids_take_few_rounds(spark, monkeypatch):
    """Long chains with leaps, repeated keys and cycles, in windows of few rows; rounds are for what windows leave."""
    from forumlake.operators import threads

    rng, rows = random.Random(5), [(0, None, "story"), (1, None, "story")]
    rows += [(i, rng.randint(max(0, i - 4), i - 1) if i % 500 else rng.randint(0, i - 1), "comment") for i in range(2, 3000)]
    rows += [(90_000 + i, 90_000 + (i + 1) % 700, "comment") for i in range(700)] + [(200_000, 2999, "comment"), (-70_000, 200_000, "comment")]
    rows += [rows[2990], (2980, 1, "comment"), (300_000, 300_000, "comment")]  # keys that come twice give a row for each way
    df = spark.createDataFrame(rows, "item_id long, parent_id long, item_type string")
    above = {}
    for item, parent, _ in rows:
        above.setdefault(item, []).append(parent)

    def ways(item, depth=0):
        if 0 <= item < 2:
            return [(item, depth)]
        return [w for p in above[item] for w in ways_of(p, depth + 1)]

    known = {}

    def ways_of(item, depth):
        if item not in known:
            known[item] = ways(item)
        return [(root, depth + d) for root, d in known[item]]

    expected = sorted((r, i, d) for i in sorted(set(above) - {300_000} - set(range(90_000, 90_700)), key=lambda i: (i < 0, i)) for r, d in ways_of(i, 0))
    saved = []
    monkeypatch.setattr(threads, "stored", lambda df, keep=threads.stored: saved.append(1) or keep(df))
    assert sorted(map(tuple, expand_threads(df).collect())) == expected
    assert len(saved) <= 6
    batches = pa.table({"node": [5, 6, 6, 6, 7, 8], "up": [4, 5, 5, 5, 6, 7], "hops": [1] * 6, "done": [False] * 6}).to_batches(2)
    monkeypatch.setattr(threads, "WINDOW_ROWS", 2)
    found = [tuple(r.values()) for batch in threads._shorten(iter(batches)) for r in batch.to_pylist()]
    assert [r[:3] for r in found if r[0] == 6] and all(r[1] == 6 for r in found if r[0] == 8 and r[2] == 2)
    assert all(r[1] in (4, 5) for r in found if r[0] == 6) and all(r[1] == 6 for r in found if r[0] == 7)
