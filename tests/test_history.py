"""State intervals against a plain loop, kept up by deliveries in any order."""

import datetime as dt
import random
import re

import pytest

from forumlake.operators.intervals import as_of, join_as_of, state_intervals
from forumlake.plans import history
from forumlake.schemas import SILVER
from forumlake.sources.parts import id_part, names


def brute(states):
    out, by_key = [], {}
    for key, day, a, b in states:
        if key is not None and day is not None:
            by_key.setdefault(key, []).append((day, a, b))
    for key, days in by_key.items():
        spans = []
        for day, a, b in sorted(days, key=lambda d: d[0]):
            if spans and spans[-1][:2] == [a, b]:
                spans[-1][3:] = [day, spans[-1][4] + 1]
            else:
                spans.append([a, b, day, day, 1])
        following = [s[2] for s in spans[1:]] + [None]
        out += [(key, *s, n) for s, n in zip(spans, following, strict=True)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def days(rng, n):
    return [f"2025-01-{d:02d}" for d in rng.sample(range(1, 29), n)]


def test_intervals_against_a_loop(spark):
    rng = random.Random(1)
    states = [(k, d, rng.choice([None, 1, 2]), rng.choice([None, 5])) for k in range(40) for d in days(rng, rng.randint(1, 20))]
    states += [(None, "2025-01-01", 1, 1), (7, None, 1, 1), (-1, "2025-01-01", None, None)]
    df = spark.createDataFrame(states, "k long, d string, a int, b int").repartition(5)
    made = state_intervals(df, "k", "d", ["a", "b"])
    wanted = brute(states)
    assert rows_of(made) == wanted
    for day in ("2024-12-31", "2025-01-01", "2025-01-15", "2025-03-01"):
        held = [w for w in wanted if w[3] <= day and (w[6] is None or w[6] > day)]
        assert rows_of(as_of(made, day)) == held
    asked = spark.createDataFrame([(k, f"2025-01-{d:02d}") for k in (0, 1, 999) for d in (1, 9, 28)], "k long, day string")
    found = {(r.k, r.day): r.first_day for r in join_as_of(asked, made, "k", "day").collect()}
    held = {(k, d): max((w[3] for w in wanted if w[0] == k and w[3] <= d), default=None) for k, d in found}
    assert len(found) == 9 and found == held
    assert state_intervals(df.limit(0), "k", "d", ["a"]).collect() == []


def item(i, day, version, score):
    values = {"item_id": i, "score": score, "ingest_date": day, "source_file": f"f{version:05d}", "created_at": dt.datetime(2025, 1, 1)}
    return tuple(values.get(name) for name in SILVER.names)


@pytest.mark.parametrize("seed", [3, 4])
def test_deliveries_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    items = [item(i, d, v, rng.choice([1, 1, 2])) for i in range(60) for v, d in enumerate(days(rng, 9) + days(rng, 3))]
    items += [item(None, "2025-01-01", 1, 1), item(3, None, 1, 1)]
    rng.shuffle(items)
    store = str(tmp_path / "h")
    for run, at in enumerate(range(0, len(items), 300), 1):
        delivered = spark.createDataFrame(items[at : at + 300] + items[:20], SILVER)
        history.refresh(spark, delivered, store, run, ids_per_part=10)
        history.refresh(spark, delivered, store, run, ids_per_part=10)  # a run that is repeated
    everything = spark.createDataFrame(items, SILVER)
    assert rows_of(history.read_intervals(spark, store)) == rows_of(history.item_intervals(everything))
    assert history.refresh(spark, everything.limit(0), store, 99) == []


def test_other_ranges_are_not_read(spark, tmp_path):
    store = str(tmp_path / "h")
    items = spark.createDataFrame([item(i, "2025-01-01", 1, 1) for i in range(100)], SILVER)
    history.refresh(spark, items, store, 1, ids_per_part=10)
    late = spark.createDataFrame([item(42, "2025-01-02", 1, 5)], SILVER)
    assert history.refresh(spark, late, store, 2, ids_per_part=10) == names(late, id_part("item_id", 10)) == ["4"]
    some = history.read_intervals(spark, store, ["4"])
    assert some.count() == 11
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*part#\d+ (=|IN) ", plan)
