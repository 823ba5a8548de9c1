import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from forumlake.plans.pipeline import land_new_items, parse_changed_days
from forumlake.sources import bronze, control, silver

DAY = dt.date(2025, 10, 5)


def write_lines(root, day, name, lines):
    folder = os.path.join(root, day.replace("-", "/"))
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as f:
        f.write("".join(line + "\n" for line in lines))


def item(i, **more):
    return json.dumps({"id": i, "type": "story", **more})


@pytest.mark.parametrize(
    "last, newest, per_run, expected",
    [(0, 100, 1000, (1, 100)), (100, 100, 10, None), (5, 100, 10, (6, 15)), (5, 100, None, (6, 100)), (95, 100, 10, (96, 100))],
)
def test_run_bounds(last, newest, per_run, expected):
    assert bronze.run_bounds(last, newest, per_run) == expected


def test_id_chunks_and_ids(spark, rows):
    assert rows(bronze.id_chunks(spark, 0, 25, 10, None)) == [(0, 1, 10), (1, 11, 20), (2, 21, 25)]
    assert bronze.id_chunks(spark, 25, 25, 10).count() == 0
    ids = bronze.run_ids(spark, 0, 25, 10, None)
    assert rows(ids) == sorted([(i,) for i in range(1, 26)], key=str)
    assert ids.select(F.spark_partition_id()).distinct().count() == 3
    assert bronze.run_ids(spark, 25, 25).count() == 0


def test_fetch_keeps_failures(spark, rows):
    def lookup(i):
        if i == 3:
            raise ValueError("down")
        if i == 4:
            return {"id": i, "valid": {1, 2}}  # cannot become JSON
        return None if i % 2 else {"id": i}

    ids = spark.range(1, 7).select(F.col("id").alias("item_id"))
    got = rows(bronze.fetch_items(ids, lookup), "item_id", "value", "status")
    assert got == [
        (1, None, "missing"), (2, '{"id": 2}', "ok"), (3, None, "failed"), (4, None, "failed"), (5, None, "missing"),
        (6, '{"id": 6}', "ok"),
    ]


def test_land_and_read_back(spark, tmp_path, rows):
    root = str(tmp_path / "bronze")
    values = [item(8863, by="ann"), item(8864, parent=8863, text="a § b, \"c\""), "null", "{}", None, " "]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    bronze.land_items(df, root, DAY)
    assert os.path.exists(f"{root}/2025/10/05/_SUCCESS")
    lines = bronze.landed_lines(spark, root)
    assert rows(lines, "value", "ingest_date") == sorted([(v, "2025-10-05") for v in values[:2]], key=str)
    entry = bronze.manifest(lines, "feed").agg(F.sum("item_count"), F.min("id_range.start"), F.max("id_range.end")).first()
    assert tuple(entry) == (2, 8863, 8864)
    written = str(tmp_path / "manifest")
    bronze.write_manifest(bronze.manifest(lines, "feed"), written)
    known = spark.read.json(written)
    assert rows(known, "source", "file_format") == [("feed", "NDJSON_GZ")] * known.count()
    assert {r.path for r in known.collect()} == {r.source_file for r in lines.select("source_file").collect()}
    bronze.land_items(df.filter("value IS NULL"), root, DAY)
    assert bronze.landed_lines(spark, root).count() == 2


def test_missing_and_enriched_ids(spark, rows):
    landed = spark.createDataFrame(
        [(1, "a", "d1", "f"), (3, "b", "d1", "f"), (3, "c", "d2", "f")],
        "item_id long, value string, ingest_date string, source_file string",
    )
    assert rows(bronze.missing_ids(spark, landed, 1, 4)) == [(2,), (4,)]
    ids = bronze.run_ids(spark, 0, 3, items_per_run=None)
    assert rows(bronze.enrich_from_landed(ids, landed)) == [(1, "a"), (2, None), (3, "c")]


def test_land_new_items(spark, tmp_path):
    root, mark = str(tmp_path / "bronze"), str(tmp_path / "mark")
    asked = spark.sparkContext.accumulator(0)

    def lookup(i):
        asked.add(1)
        if i == 7:
            raise OSError("down")
        return None if i == 4 else {"id": i}

    landed, failed = land_new_items(spark, root, mark, 10, lookup, DAY, chunk_size=4)
    assert landed == 8 and [r.item_id for r in failed.collect()] == [7]
    assert asked.value == 10
    assert control.read_mark(spark, mark) == 10
    landed, failed = land_new_items(spark, root, mark, 10, lookup, DAY)
    assert landed == 0 and asked.value == 11 and failed.count() == 1  # the failed id alone, once more
    landed, _ = land_new_items(spark, root, mark, 12, lambda i: {"id": i}, DAY, manifest_path=str(tmp_path / "files"))
    assert landed == 3 and control.read_mark(spark, mark) == 12
    assert control.failed_lookups(spark, f"{mark}-lookups").count() == 0
    assert bronze.landed_lines(spark, root).count() == 11
    entries = spark.read.json(str(tmp_path / "files"))
    assert entries.agg(F.sum("item_count")).first()[0] == 3


def test_a_backlog_is_taken_oldest_first_and_whole(spark, tmp_path):
    root, mark = str(tmp_path / "bronze"), str(tmp_path / "mark")
    marks = []
    for _ in range(4):
        land_new_items(spark, root, mark, 25, lambda i: {"id": i}, DAY, items_per_run=10)
        marks.append(control.read_mark(spark, mark))
    assert marks == [10, 20, 25, 25]
    ids = bronze.landed_lines(spark, root).select(F.get_json_object("value", "$.id").cast("int")).collect()
    assert sorted(r[0] for r in ids) == list(range(1, 26))


def test_marks_and_day_state(spark, tmp_path, rows):
    mark, state = str(tmp_path / "mark"), str(tmp_path / "state")
    assert control.read_mark(spark, mark) == 0
    for value in (10, 30):
        control.write_mark(spark, mark, value)
    assert control.read_mark(spark, mark) == 30
    assert control.read_day_state(spark, state).count() == 0
    totals = spark.createDataFrame([("d1", 1, 10), ("d2", 1, 10)], "ingest_date string, file_count long, total_bytes long")
    control.write_day_state(totals, state, 1)
    control.write_day_state(totals.filter("ingest_date = 'd2'").withColumn("file_count", F.lit(2)), state, 2)
    assert rows(control.read_day_state(spark, state)) == [("d1", 1, 10, 1), ("d2", 2, 10, 2)]


def test_changed_days_are_parsed_again(spark, tmp_path, rows):
    root, path, state = (str(tmp_path / n) for n in ("bronze", "silver", "state"))
    write_lines(root, "2025-10-04", "a.jsonl.gz", [item(1), "{bad", ""])
    write_lines(root, "2025-10-05", "a.jsonl.gz", [item(2), item(3)])
    write_lines(root, "2025-10-06", "a.jsonl.gz", [item(4)])
    write_lines(root, "2025-10-06", "b.jsonl.gz", [item(5, title="long " * 50)])
    for name in ("a_manifest.json", "_SUCCESS"):
        with open(f"{root}/2025/10/04/{name}", "w") as f:
            f.write("{}")

    def stored():
        return rows(silver.read_items(spark, path), "ingest_date", "item_id")

    assert parse_changed_days(spark, root, path, state, 1).parsed == ["2025-10-04", "2025-10-05", "2025-10-06"]
    first = stored()
    assert first == sorted(
        [("2025-10-04", 1), ("2025-10-04", None), ("2025-10-04", None), ("2025-10-05", 2), ("2025-10-05", 3),
         ("2025-10-06", 4), ("2025-10-06", 5)], key=str
    )
    assert parse_changed_days(spark, root, path, state, 2) == ([], [])
    # One day grows, one is new, one loses a file as expired raw files do.
    write_lines(root, "2025-10-05", "b.jsonl.gz", [item(6)])
    write_lines(root, "2025-10-07", "a.jsonl.gz", [item(7)])
    os.remove(f"{root}/2025/10/06/b.jsonl.gz")
    known = control.read_file_state(spark, f"{state}-files")
    compared = bronze.compare_files(bronze.landed_files(spark, root), known)
    assert rows(compared, "ingest_date", "status") == [
        ("2025-10-04", "unchanged"), ("2025-10-05", "changed"), ("2025-10-06", "shrunk"), ("2025-10-07", "new")
    ]
    assert parse_changed_days(spark, root, path, state, 3) == (["2025-10-05", "2025-10-07"], ["2025-10-06"])
    assert stored() == sorted(first + [("2025-10-05", 6), ("2025-10-07", 7)], key=str)
    assert parse_changed_days(spark, root, path, state, 4, reload_shrunk=True) == (["2025-10-06"], [])
    assert ("2025-10-06", 5) not in stored()
    # Both layouts of landed days are found.
    extra = spark.createDataFrame([(item(8), "2025-10-08")], "value string, ingest_date string")
    bronze.land_items(extra, root)
    assert parse_changed_days(spark, root, path, state, 5) == (["2025-10-08"], [])
    # A file landed again with less in it and another one added: fewer bytes, yet every new id arrives.
    write_lines(root, "2025-10-05", "a.jsonl.gz", [item(2)])
    write_lines(root, "2025-10-05", "c.jsonl.gz", [item(9)])
    assert parse_changed_days(spark, root, path, state, 6) == (["2025-10-05"], [])
    assert {i for d, i in stored() if d == "2025-10-05"} == {2, 6, 9}
    days = [r.ingest_date for r in bronze.landed_days(bronze.landed_files(spark, root)).collect()]
    assert days == sorted(days) and len(days) == 5


def test_parsing_twice_gives_the_same_table(spark, tmp_path, rows):
    root, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    write_lines(root, "2025-10-04", "a.jsonl.gz", [item(1), item(1, title="x")])
    for _ in range(2):
        silver.write_items(silver.parse_items(bronze.landed_lines(spark, root)), path)
        assert silver.read_items(spark, path).count() == 2


def test_registered_table_prunes_days(spark, tmp_path):
    root, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for day in ("2025-10-04", "2025-10-05"):
        write_lines(root, day, "a.jsonl.gz", [item(1)])
    silver.write_items(silver.parse_items(bronze.landed_lines(spark, root)), path)
    silver.register_items(spark, "registered_items", path)
    table = spark.table("registered_items")
    assert dict(table.dtypes)["ingest_date"] == "string" and table.count() == 2
    one = table.filter("ingest_date = '2025-10-05'").select("item_id")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and one.count() == 1


def test_long_runs_take_a_bounded_number_of_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "MAX_FETCH_TASKS", 3)
    assert bronze.run_ids(spark, 0, 100, 10).rdd.getNumPartitions() == 3
    assert bronze.run_ids(spark, 0, 20, 10).rdd.getNumPartitions() == 2
    assert [r.item_id for r in bronze.run_ids(spark, 0, 100, 10).collect()] == [*range(1, 101)]
    assert bronze.fetch_items(bronze.run_ids(spark, 5, 5), lambda i: {"id": i}).collect() == []

    def lookup(item_id):
        if item_id % 9 == 0:
            raise OSError("down")
        return {"id": item_id} if item_id % 2 else None

    root, mark = str(tmp_path / "landed"), str(tmp_path / "mark")
    # Without a manifest nobody asks for the files of the day.
    monkeypatch.setattr("forumlake.plans.pipeline._day_files", None)
    landed, failed = land_new_items(spark, root, mark, 100, lookup, DAY, chunk_size=10)
    assert landed == 44 and sorted(r.item_id for r in failed.collect()) == [*range(9, 100, 9)]
    landed, failed = land_new_items(spark, root, mark, 120, lambda i: {"id": i}, DAY, chunk_size=10)
    assert landed == 31 and failed.count() == 0
    lines = bronze.landed_lines(spark, root).collect()
    assert len(lines) == len({r.value for r in lines}) == 75
