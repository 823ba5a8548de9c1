from pyspark.sql import functions as F

from forumlake.plans import facts, staging
from forumlake.schemas import SILVER
from forumlake.sources import silver
from forumlake.sources.parts import MAX_ID_PARTS
from forumlake.streaming import jobs
from test_models import ITEMS
from test_sources import item, write_lines


def test_append_takes_each_file_once(spark, tmp_path, rows):
    root, path, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "progress"))
    write_lines(root, "2025-10-04", "a.jsonl.gz", [item(1), "{bad"])
    run = lambda: jobs.append_parsed(jobs.landed_stream(spark, root, 1), path, checkpoint).awaitTermination()
    run()
    write_lines(root, "2025-10-05", "b.jsonl.gz", [item(2)])
    run()
    run()
    assert rows(silver.read_items(spark, path), "item_id", "ingest_date") == sorted(
        [(1, "2025-10-04"), (None, "2025-10-04"), (2, "2025-10-05")], key=str
    )


def test_exact_copies_are_appended_once_within_a_time(spark, tmp_path, rows):
    items = spark.createDataFrame(ITEMS, SILVER)
    for within, times in (("1 day", 1), ("0 seconds", 2)):
        path, checkpoint, arriving = (str(tmp_path / f"{n}{times}") for n in ("unique", "progress", "arriving"))
        for part in (items.unionByName(items), items.withColumn("score", F.col("score") + 1), items):
            part.write.mode("append").parquet(arriving)
            jobs.append_unique(spark.readStream.schema(SILVER).parquet(arriving), path, checkpoint, within).awaitTermination()
        changed = items.withColumn("score", F.col("score") + 1)
        wanted = changed.unionByName(items)
        for _ in range(times - 1):  # the third delivery comes when its copies are no longer known
            wanted = wanted.unionByName(items.filter("score IS NOT NULL")).unionByName(items.filter("score IS NULL"))
        # Rows without a score are the same in all three deliveries.
        same = items.filter("score IS NULL").count()
        got = rows(spark.read.schema(SILVER).parquet(path), *SILVER.names)
        assert len(got) == wanted.count() - (same if times == 1 else 0)
        assert set(got) == set(rows(wanted, *SILVER.names))


def test_late_files_reload_their_day(spark, tmp_path, rows):
    root, path, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "progress"))
    run = lambda: jobs.reload_touched_days(jobs.landed_stream(spark, root), root, path, checkpoint).awaitTermination()
    write_lines(root, "2025-10-04", "a.jsonl.gz", [item(1)])
    write_lines(root, "2025-10-05", "a.jsonl.gz", [item(2)])
    run()
    write_lines(root, "2025-10-04", "b.jsonl.gz", [item(3)])
    run()
    assert rows(silver.read_items(spark, path), "item_id", "ingest_date") == [
        (1, "2025-10-04"), (2, "2025-10-05"), (3, "2025-10-04")
    ]


def test_current_items_survive_repeated_delivery(spark, tmp_path, rows):
    path, checkpoint, arriving = (str(tmp_path / n) for n in ("current", "progress", "arriving"))
    empty = (None,) * 10 + ("2025-10-05", "f", "2025-10-05")
    for part in (ITEMS[:6], ITEMS[6:] + [empty], ITEMS[3:9]):
        spark.createDataFrame(part, SILVER).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(SILVER).parquet(arriving)
        jobs.maintain_current(stream, path, checkpoint, ids_per_bucket=10).awaitTermination()
    expected = staging.staged_items(spark.createDataFrame(ITEMS + [empty], SILVER))
    assert rows(jobs.read_current(spark, path), *SILVER.names) == rows(expected, *SILVER.names)
    # A repeated batch starts from the snapshots before it.
    assert jobs.read_current(spark, path, before=1).count() == 6


def test_daily_stream_equals_the_mart(spark, tmp_path, rows):
    path, checkpoint, arriving = (str(tmp_path / n) for n in ("daily", "progress", "arriving"))
    fact = facts.fct_stories(staging.staged_items(spark.createDataFrame(ITEMS, SILVER)))
    later = fact.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 DAY"))
    later = later.withColumn("item_key", F.concat(F.lit("later"), "item_key"))
    for part in (fact, later, fact):
        part.coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(fact.schema).parquet(arriving)
        jobs.maintain_daily(stream, path, checkpoint).awaitTermination()
    got = rows(jobs.read_daily(spark, path), "stories_per_day", "avg_comments_per_story", "active_authors")
    assert got == [(4, 4 / 3, 3), (4, 4 / 3, 3)]


def test_daily_stream_keeps_late_stories(spark, tmp_path, rows):
    path, checkpoint, arriving = (str(tmp_path / n) for n in ("daily", "progress", "arriving"))
    fact = facts.fct_stories(staging.staged_items(spark.createDataFrame(ITEMS, SILVER)))
    moved = lambda days, key: fact.withColumns(
        {"created_at": F.col("created_at") + F.expr(f"INTERVAL {days} DAY"), "item_key": F.concat(F.lit(key), "item_key")}
    )
    for part in (fact, moved(90, "new"), moved(0, "late"), moved(0, "late")):
        part.coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
        jobs.maintain_daily(stream, path, checkpoint).awaitTermination()
    assert rows(jobs.read_daily(spark, path), "stories_per_day", "active_authors") == [(4, 3), (8, 3)]


def test_buckets_of_many_ranges_stay_few(spark, tmp_path):
    path, checkpoint, arriving = (str(tmp_path / n) for n in ("current", "progress", "arriving"))
    for part in ("id >= 500", "id < 900"):
        items = spark.range(1500).filter(part).selectExpr(
            *[f"CAST({'id' if f.name == 'item_id' else repr(part) if f.name == 'source_file' else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in SILVER]
        )
        items.write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(SILVER).parquet(arriving)
        jobs.maintain_current(stream, path, checkpoint, ids_per_bucket=1).awaitTermination()
    found = {r.item_id: r.source_file for r in jobs.read_current(spark, path).collect()}
    assert found == {i: "id >= 500" if i >= 500 else "id < 900" for i in range(1500)}
    assert spark.read.parquet(path).select("bucket").distinct().count() <= MAX_ID_PARTS


def test_reload_asks_batches_for_days_only(spark, tmp_path, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs.bronze, "landed_days", lambda batch, days=jobs.bronze.landed_days: seen.append(batch.columns) or days(batch))
    root, path, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "progress"))
    write_lines(root, "2025-10-04", "a.jsonl.gz", [item(1)])
    write_lines(root, "2025-10-05", "a.jsonl.gz", [item(2)])
    jobs.reload_touched_days(jobs.landed_stream(spark, root), root, path, checkpoint).awaitTermination()
    assert seen == [["ingest_date"]]
    assert rows(silver.read_items(spark, path), "item_id", "ingest_date") == [(1, "2025-10-04"), (2, "2025-10-05")]
    paths = spark.createDataFrame([("/a/2025/10/05/x.gz",), ("/a/ingest_date=2025-10-05/x.gz",), ("/a/2025/10/x.gz",), (None,)], "p string")
    assert [r[0] for r in paths.select(jobs.bronze.day_of_path(F.col("p"))).collect()] == ["2025-10-05", "2025-10-05", None, ""]
