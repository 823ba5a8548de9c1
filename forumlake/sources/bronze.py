"""Raw items: which ids to take, looking them up, landing them as gzipped JSON lines, reading them back."""

import datetime as dt
import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from forumlake.constants import ITEMS_PER_CHUNK
from forumlake.operators.versions import latest_version
from forumlake.schemas import FETCHED

LANDED_FILES = "*.gz"

# A run of more chunks has several in one partition, so that starting tasks does not take the time.
MAX_FETCH_TASKS = 1_000

# The day is the folder of the file: .../2025/10/05/x.gz or .../ingest_date=2025-10-05/x.gz
_DAY_IN_PATH = r"(\d{4}[-/]\d{2}[-/]\d{2})/[^/]*$"


def run_bounds(last_id: int, max_id: int, items_per_run: int | None = None) -> tuple[int, int] | None:
    """First and last id of the next run, or None if there is nothing new.

    With `items_per_run` the oldest ids of a longer backlog are taken, and later runs take the rest.
    """
    first, last = last_id + 1, max_id
    if items_per_run is not None:
        last = min(last, last_id + items_per_run)
    return (first, last) if first <= last else None


def id_chunks(
    spark: SparkSession,
    last_id: int,
    max_id: int,
    chunk_size: int = ITEMS_PER_CHUNK,
    items_per_run: int | None = None,
) -> DataFrame:
    """The run as inclusive id ranges: chunk, start_id, end_id. Computed without a shuffle."""
    first, last = run_bounds(last_id, max_id, items_per_run) or (0, -1)
    n_chunks = -(-(last - first + 1) // chunk_size)
    start = F.lit(first) + F.col("id") * chunk_size
    return spark.range(n_chunks).select(
        F.col("id").alias("chunk"),
        start.cast("bigint").alias("start_id"),
        F.least(start + (chunk_size - 1), F.lit(last)).cast("bigint").alias("end_id"),
    )


def run_ids(
    spark: SparkSession,
    last_id: int,
    max_id: int,
    chunk_size: int = ITEMS_PER_CHUNK,
    items_per_run: int | None = None,
) -> DataFrame:
    """All ids of the run in item_id, one partition per chunk, or MAX_FETCH_TASKS of them."""
    first, last = run_bounds(last_id, max_id, items_per_run) or (0, -1)
    n_chunks = min(MAX_FETCH_TASKS, max(1, -(-(last - first + 1) // chunk_size)))
    return spark.range(first, last + 1, numPartitions=n_chunks).select(F.col("id").alias("item_id"))


def fetch_items(ids: DataFrame, lookup: Callable[[int], dict | None]) -> DataFrame:
    """Look ids up in the tasks: item_id, value (JSON), status, error.

    `lookup` returns the item, None if there is none, and raises if it fails; retrying is
    its own business. Failed ids stay in the result, so that they can be taken up again.
    """

    def one(item_id: int):
        try:
            item = lookup(item_id)
            if not item:
                return item_id, None, "missing", None
            return item_id, json.dumps(item), "ok", None
        except Exception as error:  # a bad item must not lose the chunk
            return item_id, None, "failed", f"{type(error).__name__}: {error}"

    def run(batches):
        for batch in batches:
            found = [one(int(i)) for i in batch.column(0).to_pylist()]
            columns = zip(*found) if found else [()] * len(FETCHED)
            types = [pa.int64()] + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], FETCHED.names)

    return ids.select("item_id").mapInArrow(run, FETCHED)


def enrich_from_landed(
    ids: DataFrame, landed: DataFrame, newest_first: tuple[str, ...] = ("ingest_date", "source_file")
) -> DataFrame:
    """Ids with the newest raw line already landed for them, NULL where there is none."""
    lines = latest_version(landed.select("item_id", "value", *newest_first), ["item_id"], list(newest_first))
    return ids.join(lines.select("item_id", "value"), "item_id", "left")


def missing_ids(spark: SparkSession, landed: DataFrame, first: int, last: int, key: str = "item_id") -> DataFrame:
    """Ids of a range that never arrived: failed look-ups the high-water mark has passed."""
    expected = spark.range(first, last + 1).select(F.col("id").alias(key))
    return expected.join(landed.select(key).distinct(), key, "left_anti")


def landable(items: DataFrame) -> DataFrame:
    """Items worth landing: neither missing nor empty."""
    return items.filter(F.col("value").isNotNull() & ~F.trim("value").isin("", "null", "{}"))


def land_items(items: DataFrame, root: str, day: dt.date | None = None, items_per_file: int = ITEMS_PER_CHUNK) -> None:
    """Append the JSON lines in `value` below `root` as gzipped text, empty items left out.

    With `day` the files go to root/YYYY/MM/DD, else to one folder per `ingest_date`. Spark's
    committer publishes the files together and writes _SUCCESS last. The rebalance hint lets
    adaptive execution split a busy day and join quiet ones.
    """
    kept = landable(items)
    if day is not None:
        writer, path = kept.select("value").write, f"{root}/{day:%Y/%m/%d}"
    else:
        writer, path = kept.select("value", "ingest_date").hint("rebalance", "ingest_date").write, root
        writer = writer.partitionBy("ingest_date")
    writer.mode("append").option("compression", "gzip").option("maxRecordsPerFile", items_per_file).text(path)


def day_of_path(path: Column) -> Column:
    """Ingest day, as text, from the folder of a landed file; NULL for other paths."""
    found = F.replace(F.regexp_extract(path, _DAY_IN_PATH, 1), F.lit("/"), F.lit("-"))
    return F.when(path.isNull(), "").otherwise(F.nullif(found, F.lit("")))


def landed_lines(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """Raw lines: value, source_file, written_at, ingest_date. No delimiter, so any text survives.

    `days` limits the scan to the folders of those days, in either layout.
    """
    path = root if days is None else f"{root}/{{{','.join(f'{d.replace("-", "/")},ingest_date={d}' for d in days)}}}"
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", LANDED_FILES)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_modification_time").alias("written_at"),
        )
        .withColumn("ingest_date", day_of_path(F.col("source_file")))
    )


def manifest(lines: DataFrame, source: str) -> DataFrame:
    """Per landed file: path, time written, items, id range, source and format.

    A gzipped file is read by one task, so its lines are summed up before the shuffle.
    """
    item_id = F.get_json_object("value", "$.id").try_cast("bigint")
    return (
        lines.withColumn("_id", item_id)
        .groupBy(F.col("source_file").alias("path"))
        .agg(
            F.max("written_at").alias("timestamp"),
            F.count(F.lit(1)).alias("item_count"),
            F.struct(F.min("_id").alias("start"), F.max("_id").alias("end")).alias("id_range"),
        )
        .withColumns({"source": F.lit(source), "file_format": F.lit("NDJSON_GZ")})
    )


def write_manifest(entries: DataFrame, path: str) -> None:
    """Append manifest entries as JSON lines."""
    entries.write.mode("append").json(path)


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Landed files with their size and day; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", LANDED_FILES)
        .load(root)
        .select("path", "length", "modificationTime")
        .withColumn("ingest_date", day_of_path(F.col("path")))
        .filter("ingest_date IS NOT NULL")
    )


def day_totals(files: DataFrame) -> DataFrame:
    """Files and bytes per landed day."""
    return files.groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("total_bytes")
    )


def landed_days(files: DataFrame) -> DataFrame:
    return files.select("ingest_date").distinct().orderBy("ingest_date")


def compare_files(files: DataFrame, known: DataFrame) -> DataFrame:
    """Days by what happened to their files since the last run: new, changed, lost files and a status.

    new: a day without known files; changed: some file is new or has another length, whatever else happened; shrunk: files
    are gone and no other has changed, as after raw files expired; unchanged: the same files.
    """
    old = known.select("ingest_date", "path", F.col("length").alias("old_length"))
    both = files.select("ingest_date", "path", "length").join(old, ["ingest_date", "path"], "full")
    counts = both.groupBy("ingest_date").agg(
        F.count("old_length").alias("known_files"),
        F.count_if(F.col("old_length").isNull()).alias("new_files"),
        F.count_if(F.col("length") != F.col("old_length")).alias("changed_files"),
        F.count_if(F.col("length").isNull()).alias("lost_files"),
    )
    status = (
        F.when(F.col("known_files") == 0, "new")
        .when(F.col("new_files") + F.col("changed_files") > 0, "changed")
        .when(F.col("lost_files") > 0, "shrunk")
        .otherwise("unchanged")
    )
    return counts.withColumn("status", status)


def compare_days(totals: DataFrame, state: DataFrame) -> DataFrame:
    """Landed days against the state of the last run, with a status.

    new: not in the state; shrunk: fewer files and fewer bytes; unchanged: both figures as before; changed: anything
    else. Totals cannot tell a day that lost files from one that lost some and got others; compare_files can.
    """
    old = state.select(
        "ingest_date", F.col("file_count").alias("old_file_count"), F.col("total_bytes").alias("old_total_bytes")
    )
    same = F.col("file_count").eqNullSafe(F.col("old_file_count")) & F.col("total_bytes").eqNullSafe(
        F.col("old_total_bytes")
    )
    less = (F.col("file_count") < F.col("old_file_count")) & (F.col("total_bytes") < F.col("old_total_bytes"))
    status = (
        F.when(F.col("old_file_count").isNull(), "new").when(same, "unchanged").when(less, "shrunk").otherwise("changed")
    )
    return totals.join(old, "ingest_date", "left").withColumn("status", status)


def days_to_process(compared: DataFrame, reload_shrunk: bool = False) -> DataFrame:
    """Days to read again. A shrunk day is left alone unless asked for: reloading it would lose items."""
    wanted = ["new", "changed"] + (["shrunk"] if reload_shrunk else [])
    return compared.filter(F.col("status").isin(wanted)).select("ingest_date").orderBy("ingest_date")
