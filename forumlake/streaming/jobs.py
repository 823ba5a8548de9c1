from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from forumlake.operators.versions import latest_version
from forumlake.schemas import SILVER
from forumlake.session import stored
from forumlake.sources import bronze, silver
from forumlake.sources.parts import id_range


def landed_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw lines of files as they land. A file is taken once, by path; one rewritten in place is not seen again."""
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", bronze.LANDED_FILES)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(root)
        .select("value", F.col("_metadata.file_path").alias("source_file"))
        .withColumn("ingest_date", bronze.day_of_path(F.col("source_file")))
    )


def append_parsed(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Parse new lines into a silver folder of its own, exactly once.

    The sink's log decides what belongs to the folder, so days in it must not be overwritten
    by batch jobs; reload_touched_days is the form that goes together with them.
    """
    return (
        silver.parse_items(lines)
        .writeStream.format("parquet")
        .partitionBy("ingest_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_unique(items: DataFrame, path: str, checkpoint: str, within: str = "7 days") -> StreamingQuery:
    """Append items to a folder, exact copies (all columns equal) only once if they come within the given time of the first.

    Time is when a row is taken up, so no row is ever too late and none but a copy is dropped. What is kept for that
    time is a digest of each row, in the state store, by digest; a copy that comes later is appended again and staging
    keeps one version. Columns may have any type that has a JSON form.
    """
    digest = F.sha2(F.to_json(F.struct(*items.columns), {"ignoreNullFields": "false"}), 256)
    taken = items.withColumns({"_digest": digest, "_taken": F.current_timestamp()})
    first = taken.withWatermark("_taken", within).dropDuplicatesWithinWatermark(["_digest"])
    return (
        first.drop("_digest", "_taken")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def reload_touched_days(lines: DataFrame, root: str, path: str, checkpoint: str) -> StreamingQuery:
    """Parse again every day that got new files, late ones included, and replace it in silver.

    A repeated batch replaces the same days with the same rows. Only day names reach the driver.
    """

    def reload(batch: DataFrame, _: int) -> None:
        days = [r.ingest_date for r in bronze.landed_days(batch).collect() if r.ingest_date]
        if days:
            landed = bronze.landed_lines(batch.sparkSession, root, days)
            silver.write_items(silver.parse_items(landed), path)

    # The days are all a batch is asked for, so the lines' text stays in the files.
    return lines.select("ingest_date").writeStream.foreachBatch(reload).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_CURRENT = StructType([*SILVER.fields, StructField("bucket", LongType()), StructField("version", LongType())])


def read_current(
    spark: SparkSession, path: str, buckets: list[int] | None = None, before: int | None = None
) -> DataFrame:
    """Newest version of every item from the snapshots maintain_current keeps."""
    snapshots = spark.read.schema(_CURRENT).parquet(path)
    if buckets is not None:
        snapshots = snapshots.filter(F.col("bucket").isin(buckets))
    if before is not None:
        snapshots = snapshots.filter(F.col("version") < before)
    # One row per bucket; its size decides whether it is broadcast.
    newest = snapshots.groupBy("bucket").agg(F.max("version").alias("version"))
    return snapshots.join(newest, ["bucket", "version"], "left_semi").select(*SILVER.names)


def maintain_current(items: DataFrame, path: str, checkpoint: str, ids_per_bucket: int = 1_000_000) -> StreamingQuery:
    """Keep a table of the newest version of every item under late and repeated delivery.

    A bucket holds a range of ids, and every MAX_ID_PARTS-th range after it, so there are never more than that. Ids grow
    with time, so a batch touches few buckets, reads only those, merges, and writes them as a new snapshot under its own batch number. Older
    snapshots stay: a batch that is repeated after a failure starts from the same state and
    writes the same rows. Items without id form a bucket of their own, which holds one row.
    """

    def newest(df: DataFrame) -> DataFrame:
        return latest_version(df.select(*SILVER.names), ["item_id"], ["ingest_date", "source_file"])

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.coalesce(id_range("item_id", ids_per_bucket), F.lit(-(2**62))).alias("bucket")
        new = stored(newest(batch))
        touched = [r.bucket for r in new.select(bucket).distinct().collect()]
        try:
            new = newest(new.unionByName(read_current(spark, path, touched, before=batch_id)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        (
            new.select("*", bucket, F.lit(batch_id).cast("bigint").alias("version"))
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "version")
            .parquet(path)
        )

    return items.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_STORIES = StructType(
    [
        StructField("item_key", StringType()),
        StructField("story_date", DateType()),
        StructField("user_key", StringType()),
        StructField("total_comments", LongType()),
        StructField("story_month", StringType()),
        StructField("version", LongType()),
    ]
)
_DAILY = StructType(
    [
        StructField("story_date", DateType()),
        StructField("stories_per_day", LongType()),
        StructField("avg_comments_per_story", DoubleType()),
        StructField("active_authors", LongType()),
        StructField("batch", LongType()),
    ]
)
_NO_MONTH = "none"


def _stories_of(spark: SparkSession, path: str, months: list[str], before: int) -> DataFrame:
    """Stories of the given months as the newest batch before this one left them."""
    try:
        kept = spark.read.schema(_STORIES).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STORIES)
    kept = kept.filter(F.col("story_month").isin(months) & (F.col("version") < before))
    newest = kept.groupBy("story_month").agg(F.max("version").alias("version"))
    return kept.join(newest, ["story_month", "version"], "left_semi")


def maintain_daily(stories: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Daily story counts, mean comments and active authors, kept up to date per day and equal to the daily marts.

    A batch reads the stories known for the months it touches, however old, takes the newest delivery of each, and
    computes their days anew: late stories are never dropped and repeated ones count once. A story's day is the day it
    was created, which does not change. Each batch writes its months under its own number, so a repeated batch starts
    from the same state and replaces what it wrote. Only names of months reach the driver.
    """

    def recompute(batch: DataFrame, batch_id: int) -> None:
        month = F.coalesce(F.date_format("created_at", "yyyy-MM"), F.lit(_NO_MONTH)).alias("story_month")
        date, version = F.to_date("created_at").alias("story_date"), F.lit(batch_id).cast("bigint").alias("version")
        new = stored(batch.select("item_key", date, "user_key", "total_comments", month, version))
        months = [r.story_month for r in new.select("story_month").distinct().collect()]
        known = _stories_of(batch.sparkSession, f"{path}/stories", months, batch_id)
        merged = latest_version(new.unionByName(known.select(*new.columns)), ["item_key"], ["version"])
        merged = stored(merged.withColumn("version", version))
        writer = merged.hint("rebalance", "story_month").write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("story_month", "version")
        writer.parquet(f"{path}/stories")
        daily = merged.groupBy("story_date").agg(
            F.count("item_key").alias("stories_per_day"),
            F.avg("total_comments").alias("avg_comments_per_story"),
            F.count_distinct("user_key").alias("active_authors"),
        )
        daily.coalesce(1).write.mode("overwrite").parquet(f"{path}/daily/batch={batch_id}")

    return (
        stories.writeStream.foreachBatch(recompute)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Newest row per day of what maintain_daily keeps."""
    kept = spark.read.schema(_DAILY).parquet(f"{path}/daily")
    return latest_version(kept, ["story_date"], ["batch"]).drop("batch")
