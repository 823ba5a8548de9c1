"""Control tables: the high-water mark of landed ids, failed look-ups, and the files last seen per day.

All are append-only, one small file per run, and read as their newest entry. A run that
dies between two steps leaves the old entry in force; nothing is ever overwritten.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from forumlake.operators.versions import latest_version
from forumlake.schemas import DAY_STATE, FILE_STATE, HIGH_WATER_MARK, LOOKUP_STATE


def _read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_mark(spark: SparkSession, path: str) -> int:
    """Highest id landed so far, 0 before the first run."""
    return _read_or_empty(spark, path, HIGH_WATER_MARK).agg(F.coalesce(F.max("last_id"), F.lit(0))).first()[0]


def write_mark(spark: SparkSession, path: str, last_id: int) -> None:
    """Record the mark after the items up to it have been published."""
    spark.createDataFrame([(last_id,)], HIGH_WATER_MARK).coalesce(1).write.mode("append").parquet(path)


def newest_state(entries: DataFrame) -> DataFrame:
    """Last entry per day."""
    return latest_version(entries, ["ingest_date"], ["run_id"]).select(*DAY_STATE.names)


def read_day_state(spark: SparkSession, path: str) -> DataFrame:
    return newest_state(_read_or_empty(spark, path, DAY_STATE))


def write_day_state(totals: DataFrame, path: str, run_id: int) -> None:
    """Record files and bytes of the days a run has processed; other days keep their entry."""
    rows = totals.select("ingest_date", "file_count", "total_bytes", F.lit(run_id).cast("bigint").alias("run_id"))
    rows.coalesce(1).write.mode("append").parquet(path)


def read_file_state(spark: SparkSession, path: str) -> DataFrame:
    """Files of each day as the last run that parsed it saw them."""
    entries = _read_or_empty(spark, path, FILE_STATE)
    last = entries.groupBy("ingest_date").agg(F.max("run_id").alias("run_id"))
    return entries.join(last, ["ingest_date", "run_id"], "left_semi")


def write_file_state(files: DataFrame, path: str, run_id: int) -> None:
    """Record all files of the days a run has processed."""
    rows = files.select("ingest_date", "path", "length", F.lit(run_id).cast("bigint").alias("run_id"))
    rows.hint("rebalance").write.mode("append").parquet(path)


def failed_lookups(spark: SparkSession, path: str) -> DataFrame:
    """Ids whose last look-up failed: item_id, attempt (how many failed so far), error."""
    newest = latest_version(_read_or_empty(spark, path, LOOKUP_STATE), ["item_id"], ["attempt"])
    return newest.filter("status = 'failed'").select("item_id", "attempt", "error")


def write_lookups(lookups: DataFrame, path: str) -> None:
    """Record failed look-ups, and how look-ups of ids that had failed before went."""
    lookups.select(*LOOKUP_STATE.names).hint("rebalance").write.mode("append").parquet(path)
