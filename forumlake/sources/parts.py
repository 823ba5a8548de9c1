"""Tables of parts that runs replace: a part is a value of one column, and each run writes its parts under its number.

A log entry, written after the rows, says which parts a run replaced. Readers take of each part what the newest
run left, so a run that dies changes nothing, and one that is repeated reads the same state and writes the same rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: The part of rows that have no value in the column.
NONE = "none"
#: Ranges of ids are dealt to so many parts in turn: files and folders follow the rows, not the number of ranges.
MAX_ID_PARTS = 256
_LOG = StructType([StructField("part", StringType()), StructField("run", LongType())])


def id_part(column: str, ids_per_part: int) -> Column:
    """The part of an id: its range of ids, and every MAX_ID_PARTS-th range after it. Ids grow with time, so a delivery meets few
    parts; beyond MAX_ID_PARTS ranges it reads that share of the table for each range it meets."""
    return F.coalesce(id_range(column, ids_per_part).cast("string"), F.lit(NONE))


def id_range(column: str, ids_per_part: int) -> Column:
    """The number of an id's part; null for null."""
    return F.pmod(F.floor(F.col(column) / F.lit(ids_per_part)), F.lit(MAX_ID_PARTS))


def names(df: DataFrame, part: Column) -> list[str]:
    """The parts of some rows. Only their names reach the driver."""
    return sorted(r[0] for r in df.select(part.alias("part")).distinct().collect())


def replace_parts(rows: DataFrame, path: str, part: Column, parts: list[str], run: int) -> None:
    """Replace the given parts by the rows; a part without rows becomes empty."""
    spark = rows.sparkSession
    (
        rows.withColumns({"part": part, "run": F.lit(run).cast("bigint")})
        .hint("rebalance", "part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part", "run")
        .parquet(f"{path}/rows")
    )
    entries = spark.createDataFrame([(p, run) for p in parts], _LOG)
    entries.coalesce(1).write.mode("overwrite").parquet(f"{path}/log/at={run}")


def _existing(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_parts(
    spark: SparkSession, path: str, schema: StructType, parts: list[str] | None = None, before: int | None = None
) -> DataFrame:
    """Rows of all or the given parts as the newest run (before the given one) left them.

    Parts are folders, so others are not read; nor are, beyond their names, older runs' files.
    """
    log = _existing(spark, f"{path}/log", _LOG)
    if before is not None:
        log = log.filter(F.col("run") < before)
    rows = _existing(spark, f"{path}/rows", StructType([*schema.fields, *_LOG.fields]))
    if parts is not None:
        log, rows = log.filter(F.col("part").isin(parts)), rows.filter(F.col("part").isin(parts))
    if before is not None:
        rows = rows.filter(F.col("run") < before)
    newest = log.groupBy("part").agg(F.max("run").alias("run"))
    return rows.join(newest, ["part", "run"], "left_semi").select(*schema.names)


def append_parts(rows: DataFrame, path: str, part: Column, run: int) -> None:
    """Add rows to their parts under the run's number; a repeated run replaces what it had added."""
    (
        rows.withColumns({"part": part, "run": F.lit(run).cast("bigint")})
        .hint("rebalance", "part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part", "run")
        .parquet(path)
    )


def read_appended(
    spark: SparkSession, path: str, schema: StructType, parts: list[str] | None = None, before: int | None = None
) -> DataFrame:
    """Rows that runs (before the given one) added to all or the given parts, with their run."""
    rows = _existing(spark, path, StructType([*schema.fields, *_LOG.fields]))
    if parts is not None:
        rows = rows.filter(F.col("part").isin(parts))
    if before is not None:
        rows = rows.filter(F.col("run") < before)
    return rows.select(*schema.names, "run")
