"""Sets of tables that are published together: a folder for each release, and a log of moves whose newest says which one counts.

A release is complete once its manifest is written, after its last table; readers get it once a move names it. So they
see all tables of one release or all of another, a build that dies at any point leaves the old set whole, and going
back is one more move. A complete release is never written again: readers may be bound to it. One publisher at a time;
a second one that makes the same move fails.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

_MANIFEST = StructType([StructField("name", StringType()), StructField("fields", StringType()), StructField("n_rows", LongType())])
_MOVES = StructType([StructField("release", LongType()), StructField("at", LongType())])


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _table_path(root: str, release: int, name: str) -> str:
    return f"{root.rstrip('/')}/tables/{release}/{name}"


def _manifest_path(root: str, release: int) -> str:
    return f"{root.rstrip('/')}/manifests/{release}"


def is_complete(spark: SparkSession, root: str, release: int) -> bool:
    return bool(_read(spark, _manifest_path(root, release), _MANIFEST).take(1))


def write_table(df: DataFrame, root: str, release: int, name: str) -> DataFrame:
    """Write a table of a release that is not complete yet, replacing what a run that died left, and return it as stored."""
    spark = df.sparkSession
    if is_complete(spark, root, release):
        raise ValueError(f"release {release} is complete")
    path = _table_path(root, release, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def complete(spark: SparkSession, root: str, release: int, tables: dict[str, DataFrame]) -> None:
    """Write the manifest: names, columns and row counts of the stored tables. The driver sees one row per table."""
    rows = [(name, df.schema.json(), df.count()) for name, df in tables.items()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(_manifest_path(root, release))


def _newest_move(spark: SparkSession, root: str):
    moves = _read(spark, f"{root.rstrip('/')}/moves", _MOVES)
    return moves.agg(F.max_by("release", "at").alias("release"), F.max("at").alias("at")).first()


def current(spark: SparkSession, root: str) -> int | None:
    """The release that readers get; None before the first."""
    return _newest_move(spark, root)["release"]


def move_to(spark: SparkSession, root: str, release: int) -> None:
    """Have readers get a release, newer or older than the current one. Repeating the last move does nothing."""
    if not is_complete(spark, root, release):
        raise ValueError(f"release {release} is not complete")
    newest = _newest_move(spark, root)
    if newest["release"] != release:
        at = (newest["at"] or 0) + 1
        move = spark.createDataFrame([(release,)], StructType(_MOVES.fields[:1]))
        move.coalesce(1).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/moves/at={at}")


def read(spark: SparkSession, root: str, release: int | None = None) -> dict[str, DataFrame]:
    """All tables of a release, the current one by default. They stay those of that release when the pointer moves."""
    release = current(spark, root) if release is None else release
    entries = [] if release is None else _read(spark, _manifest_path(root, release), _MANIFEST).collect()
    if not entries:
        raise ValueError(f"no complete release {'' if release is None else release} in {root}")
    columns = {e["name"]: StructType.fromJson(json.loads(e["fields"])) for e in entries}
    return {name: spark.read.schema(c).parquet(_table_path(root, release, name)) for name, c in columns.items()}


def unneeded(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Releases that readers got once and that are not among the last `keep` different ones; their folders may go."""
    moves = _read(spark, f"{root.rstrip('/')}/moves", _MOVES).groupBy("release").agg(F.max("at").alias("at"))
    return sorted(r["release"] for r in moves.orderBy(F.desc("at")).offset(keep).collect())
