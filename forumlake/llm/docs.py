"""The tables the queries of this subpackage read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forumlake.session import configure

#: Rows of an Arrow batch. Texts may be long, so a batch holds fewer rows than Spark's default.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # Tasks cut ranked groups to their first rows before the shuffle up to this limit.
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
