"""Parsed items, partitioned by ingest day."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from forumlake.functions import parsed_fields
from forumlake.schemas import SILVER


def parse_items(lines: DataFrame) -> DataFrame:
    """Raw lines (value, source_file, ingest_date) as typed items; every line gives a row."""
    items = parsed_fields(lines, ["ingest_date", "source_file"])
    return items.withColumn("ingest_date_str", F.col("ingest_date")).select(*SILVER.names)


def write_items(items: DataFrame, path: str) -> None:
    """Replace exactly the ingest days that occur in `items`; other days stay as they are.

    Adaptive execution sizes the output files: a large day is split over tasks, small days
    share one.
    """
    (
        items.hint("rebalance", "ingest_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("ingest_date")
        .parquet(path)
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of all days; ingest_date stays text. A filter on it prunes folders but is not required."""
    return spark.read.schema(SILVER).parquet(path)


def register_items(spark: SparkSession, name: str, path: str) -> None:
    """Make the stored items a table of the catalog and load its partitions."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (ingest_date) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
