"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings results depend on (UTC days, strict casts) and settings that keep skewed shuffles spread.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a following operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Bytes of files read by a task that sorts or groups nearly all of its rows: they take some 15 times as much memory.
SPLIT_BYTES = 32 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else started."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g", **conf) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("forumlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local session may go without it: a temporary folder of one machine
    would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="forumlake-"))
    return spark.sparkContext.getCheckpointDir()


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, **options) -> DataFrame:
    """Cut the lineage of a DataFrame: write it to the shared folder and read it back.

    Unlike checkpoint() this keeps the true size for later join decisions and starts from
    a clean plan, which matters in loops. `options` go to the writer.
    """
    path = new_dir(df.sparkSession, "stored")
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Another value of a setting for the jobs run within."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small_splits(spark: SparkSession):
    """Has tasks of the jobs run within read at most SPLIT_BYTES, so that what they sort or group needs no spill to disk.

    Spark's default of 128 MB is millions of rows, more than the share of an executor's memory that a task gets. A lower
    limit of the session is kept.
    """
    key = "spark.sql.files.maxPartitionBytes"
    given = spark.conf.get(key)
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", given.strip().lower()).groups()
    lower = int(number) << 10 * " kmgtp".index(unit or " ") <= SPLIT_BYTES
    return setting(spark, key, given if lower else str(SPLIT_BYTES))


def dropped_shuffles(spark: SparkSession):
    """Has the shuffle files of jobs run within deleted as each job ends.

    Otherwise they stay until the driver's garbage is collected, those of tables stored long ago beside those of the
    next. For jobs that store what they shuffled.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
