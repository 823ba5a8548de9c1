"""Layout for skipping: the same rows, and few of them scanned for a day and an author."""

from pyspark.sql import functions as F

from forumlake.sources import layout
from forumlake.sources.layout import layout_code, write_for_skipping


def rows_scanned(df):
    """Rows that the file scan handed on: those of the row groups that were not skipped."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def items(spark, n=200_000):
    # A third of all rows have one author; names are long enough not to be one dictionary.
    author = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("author"), F.pmod(F.xxhash64("id"), F.lit(5000)).cast("string")))
    day = F.timestamp_seconds(F.lit(1_735_689_600) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(365 * 86400)))
    return spark.range(n).select("id", author.alias("author"), day.alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_rows_stay_and_row_groups_are_skipped(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = items(spark).unionByName(spark.createDataFrame([(-1, None, None, None)], items(spark, 1).schema))
        path, plain = str(tmp_path / "laid"), str(tmp_path / "plain")
        write_for_skipping(df, path, "at", "author", "id", files=8, row_group_bytes=64 << 10)
        df.repartition(8).write.option("parquet.block.size", 64 << 10).parquet(plain)
        laid, mixed = spark.read.parquet(path), spark.read.parquet(plain)
        assert laid.exceptAll(mixed).count() == 0 and laid.count() == mixed.count() == 200_001
        month = "at >= '2025-03-01' AND at < '2025-04-01'"
        asked = [month, f"{month} AND author = 'author17'", f"{month} AND author = 'hot'", "id = 4711"]
        for condition, share in zip(asked, (0.2, 0.05, 0.2, 0.2), strict=True):
            assert laid.filter(condition).count() == mixed.filter(condition).count() > 0
            assert rows_scanned(laid.filter(condition)) < share * 200_000, condition
        assert rows_scanned(mixed.filter(month)) > 0.9 * 200_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "laid")
    write_for_skipping(items(spark, 0), path, "at", "author", "id", files=2)
    assert spark.read.schema(items(spark, 0).schema).parquet(path).count() == 0


def test_code_takes_turns(spark):
    df = items(spark, 1000)
    codes = df.select(layout_code(df, "at", "author").alias("c")).agg(F.min("c"), F.max("c"), F.count_distinct("c")).first()
    assert codes[0] >= 0 and codes[1] < 1 << 16 and codes[2] > 300


def test_code_compares_few_limits_and_reads_the_rows_once(spark, tmp_path, monkeypatch):
    df = items(spark, 3000).unionByName(spark.createDataFrame([(-1, None, None, None)], items(spark, 1).schema))
    limits = layout._day_limits(df, "at")[0]
    day, name = F.unix_date(F.to_date("at")), F.pmod(F.xxhash64("author"), F.lit(256)).cast("int")
    got = df.select(layout_code(df, "at", "author").alias("code"), day.alias("day"), name.alias("name")).collect()
    for r in got:
        part = sum(r.day is not None and x <= r.day for x in limits)
        assert r.code == sum((part >> b & 1) << 2 * b | (r.name >> b & 1) << 2 * b + 1 for b in range(8))
    # Neither the limits nor the files' limits compute the rows again, and files hold a bounded number of rows.
    monkeypatch.setattr(layout, "MAX_FILE_ROWS", 100)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    path = str(tmp_path / "laid")
    write_for_skipping(df.mapInArrow(counted, df.schema), path, "at", "author", "id", files=2)
    assert seen.value == 3001
    written = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in written) == 3001 and len(written) > 20
