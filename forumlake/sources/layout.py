"""Parquet laid out for skipping: each file and row group holds a small range of days and a small share of the names."""

from pyspark.sql import Column, DataFrame, functions as F

from forumlake.session import stored

#: Bits of each of the two columns in the code that rows are laid out by.
BITS = 8
ROW_GROUP_BYTES = 32 << 20
#: A file is sorted by one task.
MAX_FILE_ROWS = 1_000_000


def _day_limits(df: DataFrame, day: str) -> tuple[list[int], int]:
    """Days that cut the rows into 2^BITS parts of about equal size, at most, and the number of rows; the driver sees these only."""
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    number = F.unix_date(F.to_date(day))
    found = df.agg(F.percentile_approx(number, shares, 10_000).alias("limits"), F.count(F.lit(1)).alias("n")).first()
    return sorted(set(found["limits"] or [])), found["n"]


def _spread(number: int, place: int) -> int:
    """The bits of a number, each at every other place."""
    return sum((number >> bit & 1) << (2 * bit + place) for bit in range(BITS))


def _reached(number: Column, limits: list[int]) -> Column:
    """How many limits a number has reached, by halving: a row is compared BITS times."""
    padded = F.array(*[F.lit(x) for x in limits + [2**31 - 1] * ((1 << BITS) - 1 - len(limits))]).cast("array<int>")
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(BITS))])
    numbers = F.array(number)
    return F.transform(
        numbers, lambda x: F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(x >= F.get(padded, at + step - 1), step).otherwise(0))
    )[0]


def _code(limits: list[int], day: str, name: str) -> Column:
    days, names = _reached(F.unix_date(F.to_date(day)), limits), F.pmod(F.xxhash64(name), F.lit(1 << BITS)).cast("int")
    spread = [F.array(*[F.lit(_spread(i, place)).cast("long") for i in range(1 << BITS)]) for place in (0, 1)]
    return F.get(spread[0], days).bitwiseOR(F.get(spread[1], names))


def layout_code(df: DataFrame, day: str, name: str) -> Column:
    """Bits of the day's part and of the name's hash in turn (a Z curve): rows of like code are near in both."""
    return _code(_day_limits(df, day)[0], day, name)


def write_for_skipping(
    df: DataFrame, path: str, day: str, name: str, key: str, files: int, row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Write rows so that a reader with a range of days, a name or a key skips most row groups.

    Days are skipped by minimum and maximum; names and keys by Parquet bloom filters (or dictionaries where a row group has
    few). Rows are cut into files by ranges of the code and the key, so a name with a third of all rows still fills many
    files. Large tables get more than `files`. Rows without a day or name are written too. The rows are read three times,
    for the days' limits, the files' limits and to be written, so they are stored first.
    """
    df = stored(df)
    limits, n = _day_limits(df, day)
    coded = df.withColumn("_code", _code(limits, day, name))
    written = (
        coded.repartitionByRange(max(files, -(-n // MAX_FILE_ROWS)), "_code", key)
        .sortWithinPartitions("_code", day, key)
        .drop("_code")
        .write.option("parquet.block.size", row_group_bytes)
        .option(f"parquet.bloom.filter.enabled#{name}", "true")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
    )
    # The older form of timestamps has no minimum and maximum.
    conf, form = df.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(form)
    conf.set(form, "TIMESTAMP_MICROS")
    try:
        written.parquet(path)
    finally:
        conf.set(form, before)
