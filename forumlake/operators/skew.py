"""Joins on keys of which a few may hold a large share of all rows."""

from pyspark.sql import DataFrame, functions as F

from forumlake.session import stored

# A key counts as hot from this many rows on, and only if it holds more than
# 1/MAX_HOT_KEYS of all rows: there can never be more hot keys than that.
MIN_HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1_000
SALTS = 64


def hot_keys(
    df: DataFrame,
    key: str,
    rows: str | None = None,
    min_rows: int = MIN_HOT_ROWS,
    max_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Keys that hold at least `min_rows` and more than 1/`max_keys` of all rows.

    Fewer than `max_keys` keys can satisfy that, so the result may be broadcast whatever
    the size of the data. With `rows` the counts are taken from that column (a dimension
    or a rollup often has them already); otherwise they are counted, map side first.
    """
    if rows is None:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        counts = df.groupBy(key).agg(F.sum(rows).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.filter((F.col("_rows") >= min_rows) & (F.col("_rows") * max_keys > total)).select(key)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot: DataFrame,
    spread_by: list[str],
    salts: int = SALTS,
) -> DataFrame:
    """left JOIN right USING (key), with the rows of hot left keys spread over `salts` tasks.

    `hot` holds the hot keys and must be bounded (see hot_keys): it is broadcast. Left rows
    of a hot key get a salt from a hash of `spread_by`; right rows of a hot key are repeated
    once per salt. All other rows keep salt 0, so nothing else grows. The salt is a function
    of the row, hence a task that is run again yields the same rows. Works for the join types
    that keep to the left side: inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    # Both sides read the list; stored, it is found once.
    marked = F.broadcast(stored(hot.select(F.col(key).alias("_hot_key"), F.lit(True).alias("_hot"))))

    def mark(df: DataFrame) -> DataFrame:
        return df.join(marked, F.col(key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key")

    none, last = F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(none)
    copies = F.when(F.col("_hot"), F.sequence(none, last)).otherwise(F.array(none))
    salted_left = mark(left).withColumn("_salt", salt).drop("_hot")
    salted_right = mark(right).withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
