"""States as intervals: the days on which an unchanged state began and was last seen, and the day the next one began."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def state_intervals(states: DataFrame, key: str, day: str, measures: list[str]) -> DataFrame:
    """One row per key and run of days with equal measures: key, measures, first_day, last_day, n_days, next_day.

    states has one row per key and day. NULL equals NULL. next_day is the first day of the key's next interval, NULL for the
    newest. Rows without a key or a day belong to no interval. One shuffle by key; a window holds one key's days.
    """
    known = states.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day, *measures)
    by_day = Window.partitionBy(key).orderBy(day)
    same = F.lag(F.lit(True), 1, False).over(by_day)
    for measure in measures:
        same = same & F.col(measure).eqNullSafe(F.lag(measure).over(by_day))
    runs = known.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(by_day))
    spans = runs.groupBy(key, "_run", *measures).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n_days")
    )
    following = F.lead("first_day").over(Window.partitionBy(key).orderBy("_run"))
    return spans.select(key, *measures, "first_day", "last_day", "n_days", following.alias("next_day"))


def _holds(day: Column) -> Column:
    return (F.col("first_day") <= day) & (F.col("next_day").isNull() | (F.col("next_day") > day))


def as_of(intervals: DataFrame, day: str) -> DataFrame:
    """The interval that holds on a day for every key first seen by then. A state holds until another is seen."""
    return intervals.filter(_holds(F.lit(day)))


def join_as_of(rows: DataFrame, intervals: DataFrame, key: str, day: str) -> DataFrame:
    """Rows with the state their key had on the row's day; NULL states before the key was first seen.

    Joined on the key, so a row meets its own key's intervals only; adaptive execution splits a key with very many rows.
    """
    renamed = intervals.withColumnRenamed(key, "_key")
    return rows.join(renamed, (F.col(key) == F.col("_key")) & _holds(F.col(day)), "left").drop("_key")
