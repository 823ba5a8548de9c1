"""Versions of the same item, delivered on several days or twice on one day."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_version(df: DataFrame, keys: list[str], newest_first: list[str], ties: list[str] | None = None) -> DataFrame:
    """One row per key: the newest by `newest_first`, compared further by `ties`.

    `ties` defaults to all other columns, which makes the order total and the result
    independent of how rows arrive. NULL keys form one group. Spark keeps only the
    best row per key in each map task before it shuffles (WindowGroupLimit), so a key
    that holds a third of the rows sends one row per task.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.desc_nulls_last(c) for c in [*newest_first, *ties]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_version", rank).filter("_version = 1").drop("_version")


def version_history(
    df: DataFrame, key: str, day: str, newest_first: list[str], measures: list[str], ties: list[str] | None = None
) -> DataFrame:
    """State of every item per day and its change since the day before it was seen.

    The versions of one day are reduced to the last one first, so the window over an
    item holds at most one row per calendar day, however often the item came in.
    """
    states = latest_version(
        df.select(key, day, *newest_first, *measures, *[c for c in ties or [] if c not in measures]),
        [key, day],
        newest_first,
        ties,
    )
    over_days = Window.partitionBy(key).orderBy(F.asc_nulls_first(day))

    def change(measure: str) -> Column:
        return (F.col(measure) - F.lag(measure).over(over_days)).alias(f"{measure}_change")

    return states.select(
        key,
        day,
        *measures,
        *[change(m) for m in measures],
        F.row_number().over(over_days).cast("bigint").alias("state_number"),
    )
