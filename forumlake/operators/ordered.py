"""Exact order statistics without putting a whole group into one task."""

from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

from forumlake.operators.skew import hot_keys, salted_join
from forumlake.session import stored

SLICES = 256


def running_weight(
    histogram: DataFrame, value: str, weight: str, group: list[str] = [], slices: int = SLICES
) -> DataFrame:
    """Adds `below` (weight of the smaller values of the group) and `in_group` (weight of the group).

    `histogram` must hold one row per group and value. It is stored once, then cut into
    `slices` value ranges of about equal row count; each window runs over one group and
    range, and the totals of the ranges (at most `slices` per group) are added on top. The
    limits come to the driver, `slices` numbers at most; where they lie affects speed only.
    """
    rows = stored(histogram)
    shares = [i / slices for i in range(1, slices)]
    limits = rows.agg(F.approx_percentile(value, shares, 20 * slices)).first()[0] or []
    limits = sorted(set(limits))
    slice_of = F.size(F.filter(F.array(*map(F.lit, limits)), lambda x: x < F.col(value))) if limits else F.lit(0)
    sliced = rows.withColumn("_slice", slice_of)

    totals = sliced.groupBy(*group, "_slice").agg(F.sum(weight).alias("_weight"))
    by_group = Window.partitionBy(*group, F.lit(0))
    smaller = by_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_{g}") for g in group],
        F.col("_slice").alias("_offset_slice"),
        F.coalesce(F.sum("_weight").over(smaller), F.lit(0)).alias("_offset"),
        F.sum("_weight").over(by_group).alias("in_group"),
    )

    inside = Window.partitionBy(*group, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_slice") == F.col("_offset_slice")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return (
        sliced.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(offsets, same)
        .withColumn("below", F.col("_offset") + F.col("_inside"))
        .drop("_slice", "_offset_slice", "_offset", "_inside", *[f"_{g}" for g in group])
    )


def exact_quantiles(
    df: DataFrame, value: str, quantiles: dict[str, str], group: list[str] = [], slices: int = SLICES
) -> DataFrame:
    """Per group the smallest value that at least the given share of the non-null values does not exceed.

    `quantiles` maps an output column to a share written as text, such as {"median": "0.5"}.
    The result is always an element of the data, never an interpolation.
    """
    histogram = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_weight(histogram, value, "_n", group, slices)
    reached = F.col("below") + F.col("_n")
    return ranked.groupBy(*group).agg(
        *[
            F.min(F.when(reached >= F.lit(Decimal(share)) * F.col("in_group"), F.col(value))).alias(name)
            for name, share in quantiles.items()
        ]
    )


def ranked(df: DataFrame, value: str, spread_by: list[str], rank: str = "rank", slices: int = SLICES, **hot) -> DataFrame:
    """Adds the rank of each row by descending `value`; equal values share a rank, NULLs come last.

    The rows are stored once; distinct values are ranked by running weight and joined back,
    salted, since very many rows may share one value.
    """
    rows = stored(df.withColumn("_order", -F.col(value)))
    histogram = rows.groupBy("_order").agg(F.count(F.lit(1)).alias("_n"))
    known = running_weight(histogram.filter("_order IS NOT NULL"), "_order", "_n", slices=slices)
    many = hot_keys(histogram, "_order", rows="_n", **hot)
    joined = salted_join(rows, known.select("_order", "below", "in_group"), "_order", "left", many, spread_by)
    total = rows.agg(F.count("_order")).scalar()
    return joined.withColumn(rank, (F.coalesce("below", total) + 1).cast("bigint")).drop("_order", "below", "in_group")
