"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlake.session import stored


def smallest_reachable(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root: the smallest node that each linked node reaches.

    Alternates the two star steps of Kiveris et al. (2014): every node's larger neighbours, then its smaller ones,
    are attached to its smallest neighbour, until nothing changes. Each round is written to the shared folder.
    Self links and null ends are ignored; a node without links has no row.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    stars = stored(links.where(f"{a} <> {b}").select(high, low).distinct())
    before = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("u < v").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        # A node that is a smallest one has no smaller neighbours; its own larger ones now name it.
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        stars = stored(small.union(least.select("u", "low")).distinct())
