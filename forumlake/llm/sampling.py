"""Bounded samples of labelled rows for training on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the number as text, modulo the divisor."""
    return F.crc32(F.col(doc_id).cast("string")) % divisor


def per_label(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[pd.DataFrame, dict]:
    """doc_id, label and text of at most the given number of documents of each label, and how many each label has.

    labels: doc_id once each, label. Documents are chosen by a hash of their doc_id. A label's rows are first thinned by
    that hash to about three times the number, so that ranking them needs little memory however many rows a label has.
    Texts are read for the chosen documents only, so what is broadcast and collected is bounded. A doc_id
    with several texts gives its first one in order.
    """
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").distinct()
    rows = labels.select("doc_id", label).join(known, "doc_id", "left_semi")
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not sizes:
        return pd.DataFrame({"doc_id": [], label: [], "text": []}), sizes
    order = F.xxhash64(F.lit("sample"), "doc_id")
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 3 * most / n))])[F.col(label)]
    thinned = rows.where(F.pmod(order, F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
    ranked = Window.partitionBy(label).orderBy(order, "doc_id")
    chosen = thinned.withColumn("rank", F.row_number().over(ranked)).where(f"rank <= {most}").drop("rank")
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = texts.groupBy("doc_id", label).agg(F.min("text").alias("text"))
    return sample.orderBy(label, F.xxhash64("doc_id"), "doc_id").toPandas(), sizes
