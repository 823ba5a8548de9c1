"""Discussion trees kept up to date as items arrive in any order.

An item that has arrived is attached (its root and depth are known), or waits for a missing ancestor (which one, and how
many steps above), or hangs below an item that can never be attached. A row is written when an item arrives, and again
when what it waits for does; attached items are never written again. Rows lie by ranges of ids, of which a delivery
reads those of its items, their parents and the items that waited for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from forumlake.operators.skew import MAX_HOT_KEYS, MIN_HOT_ROWS, hot_keys, salted_join
from forumlake.operators.threads import pointed_to, shortened
from forumlake.operators.versions import latest_version
from forumlake.session import stored
from forumlake.sources.parts import append_parts, id_part, names, read_appended

IDS_PER_PART = 1_000_000
_STATE = StructType([StructField(c, LongType()) for c in ("node", "root", "depth", "waits_for", "steps")])
_WAITING = StructType([StructField(c, LongType()) for c in ("waits_for", "node")])


def _known(spark: SparkSession, store: str, ids: DataFrame, run: int, ids_per_part: int) -> DataFrame:
    """The newest rows earlier runs wrote of some ids (column node, once each)."""
    parts = names(ids, id_part("node", ids_per_part))
    rows = read_appended(spark, f"{store}/state", _STATE, parts, run)
    return latest_version(rows.join(ids, "node", "left_semi"), ["node"], ["run"], []).drop("run")


def _looked_up(rows: DataFrame, other: DataFrame, key: str, min_rows: int, max_keys: int) -> DataFrame:
    """Left join to a table with one row for each key; a key that very many rows have is salted."""
    if rows.count() < min_rows:
        return rows.join(other, key, "left")
    hot = hot_keys(rows.filter(F.col(key).isNotNull()), key, min_rows=min_rows, max_keys=max_keys)
    return salted_join(rows, other, key, "left", hot, ["node"])


def _resolved(nodes: DataFrame, min_rows: int, max_keys: int) -> DataFrame:
    """nodes (node, up, steps) with pointers moved up until they leave the table.

    Pointers are moved up among near ids first. Then those of the nodes alone that others still point to go twice as far
    in each round; what still points into the table after log2(rows) rounds hangs on a cycle and gets a null pointer.
    At last every node looks up where its ancestor points.
    """
    given = nodes.select("node", "up", F.col("steps").alias("hops"), F.lit(False).alias("done"))
    rows = shortened(given.filter("up IS NOT NULL")).unionByName(given.filter("up IS NULL"))
    rows = stored(rows.select("node", "up", F.col("hops").alias("steps")))

    def looked_up(current: DataFrame, others: DataFrame) -> DataFrame:
        above = others.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        return _looked_up(current, above, "up", min_rows, max_keys).select(
            "node",
            F.when(F.col("more").isNotNull(), F.col("next")).otherwise(F.col("up")).alias("up"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("more").isNotNull().alias("moved"),
        )

    core = stored(pointed_to(rows, rows))
    current, rounds, moved = core, core.count().bit_length() + 1, True
    while moved and rounds:
        step = stored(looked_up(current, current))
        current, moved, rounds = step.drop("moved"), bool(step.filter("moved").head(1)), rounds - 1
    if moved:
        inside = core.select(F.col("node").alias("up"), F.lit(True).alias("inside"))
        left = _looked_up(current, inside, "up", min_rows, max_keys)
        current = left.select("node", F.when(F.col("inside").isNull(), F.col("up")).alias("up"), "steps")
    return looked_up(rows, current).drop("moved")


def add_items(
    spark: SparkSession,
    items: DataFrame,
    store: str,
    run: int,
    key: str = "item_id",
    parent: str = "parent_id",
    kind: str = "item_type",
    root_kind: str = "story",
    ids_per_part: int = IDS_PER_PART,
    min_hot_rows: int = MIN_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> None:
    """Take a delivery of items: attach those whose root is known, and those that waited for them.

    Together with all deliveries before, in any order, this gives what expand_threads gives for all items at once.
    An item counts as it first arrived; of several in one delivery, the one with the largest parent and kind. Items below
    an item that is no root and has no parent, or on a cycle, are kept but never attached; null keys are left out. Runs
    have rising numbers; one that died is repeated with its number. What is shuffled follows the delivery, what is
    read its ranges of ids.
    """
    hot = (min_hot_rows, max_hot_keys)
    is_root = F.coalesce(F.col(kind) == root_kind, F.lit(False))
    given = items.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("node"), F.col(parent).cast("bigint").alias("up"), is_root.alias("is_root"), F.col(kind).alias("kind")
    )
    given = stored(latest_version(given, ["node"], ["up", "kind"], []).drop("kind"))
    known = _known(spark, store, given.select("node"), run, ids_per_part)
    batch = stored(given.join(known, "node", "left_anti"))

    # Parents that arrived before: their children go on from there.
    outside = batch.filter(~F.col("is_root") & F.col("up").isNotNull()).select(F.col("up").alias("node")).distinct()
    outside = stored(outside.join(batch, "node", "left_anti"))
    above = _known(spark, store, outside, run, ids_per_part).select(
        F.col("node").alias("up"), "root", "depth", "waits_for", F.col("steps").alias("more"), F.lit(True).alias("found")
    )
    placed = stored(_looked_up(batch, above, "up", *hot))
    roots = placed.filter("is_root").select("node", F.col("node").alias("root"), F.lit(0).cast("bigint").alias("depth"))
    below = placed.filter("NOT is_root AND root IS NOT NULL").select("node", "root", (F.col("depth") + 1).alias("depth"))
    anchors = stored(roots.unionByName(below))
    waiting = placed.filter("NOT is_root AND root IS NULL").select(
        "node",
        F.when(F.col("found"), F.col("waits_for")).otherwise(F.col("up")).alias("up"),
        (F.lit(1) + F.coalesce("more", F.lit(0))).cast("bigint").alias("steps"),
    )
    resolved = stored(_resolved(stored(waiting), *hot))

    def ended(rows: DataFrame) -> DataFrame:
        """Rows (node, up, steps) whose pointer is an anchor, as attached; the others as they are."""
        ends = anchors.select(F.col("node").alias("up"), "root", "depth")
        joined = _looked_up(rows, ends, "up", *hot)
        attached = F.col("root").isNotNull()
        return joined.select(
            "node",
            "root",
            (F.col("depth") + F.col("steps")).alias("depth"),
            F.when(~attached, F.col("up")).alias("waits_for"),
            F.when(~attached, F.col("steps")).alias("steps"),
        )

    none = F.lit(None).cast("bigint")
    first = anchors.withColumns({"waits_for": none, "steps": none}).unionByName(ended(resolved))
    first = stored(first.select(*_STATE.names))

    # Items of earlier deliveries that waited for one of this.
    waited = read_appended(spark, f"{store}/waiting", _WAITING, names(batch, id_part("node", ids_per_part)), run)
    freed = waited.join(batch.select(F.col("node").alias("waits_for")), "waits_for", "left_semi").select("node").distinct()
    freed = _known(spark, store, stored(freed), run, ids_per_part).select("node", F.col("waits_for").alias("up"), "steps")
    end_of = first.select(
        F.col("node").alias("up"), "root", "depth", "waits_for", F.col("steps").alias("more")
    )
    again = _looked_up(stored(freed), end_of, "up", *hot).select(
        "node",
        "root",
        (F.col("depth") + F.col("steps")).alias("depth"),
        "waits_for",
        F.when(F.col("root").isNull(), F.col("steps") + F.col("more")).alias("steps"),
    )
    rows = stored(first.unionByName(again))
    append_parts(rows, f"{store}/state", id_part("node", ids_per_part), run)
    still = rows.filter("waits_for IS NOT NULL").select("waits_for", "node")
    append_parts(still, f"{store}/waiting", id_part("waits_for", ids_per_part), run)


def read_threads(spark: SparkSession, store: str, key: str = "item_id") -> DataFrame:
    """Every attached item: root_id, key, depth (0 for the root)."""
    rows = read_appended(spark, f"{store}/state", _STATE).filter("root IS NOT NULL")
    return rows.select(F.col("root").alias("root_id"), F.col("node").alias(key), "depth")


def waiting_items(spark: SparkSession, store: str, key: str = "item_id") -> DataFrame:
    """Items that wait for a missing one: key, waits_for, steps."""
    rows = latest_version(read_appended(spark, f"{store}/state", _STATE), ["node"], ["run"], [])
    return rows.filter("waits_for IS NOT NULL").select(F.col("node").alias(key), "waits_for", "steps")
