"""Discussion trees from parent ids."""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from forumlake.operators.skew import MAX_HOT_KEYS, MIN_HOT_ROWS, hot_keys, salted_join
from forumlake.session import stored

#: Ids that are near enough to meet in one task, and rows that a task looks at together.
NEAR_IDS = 1 << 16
WINDOW_ROWS = 1 << 18


def _moved_up(rows: pa.Table, split: int | None) -> pa.Table:
    """Rows sorted by node, with pointers moved up until they leave the rows or meet a key that has several."""
    node, up, hops, done = (rows[c].to_numpy().copy() for c in ("node", "up", "hops", "done"))
    first = np.concatenate([[True], node[1:] != node[:-1]])
    single = first & np.concatenate([first[1:], [True]])
    if split is not None:
        single &= node != split
    at = np.minimum(np.searchsorted(node, up), len(node) - 1)
    place = np.where((node[at] == up) & single[at] & ~done, at, -1)
    for _ in range(len(node).bit_length() + 1):
        moving = np.flatnonzero(place >= 0)
        if not len(moving):
            break
        above = place[moving]
        moved = up[above], hops[moving] + hops[above], done[above], place[above]
        up[moving], hops[moving], done[moving], place[moving] = moved
    return pa.table({"node": node, "up": pa.array(up, mask=place >= 0), "hops": hops, "done": done})


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same by windows of a sorted partition. All rows of a key are in one window, or it counts as having several."""
    held, n, split = [], 0, None
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= WINDOW_ROWS:
            rows = pa.Table.from_batches(held)
            node = rows["node"].to_numpy()
            cut = int(np.searchsorted(node, node[-1])) or n
            yield from _moved_up(rows.slice(0, cut), int(node[-1]) if cut == n else split).to_batches()
            split = int(node[-1]) if cut == n else split
            held, n = rows.slice(cut).to_batches(), n - cut
    if n:
        yield from _moved_up(pa.Table.from_batches(held), split).to_batches()


def shortened(nodes: DataFrame) -> DataFrame:
    """nodes (node, up, hops, done) with pointers moved up as far as the way goes by nodes of near ids: mostly to the root,
    or to one of the few nodes that rows elsewhere point to. Pointers on or below a cycle become null. None may be null
    before. Ids other than bigint stay as they are."""
    nodes = nodes.select("node", "up", "hops", "done")
    if any(not isinstance(nodes.schema[c].dataType, LongType) for c in ("node", "up", "hops")):
        return nodes
    near = nodes.repartition(F.floor(F.col("node") / F.lit(NEAR_IDS))).sortWithinPartitions("node")
    return near.mapInArrow(_shorten, "node bigint, up bigint, hops bigint, done boolean")


def pointed_to(rows: DataFrame, pointers: DataFrame) -> DataFrame:
    """Rows whose node a pointer names; their own pointers are among them, so rounds need no other rows."""
    return rows.join(pointers.select(F.col("up").alias("node")).distinct(), "node", "left_semi")


def expand_threads(
    items: DataFrame,
    key: str = "item_id",
    parent: str = "parent_id",
    kind: str = "item_type",
    roots: DataFrame | None = None,
    root_kind: str = "story",
    min_hot_rows: int = MIN_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Every story with all items below it: (root_id, key, depth), the root at depth 0.

    Each item points to an ancestor `hops` levels above it, at first to its parent. Parents are mostly near in id, so
    pointers are first moved up within tasks that hold near ids. What is left to do is done for the items alone that
    others still point to: a round moves the pointer to where that ancestor points, so the distance doubles, and they
    take about log2(d) joins, each of the unfinished with all an ancestor may be, finished ones included. At last every
    other item looks its ancestor up. Items below a
    missing parent drop out. A round that finishes nobody ends the loop: what then remains hangs
    below an item that is no story, or in a cycle. An item many others point to is salted.

    Every item of `root_kind` starts its own thread; the feed gives such items no parent.
    `roots` (one column of ids) keeps only those threads: other roots are left out at the
    start, and what hangs below them drops out like items below a missing parent.
    """
    is_root = F.coalesce(F.col(kind) == root_kind, F.lit(False))
    nodes = items.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("node"),
        F.when(is_root, F.col(key)).otherwise(F.col(parent)).alias("up"),
        F.when(is_root, 0).otherwise(1).cast("bigint").alias("hops"),
        is_root.alias("done"),
    )

    if roots is not None:
        wanted = roots.select(F.col(roots.columns[0]).alias("node")).distinct()
        nodes = nodes.filter("done").join(wanted, "node", "left_semi").unionByName(nodes.filter("NOT done"))

    def store_round(step: DataFrame) -> tuple[DataFrame, int, int]:
        saved = stored(step)
        counts = saved.agg(F.count_if(F.col("done")), F.count_if(~F.col("done"))).first()
        return saved, counts[0], counts[1]

    def looked_up(active: DataFrame, rows: DataFrame, n_active: int) -> DataFrame:
        targets = rows.select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("hops").alias("more"), F.col("done").alias("end")
        )
        active = active.select("node", "up", "hops")
        if n_active >= min_hot_rows:
            hot = hot_keys(active, "up", min_rows=min_hot_rows, max_keys=max_hot_keys)
            moved = salted_join(active, targets, "up", "inner", hot, ["node"])
        else:
            moved = active.join(targets, "up")
        return moved.select(
            "node", F.col("next").alias("up"), (F.col("hops") + F.col("more")).alias("hops"), F.col("end").alias("done")
        )

    near, _, n_left = store_round(shortened(nodes.filter("up IS NOT NULL")).filter("up IS NOT NULL"))
    left = near.filter("NOT done")
    threads = near.filter("done")
    if n_left:
        current, arrived, waiting = store_round(pointed_to(near, left))
        finished = [current.filter("done")]
        while arrived and waiting:
            active = current.filter("NOT done")
            current, arrived, waiting = store_round(looked_up(active, reduce(DataFrame.unionByName, [*finished, active]), waiting))
            finished.append(current.filter("done"))
        threads = threads.unionByName(looked_up(left, reduce(DataFrame.unionByName, finished), n_left))
    return threads.select(F.col("up").alias("root_id"), F.col("node").alias(key), F.col("hops").alias("depth"))
