"""The prefix trie of conversations: union-find over the common prefixes of neighbours in sorted order.

Conversations are sorted by their turns, so the members of every node are neighbours. In a range of that order the
edges between neighbours are taken by falling length of their common prefix; every merge of components makes a
branching node whose members are the merged range, and the turns between it and the next merge are nodes of the same members.
Nodes that reach a range's end are contracted to partial sums, which are added across ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlake.session import stored

#: Bytes of a turn's hash. Equal hashes are equal turns but for a chance of 2^-128 a pair.
_TOKEN = 16
_FOUND = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, part long, node binary, parent binary, ends string"
)
_NAMES = [field.split()[0] for field in _FOUND.split(", ")]
_NODE = _NAMES[:8]
_NONE = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 0, in order of turn, null first), token, size of every turn. Stored.

    token is a hash of role and text (null: empty), size the text's UTF-8 bytes. Equal turns are ordered by token. A
    conversation may hold any share of the rows: they are sorted by range, and each range adds what stands before it.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    token = F.substring(F.unhex(F.sha2(whole, 256)), 1, _TOKEN)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", token.alias("token"), F.octet_length(text).cast("long").alias("size")
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["conv_id"].to_numpy()
            first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            if ids[0] == last:
                place[: first[1] if len(first) > 1 else None] += seen
            last, seen = ids[-1], int(place[-1]) + 1
            columns = {"part": pa.array(np.full(len(ids), part)), "conv_id": batch["conv_id"], "place": pa.array(place)}
            yield pa.record_batch(columns | {"token": batch["token"], "size": batch["size"]})

    ordered = rows.repartitionByRange("conv_id", "turn", "token").sortWithinPartitions("conv_id", "turn", "token")
    placed = stored(ordered.mapInArrow(number, "part long, conv_id long, place long, token binary, size long"))
    # Only a range's first conversation can have turns in earlier ranges, so this has one row for each range at most.
    counts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.sum("n").over(earlier)).where("before > 0").drop("n")
    joined = placed.join(before, ["conv_id", "part"], "left")
    position = F.col("place") + F.coalesce("before", F.lit(0))
    return stored(joined.select("conv_id", position.alias("position"), "token", "size"))


def merges(common: np.ndarray, n: int) -> dict[int, list[tuple[int, int]]]:
    """Branching nodes of n sorted sequences by their first member: (depth, end of the members), deepest first.

    common[i] is the length of the common prefix of sequences i and i + 1. Edges are taken by falling length; the
    components they join are ranges, of which a union-find keeps first and last member.
    """
    parent, end = np.arange(n), np.arange(1, n + 1)
    found: dict[int, list[tuple[int, int]]] = {}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    order = np.argsort(-common, kind="stable")
    at = 0
    while at < len(order):
        depth, to = int(common[order[at]]), at
        touched = set()
        while to < len(order) and common[order[to]] == depth:
            left, right = root(int(order[to])), int(order[to]) + 1
            parent[right], end[left] = left, end[right]  # right begins its component: the edge before it was open
            touched.add(left)
            to += 1
        for i in {root(i) for i in touched}:
            found.setdefault(int(i), []).append((depth, int(end[i])))
        at = to
    return found


def with_heads(turns: DataFrame, base: str, head: str, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id) and their turns (conv_id, depth from 1, token, size) with the first turns of another.

    base and head are expressions of conv_id: the conversation whose first turns come first, and how many (at most
    longest). As many of a conversation's own turns go. A base that is missing, or too short, gives what it has.
    """
    ids = turns.select("conv_id").distinct().withColumns({"base": F.expr(base), "head": F.expr(head)})
    first = turns.where(F.col("position") < longest).withColumnRenamed("conv_id", "base")
    given = ids.join(first, "base").where("position < head")
    given = given.select("conv_id", (F.col("position") + 1).alias("depth"), "token", "size")
    sizes = given.groupBy("conv_id").agg(F.count("*").alias("given"))
    own = turns.where(F.col("position") >= F.expr(head)).join(sizes, "conv_id", "left")
    depth = F.coalesce("given", F.lit(0)) + F.col("position") - F.expr(head) + 1
    return ids.select("conv_id"), given.unionByName(own.select("conv_id", depth.alias("depth"), "token", "size"))


def _common(a: bytes, b: bytes) -> int:
    """The number of turns at the start of both."""
    low, high = 0, min(len(a), len(b)) // _TOKEN
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * _TOKEN] == b[: middle * _TOKEN]:
            low = middle
        else:
            high = middle - 1
    return low


def _node(key: bytes, depth: int) -> bytes:
    return hashlib.sha256(key[: depth * _TOKEN]).digest()[:_TOKEN]


def _forest(part: int, before: bytes | None, after: bytes | None, rows: pd.DataFrame) -> Iterator[tuple]:
    """The nodes of a range of the sorted conversations, as rows of _FOUND.

    A node that conversations of another range share (before and after are the neighbouring keys) has its hash in
    node and only what this range adds to its numbers. A node below such a one has the hash of its parent instead
    of the parent's conv_id.
    """
    keys, ids, turns = rows["key"].tolist(), rows["conv_id"].to_numpy(), rows["n_turns"].to_numpy()
    n = len(keys)
    depth = np.array([len(k) // _TOKEN for k in keys])
    inner = np.array([_common(a, b) for a, b in zip(keys[:-1], keys[1:], strict=True)], np.int64)
    left = -1 if before is None else _common(before, keys[0])
    right = -1 if after is None else _common(keys[-1], after)
    common = np.concatenate([[left], inner, [right]])
    sizes = [np.concatenate([[0], np.cumsum(x)]).astype(np.int64) for x in rows["sizes"]]  # bytes of the first d turns
    total = np.array([x[-1] for x in sizes], np.int64)
    own = np.array([x[-1] - x[max(0, c)] for x, c in zip(sizes, common[:-1], strict=True)], np.int64)
    all_bytes, new_bytes, leaves = (
        np.concatenate([[0], np.cumsum(x)]) for x in (total, own, common[1:] < depth)
    )
    begins = np.flatnonzero(depth > common[:-1])  # rows whose first new turn is a child of the node they branch from
    begins = np.sort(common[begins] * (n + 1) + begins)
    branching = merges(inner, n)
    path: list[tuple] = []

    for i in range(n):
        path = path[: common[i] + 1]
        ends = branching.get(i, [])[::-1]  # by rising depth
        for d in range(0 if i == 0 else int(common[i]) + 1, int(depth[i]) + 1):
            while ends and ends[0][0] < d:
                ends.pop(0)
            end = ends[0][1] if ends else i + 1
            new = i > 0 or d > left
            shared = not new or (end == n and d <= right)
            skipped = int(sizes[i][max(0, d - 1)])
            distinct = new_bytes[end] - new_bytes[i + 1] + total[i] - skipped if new else new_bytes[end] - new_bytes[i]
            at, to = np.searchsorted(begins, [d * (n + 1) + i + new, d * (n + 1) + end])
            members = ids[i:end]
            closing = int(np.searchsorted(depth[i:end], d, "right")) if depth[i] == d == turns[i] else 0
            text = ",".join(map(str, members[:closing].tolist()))
            node = _node(keys[i], d) if shared else None
            smallest = int(members.min())
            parent_id, parent_node = path[-1] if path else (None, None)
            path.append((None, node) if shared else (smallest, None))
            yield (
                smallest, d, parent_id, end - i, int(to - at) + int(new and turns[i] > d), int(leaves[end] - leaves[i]),
                int(all_bytes[end] - all_bytes[i] - (end - i) * skipped - distinct),
                None if shared else hashlib.sha256(text.encode()).hexdigest(), part, node, parent_node,
                text if shared and text else None,
            )


def _sorted(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """part, place, conv_id, n_turns, key (tokens of the turns), sizes of every conversation, in order of key and conv_id."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = {"part": pa.array(np.full(n, part)), "place": pa.array(np.arange(seen, seen + n))}
            yield pa.record_batch(columns | {c: batch[c] for c in ("conv_id", "n_turns", "key", "sizes")})
            seen += n

    turn = F.sort_array(F.collect_list(F.struct("depth", "token", "size")))
    grouped = rows.groupBy("conv_id").agg(turn.alias("turns"))
    key = F.unhex(F.array_join(F.transform("turns.token", F.hex), ""))
    whole = ids.join(grouped, "conv_id", "left").select(
        "conv_id",
        "n_turns",
        F.coalesce(key, F.lit(b"")).alias("key"),
        F.coalesce(F.col("turns.size"), F.array().cast("array<bigint>")).alias("sizes"),
    )
    ordered = whole.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    schema = "part long, place long, conv_id long, n_turns long, key binary, sizes array<long>"
    return stored(ordered.mapInArrow(number, schema))


def _digests(open_nodes: DataFrame) -> DataFrame:
    """node and the SHA-256 of the ids that end at it in all ranges, read one after the other."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["node"] == node:
                    state.update(b"," + row["ends"].encode())
                    continue
                if state:
                    done.append((node, state.hexdigest()))
                node, state = row["node"], hashlib.sha256(row["ends"].encode())
            yield pa.record_batch([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.binary(), pa.string()))], ["node", "digest"])
        if state:
            yield pa.record_batch([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "digest"])

    ending = open_nodes.where("ends IS NOT NULL").select("node", "part", "ends")
    return ending.repartition("node").sortWithinPartitions("node", "part").mapInArrow(digest, "node binary, digest string")


def trie(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the conversations, the empty one (depth 0) included.

    ids: conv_id, once each; rows: conv_id, depth (from 1, without gaps), token, size of their turns. Result: conv_id
    (the smallest that begins with the sequence), depth, parent_conv_id (null at depth 0), n_convs (conversations that
    begin with it), n_children, n_leaves (nodes of its subtree without children), saved_tokens (over its subtree, the
    last turn's size times all but one of its conversations), ends_sha256 (of the comma-joined ids, in ascending order, of
    the conversations that are the sequence; of nothing if none is). Conversations without turns belong to depth 0 only.
    No conversations give no nodes.

    Turns after the first one that no other conversation has at its depth are nodes of their own and are not sorted. The
    rest of a conversation is one row of 24 bytes a turn.
    """
    alone = rows.groupBy("depth", "token").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).where("n = 1")
    alone = alone.groupBy("conv_id").agg(F.min("depth").alias("alone"))
    lengths = rows.groupBy("conv_id").agg(F.max("depth").alias("n_turns"))
    known = stored(ids.join(lengths, "conv_id", "left").join(alone, "conv_id", "left").fillna(0, ["n_turns"]))
    cut = stored(rows.join(known.select("conv_id", "n_turns", "alone"), "conv_id"))
    ordered = _sorted(known.select("conv_id", "n_turns"), cut.where("alone IS NULL OR depth <= alone"))

    by_part = Window.orderBy("part")  # one row for each range
    limits = ordered.groupBy("part").agg(F.min_by("key", "place").alias("head"), F.max_by("key", "place").alias("tail"))
    limits = limits.select("part", F.lag("tail").over(by_part).alias("before"), F.lead("head").over(by_part).alias("after"))
    beside = limits.select("part", F.expr("stack(2, -1L, before, -2L, after)").alias("place", "key"))
    beside = beside.select("part", "place", F.lit(0).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("n_turns"), "key")
    beside = beside.withColumn("sizes", F.array().cast("array<bigint>"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).to_pandas().sort_values("place", kind="stable")
        around = dict(zip(rows["place"][:2].tolist(), rows["key"][:2].tolist(), strict=True))
        found = list(_forest(int(rows["part"].iloc[0]), around[-1], around[-2], rows.iloc[2:]))
        types = [field.split()[1] for field in _FOUND.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        columns = [pa.array([f[k] for f in found], kinds[t]) for k, t in enumerate(types)]
        yield pa.record_batch(columns, _NAMES)

    found = stored(ordered.unionByName(beside).groupBy("part").applyInArrow(build, _FOUND))
    shared = found.where("node IS NOT NULL")
    sums = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    merged = shared.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), *sums.values()
    )
    merged = stored(merged.join(_digests(shared), "node", "left"))
    smallest = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    upper = merged.join(smallest, "parent", "left").select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), *sums, F.coalesce("digest", F.lit(_NONE)).alias("ends_sha256")
    )
    # Each range looks up its own shared nodes, so a node with very many children is looked up once for each range.
    of_part = shared.select("part", F.col("node").alias("parent")).join(smallest, "parent")
    lower = found.where("node IS NULL").join(of_part, ["part", "parent"], "left")
    lower = lower.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*_NODE)
    tail = cut.where("depth > alone").select(
        "conv_id",
        "depth",
        F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        (F.col("depth") < F.col("n_turns")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") < F.col("n_turns"), F.lit(_NONE)).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"),
    )
    return upper.select(*_NODE).unionByName(lower).unionByName(tail)
