import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from forumlake.llm import prefix_trie
from forumlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, depth int, part string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expected(rows, rebuilt=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            token = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[conv].append((turn is not None, turn or 0, token, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuilt else 0
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        last = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * last
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), above, len(convs), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def whole(spark, rows, partitions=None):
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA)
    return prefix_trie.turns(df.repartition(partitions) if partitions else df)


def as_is(turns):
    return turns.select("conv_id").distinct(), turns.selectExpr("conv_id", "position + 1 AS depth", "token", "size")


def test_provided_conversations(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(QUERIES["op11_prefix_trie"](spark, SF_DIR)) == expected([tuple(r) for r in rows])


ROWS = [
    (0, 0, "user", "hi"), (0, 1, "bot", "hello é"), (0, 2, "user", "bye"),
    (1, 0, "user", "hi"), (1, 1, "bot", "hello é"), (1, 2, "user", "bye"),
    (2, 0, "user", "hi"), (2, 1, "bot", "other"),
    (3, 0, "user", "hi"),
    (10, None, None, None), (10, 0, "", ""), (10, 0, "", ""),
    (11, 5, "user", ""), (12, None, "userh", "i"), (100, 0, "user", "hi"),
    (None, 0, "user", "lost"), (2**53 + 1, 0, "user", "hi"),
]


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_small_conversations(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(prefix_trie.trie(*as_is(whole(spark, ROWS)))) == expected(ROWS, rebuilt=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_random_conversations_over_many_ranges(spark):
    rng = np.random.default_rng(7)
    rows = []
    for c in range(300):
        for t in range(int(rng.integers(1, 7))):
            rows.append((c, t, "user", "same" if c % 3 == 0 else f"t{int(rng.integers(0, 2 + t))}"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(prefix_trie.trie(*as_is(whole(spark, rows, 5)))) == expected(rows, rebuilt=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_heads_leave_conversations_without_turns(spark):
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in range(60)}
    rows = [(c, t, "user", f"{c % 2} {t}") for c in range(3, 60) for t in range(c % 4 + 1) if c != 20]
    assert any(heads[c] > c % 4 for c in (21, 22, 23, 24))  # nothing left of its own, and no conversation 20
    turns = whole(spark, rows, 4)
    head = "crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % 9"
    made = prefix_trie.with_heads(turns, "conv_id - conv_id % 5", head, 8)
    assert found(prefix_trie.trie(*made)) == expected(rows)


def test_positions_of_a_conversation_that_spans_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, t, "user", f"{t}") for t in range(400)] + [(2, t, "user", "x") for t in range(20)]
        turns = whole(spark, rows, 8)
        placed = [(r["conv_id"], r["position"]) for r in turns.collect()]
        assert sorted(placed) == [(c, t) for c, t, _, _ in rows]
        wanted = sorted(len(f"{t}") for t in range(400))
        assert [r["size"] for r in turns.where("conv_id = 1").orderBy("position").collect()] == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=25))
def test_merges_are_the_ranges_with_a_common_prefix(common):
    n, wanted = len(common) + 1, defaultdict(set)
    for depth in set(common):
        start = 0
        for i in range(n):
            if i == n - 1 or common[i] < depth:
                if depth in common[start:i]:
                    wanted[start].add((depth, i + 1))
                start = i + 1
    made = prefix_trie.merges(np.array(common, np.int64), n)
    assert {k: set(v) for k, v in made.items()} == wanted
    assert all([d for d, _ in v] == sorted((d for d, _ in v), reverse=True) for v in made.values())


def test_empty_table(spark):
    assert found(prefix_trie.trie(*as_is(whole(spark, [])))) == []
    assert found(prefix_trie.trie(*as_is(whole(spark, [(None, 1, "a", "b")])))) == []
