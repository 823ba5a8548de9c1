"""Near-duplicate documents by SimHash fingerprints that differ in few bits, found by ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlake.llm.components import smallest_reachable
from forumlake.session import stored

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Variants a task writes out and sorts at once, and that one bucket of the shuffle stands for.
ROUND_VARIANTS = 1 << 20
BUCKET_VARIANTS = 1 << 23
LEAST_BUCKET_BITS = 6
_BITS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text as an unsigned integer.

    A-Z become lower case, words are runs of bytes other than ASCII white space, shingles are runs of
    shingle_words words with repeats; a text with fewer words is one shingle, one without words gives 0.
    A bit is set if more than half of the shingles' XXH64 values (seed 42) have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    begin = [0, *(gaps + 1).tolist()]
    end = [*gaps.tolist(), len(joined)][min(shingle_words, len(words)) - 1 :]
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(end), _BITS_AT_ONCE):
        hashes = [
            xxhash.xxh64_intdigest(joined[a:b], SEED)
            for a, b in zip(begin[at : at + _BITS_AT_ONCE], end[at : at + _BITS_AT_ONCE], strict=False)
        ]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(end)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fingerprint (64 bits as a signed long) of every document; a null text has no words."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in batch["text"]), np.uint64)
            yield pa.record_batch({"doc_id": batch["doc_id"], "fingerprint": pa.array(prints.view(np.int64))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(compute, f"doc_id {kind}, fingerprint long")


class Ball:
    """The masks of up to radius of 64 bits, and a linear hash that deals variants to buckets.

    The hash of a variant is the hash of its fingerprint XOR the hash of the mask. So each bucket gets an even
    share of every fingerprint's variants, however close fingerprints lie, and a task can write out just the
    variants of its own bucket.
    """

    def __init__(self, radius: int, bits: int):
        single = np.uint64(1) << np.arange(64, dtype=np.uint64)
        masks = [0, *(sum(1 << b for b in c) for k in range(1, radius + 1) for c in combinations(range(64), k))]
        self.masks = np.array(masks, np.uint64)
        self.radius = radius
        self.bits = bits
        columns = [xxhash.xxh64_intdigest(int(b).to_bytes(8, "little"), SEED) for b in single]
        self.columns = np.array(columns, np.uint64) >> np.uint64(64 - bits)
        self.of_mask = self.hash(self.masks)
        order = np.argsort(self.of_mask, kind="stable")
        self.sorted_masks = self.masks[order]
        self.first = np.searchsorted(self.of_mask[order], np.arange((1 << bits) + 1))

    def hash(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.uint64)
        for b in range(64):
            out ^= ((values >> np.uint64(b)) & np.uint64(1)) * self.columns[b]
        return out

    def masks_of(self, code: int) -> np.ndarray:
        return self.sorted_masks[self.first[code] : self.first[code + 1]]


def _deal(ball: Ball, pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints for each bucket that holds at least one of their variants, packed per batch."""
    reached = np.unique(ball.of_mask)
    most = max(1, (1 << 21) // len(reached))
    for batch in pairs:
        prints = batch["fingerprint"].to_numpy(zero_copy_only=False).view(np.uint64)
        ids = batch["node"].to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), most):
            part = prints[at : at + most]
            buckets = (ball.hash(part)[:, None] ^ reached[None, :]).ravel()
            order = np.argsort(buckets, kind="stable")
            found, first = np.unique(buckets[order], return_index=True)
            row = (order // len(reached)).astype(np.int64)
            yield pa.record_batch(
                {
                    "bucket": pa.array(found.astype(np.int64)),
                    "prints": pa.array([part[r].tobytes() for r in np.split(row, first[1:])], pa.binary()),
                    "nodes": pa.array([ids[at + r].tobytes() for r in np.split(row, first[1:])], pa.binary()),
                }
            )


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each of n indexes is linked with."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _collide(ball: Ball, bucket: int, prints: np.ndarray, ids: np.ndarray, max_bits: int) -> pd.DataFrame:
    """Links between fingerprints with a variant in common in this bucket, as a forest.

    Variants are written out in rounds by further bits of their hash, so that a round fits in memory.
    """
    order = np.argsort(ids, kind="stable")
    prints, ids = prints[order], ids[order]
    expected = len(prints) * len(ball.masks) / (1 << ball.bits)
    extra = max(0, int(np.ceil(np.log2(max(1.0, expected / ROUND_VARIANTS)))))
    fine = Ball(ball.radius, ball.bits + extra)
    codes = fine.hash(prints)
    by_code = np.argsort(codes, kind="stable")
    values, firsts = np.unique(codes[by_code], return_index=True)
    members = np.split(by_code, firsts[1:])
    links = [np.zeros((0, 2), np.int64)]
    for part in range(1 << extra):
        target = bucket << extra | part
        masks = [fine.masks_of(int(code) ^ target) for code in values]
        variant = np.concatenate([(prints[r][:, None] ^ m).ravel() for r, m in zip(members, masks, strict=True)])
        owner = np.concatenate([np.repeat(r, len(m)) for r, m in zip(members, masks, strict=True)])
        order = np.argsort(variant)
        variant, owner = variant[order], owner[order]
        same = variant[1:] == variant[:-1]
        if not same.any():
            continue
        head = np.concatenate([[True], ~same])
        run = np.cumsum(head) - 1
        least = np.minimum.reduceat(owner, np.flatnonzero(head))[run]
        pair = np.unique(np.stack([owner, least], 1)[owner != least], axis=0)
        near = np.bitwise_count(prints[pair[:, 0]] ^ prints[pair[:, 1]]) <= max_bits
        links.append(pair[near])
    pairs = np.unique(np.concatenate(links), axis=0)
    root = _roots(len(ids), pairs[:, 0], pairs[:, 1])
    child = np.flatnonzero(root != np.arange(len(ids)))
    return pd.DataFrame({"a": ids[child], "b": ids[root[child]]})


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that join all nodes whose fingerprints differ in at most max_bits bits.

    nodes: node long, fingerprint long, each fingerprint once. Two fingerprints at most max_bits apart have a
    variant in common that is at most half of that (rounded up) from either. Every fingerprint goes to the
    buckets of its variants; variants that share a bucket travel as one row and are written out there. What a
    bucket finds is returned as a forest, which joins the same nodes as all its pairs.
    """
    radius = (max_bits + 1) // 2
    n = nodes.count()
    ball = Ball(radius, 1)
    bits = int(np.ceil(np.log2(max(1.0, n * len(ball.masks) / BUCKET_VARIANTS))))
    ball = Ball(radius, max(LEAST_BUCKET_BITS, bits))

    def deal(batches):
        return _deal(ball, batches)

    def collide(key, rows):
        prints = np.frombuffer(b"".join(rows["prints"]), np.uint64)
        return _collide(ball, int(key[0]), prints, np.frombuffer(b"".join(rows["nodes"]), np.int64), max_bits)

    dealt = nodes.select("node", "fingerprint").mapInArrow(deal, "bucket long, prints binary, nodes binary")
    return dealt.groupBy("bucket").applyInPandas(collide, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document.

    component_id is the smallest doc_id that a document reaches over links between fingerprints that differ in at
    most max_bits bits. Documents with equal fingerprints are linked; documents without words (null, empty, white
    space only) have fingerprint zero and are linked like any other. Repeated rows give repeated rows. An empty
    table gives an empty result. Other columns are not read. doc_id must not be null for a row to take part:
    rows with a null doc_id keep a null component unless their fingerprint is that of another document. Rows with
    the same doc_id count as one document, whose texts are linked.
    """
    prints = stored(fingerprints(docs, shingle_words))
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("node")))
    known = nodes.where("node IS NOT NULL")
    roots = smallest_reachable(near_links(known, max_bits), "a", "b")
    labelled = nodes.join(roots, "node", "left").select(
        "fingerprint", F.coalesce("root", "node").alias("component_id")
    )
    joined = prints.join(labelled, "fingerprint", "left")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Documents without near-duplicates of a document with a smaller doc_id; all their columns.

    One row stays of each group, the one with the smallest doc_id. Rows that share that doc_id all stay.
    """
    groups = near_duplicates(docs, shingle_words, max_bits)
    first = groups.where("doc_id <=> component_id").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["_kept"]), "left_semi")
