"""Training sequences with as little padding as possible: exact complements of lengths first, then best fit.

Which lengths share a sequence is settled on how many pieces there are of each length, at most as many numbers as a
window has tokens. Which piece goes where follows from its place among the pieces of its length, so pieces never meet.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlake.llm.encoding import encoder
from forumlake.llm.words import gathered
from forumlake.session import stored

WINDOW = 2048
SLICE_BYTES = 2 << 20
#: Orders of rounds: how many pieces complement another at most in each.
ROUNDS = ((1, 2, 3), (1, 2), (1,))


@dataclass
class Group:
    """Sequences of one kind: how many there are, and the lengths in each with how often they follow each other."""

    copies: int
    runs: list[tuple[int, int]]


class _Lengths:
    """How many pieces of each length are left, and of how many available pairs each number is the sum."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.pairs = np.zeros(2 * len(counts), np.int64)
        some = np.flatnonzero(self.left > 0)
        for x in some:
            self.pairs[x + some[some > x]] += 1
        twice = np.flatnonzero(self.left > 1)
        self.pairs[2 * twice] += 1

    def change(self, length: int, by: int) -> None:
        before, after = self.left[length], self.left[length] + by
        self.left[length] = after
        self.pairs[2 * length] += int(after > 1) - int(before > 1)
        if (before > 0) != (after > 0):
            some = np.flatnonzero(self.left > 0)
            self.pairs[length + some[some != length]] += int(after > 0) - int(before > 0)

    def pair(self, total: int) -> tuple[int, ...] | None:
        """The two available lengths with this sum that lie furthest apart."""
        if total < 2 or not self.pairs[total]:
            return None
        high = np.arange(min(total, len(self.left)) - 1, (total - 1) // 2, -1)
        there = (self.left[high] > 0) & (self.left[total - high] > (high == total - high))
        return (int(high[there.argmax()]), total - int(high[there.argmax()])) if there.any() else None

    def triple(self, total: int) -> tuple[int, ...] | None:
        """Three available lengths with this sum, the largest as large as it can be."""
        high = np.arange(min(total - 2, len(self.left) - 1), (total - 1) // 3, -1)
        for x in high[(self.left[high] > 0) & (self.pairs[total - high] > 0)].tolist():
            found = self.pair(total - x)
            if found and all(self.left[k] >= n for k, n in Counter((x, *found)).items()):
                return (x, *found)
        return None

    def complement(self, gap: int, most: int) -> tuple[int, ...] | None:
        """At most so many (one, two or three) available lengths that fill the gap exactly."""
        if gap < len(self.left) and self.left[gap] > 0:
            return (gap,)
        return (self.pair(gap) if most > 1 else None) or (self.triple(gap) if most > 2 else None)


def _exact(counts: np.ndarray, window: int, rounds: tuple[int, ...]) -> list[Group]:
    """In each round, sequences that at most so many complements of a piece fill, longest pieces first; then best fit."""
    lengths, groups = _Lengths(counts), []
    for most in rounds:
        for length in range(window, 0, -1):
            while lengths.left[length] > 0:
                lengths.change(length, -1)
                found = () if length == window else lengths.complement(window - length, most)
                lengths.change(length, 1)
                if found is None:
                    break
                parts = Counter((length, *found))
                copies = int(min(lengths.left[k] // n for k, n in parts.items()))
                for k, n in parts.items():
                    lengths.change(k, -n * copies)
                groups.append(Group(copies, sorted(parts.items(), reverse=True)))
    return groups + _best_fit(lengths.left, window)


def plan(counts: np.ndarray, window: int = WINDOW) -> list[Group]:
    """Sequences for counts[n] pieces of each length n up to window.

    While one, two or three lengths that are left fill the gap beside a piece exactly, as many sequences of that kind are
    made as there are pieces for. What is left is placed by best fit, the longest first: where least room is left, or
    else in a new sequence. Complements of any number at once use up pieces that others need more in some tables
    and fewer at a time do in others, so the orders in ROUNDS are tried and the one with the fewest sequences is taken.
    """
    return min((_exact(counts, window, r) for r in ROUNDS), key=lambda groups: sum(g.copies for g in groups))


def _best_fit(counts: np.ndarray, window: int) -> list[Group]:
    by_gap: dict[int, list[Group]] = {}
    room = np.zeros(window + 1, bool)

    def put(group: Group, gap: int) -> None:
        by_gap.setdefault(gap, []).append(group)
        room[gap] = True

    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            gap = length + int(room[length:].argmax())
            group = Group(-(-n // (window // length)), [])
            if room[gap]:
                group = by_gap[gap].pop()
                room[gap] = bool(by_gap[gap])
            else:
                gap = window
            times = min(gap // length, n)
            filled = min(group.copies, n // times)
            if group.copies > filled:
                put(Group(group.copies - filled, group.runs), gap)
            put(Group(filled, [*group.runs, (length, times)]), gap - times * length)
            n -= filled * times
    return [group for groups in by_gap.values() for group in groups if group.runs]


def _slots(groups: list[Group], counts: np.ndarray) -> dict[str, np.ndarray]:
    """Where pieces go that are numbered from 0 by length: each slot says it for the numbers from first on."""
    used = np.concatenate([[0], np.cumsum(counts)])  # the next number of each length
    rows, sequence = [], 0
    for group in groups:
        offset = 0
        for length, times in group.runs:
            rows.append((used[length], sequence, times, offset))
            used[length] += group.copies * times
            offset += length * times
        sequence += group.copies
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("first", "sequence", "times", "offset"), table.T, strict=True))


def pieces(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, window: int, with_ids: bool) -> DataFrame:
    """Encoded documents, end_id after each, cut after every window ids. nth numbers a task's pieces of one length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        known = encoder(tokenizer, keeps_space)
        for batch in gathered(batches, SLICE_BYTES):
            ids, sizes = known.encode(batch["text"])
            ids, sizes = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4"), sizes + 1
            n = -(-sizes // window)
            row = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            length = np.minimum(sizes[row] - piece * window, window)
            order = np.argsort(length, kind="stable")
            ends = np.cumsum(np.bincount(length, minlength=window + 1))
            nth = np.empty(len(row), np.int64)
            nth[order] = np.arange(len(row)) - np.concatenate([[0], ends])[length[order]]
            nth += seen[length]
            seen += np.diff(ends, prepend=0)
            stop = np.cumsum(length)
            body = ids.tobytes()
            columns = {
                "part": pa.array(np.full(len(row), part)),
                "nth": pa.array(nth),
                "doc_id": batch["doc_id"].take(pa.array(row)),
                "piece": pa.array(piece.astype(np.int32)),
                "start": pa.array(piece * window),
                "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(stop - length, stop, strict=True)]),
            }
            if with_ids:
                offsets = np.concatenate([[0], stop]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.record_batch(columns)

    schema = "part long, nth long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema + ", ids array<int>" * with_ids)


def pack(
    docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """Pieces of documents and their places in sequences of at most window tokens, in few sequences.

    doc_id, piece (from 0), start (ids of the document before the piece), length, ids_crc32, sequence_id, offset (place
    in the sequence, without gaps), and ids on request. Each text is encoded whole and followed by end_id; only what is
    longer than window is cut, after every window ids. Null counts as empty, so every row has a piece; repeated rows and
    rows with a null doc_id have their own. Which of the pieces of one length goes where follows the order of the
    input. An empty table gives no pieces. Other columns are not read.

    The driver sees how many pieces there are of each length, and the workers one slot for each length in each
    kind of sequence: both are bounded by the window.
    """
    cut = stored(pieces(docs, tokenizer, keeps_space, end_id, window, with_ids))
    parts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = np.zeros(window + 1, np.int64)
    for row in parts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    slots, of_length = _slots(plan(counts, window), counts), np.concatenate([[0], np.cumsum(counts)])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch["length"].to_numpy()
            number = of_length[length] + batch["before"].to_numpy() + batch["nth"].to_numpy()
            slot = np.searchsorted(slots["first"], number, "right") - 1
            copy, turn = np.divmod(number - slots["first"][slot], slots["times"][slot])
            where = {"sequence_id": slots["sequence"][slot] + copy, "offset": slots["offset"][slot] + turn * length}
            found = {c: batch[c] for c in columns} | {k: pa.array(v) for k, v in where.items()}
            yield pa.record_batch(found)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" * with_ids + ", sequence_id long, offset long"
    return cut.join(before, ["part", "length"]).select(*columns, "before", "nth").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from pieces with ids. A sequence holds at most a window of them."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    return rows.select("sequence_id", F.flatten("pieces.ids").alias("ids"))
