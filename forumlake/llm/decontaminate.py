"""Training passages that copy benchmark items: n-gram seeds find them, Smith-Waterman alignment scores them.

No seed is left out for being frequent: a much copied item's seeds are as frequent as its copies. A passage that only
shares a usual phrase with an item is dropped before the alignment, by the words both hold, which bound its score.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass
from functools import cached_property
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from forumlake.llm.words import Words, gathered, mixed, split_words, windows, word_hashes

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: A copy's alignment has at least this part of the score of the item aligned with itself.
LEAST_SCORE = 0.5
#: Items whose seeds are sent to the executors at a time. More items are taken in blocks.
BLOCK_ITEMS = 20_000
SLICE_BYTES = 4 << 20
_FILTER_BITS = 20
_CELLS = 1 << 21
#: Occurrences of seeds that are looked at in one step.
_HITS = 1 << 15
# Words are letters and digits; all other ASCII separates them.
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _words(column: pa.Array) -> tuple[Words, np.ndarray]:
    words = split_words(pc.utf8_lower(column.cast(pa.large_string())), _SEPARATOR)
    return words, word_hashes(words)


def _grams(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of size words."""
    at = windows(words, size)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = total * np.uint64(0x5851F42D4C957F2D) + hashes[at + k]
    return at, mixed(total + np.uint64(size))


@dataclass
class Seeds:
    """n-grams of a block of items: hash, size, item (row of the block) and position in it, by hash."""

    hash: np.ndarray
    item: np.ndarray
    at: np.ndarray
    sizes: list[int]
    item_words: list[np.ndarray]
    item_ids: list

    def keep(self, wanted: np.ndarray) -> Seeds:
        part = copy(self)
        part.hash, part.item, part.at = self.hash[wanted], self.item[wanted], self.at[wanted]
        return part

    @cached_property
    def held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words of the items; item and word of each pair that occurs, as one ascending number; and how often."""
        size = [len(w) for w in self.item_words]
        known, word = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.item_words]), return_inverse=True)
        pair, times = np.unique(np.repeat(np.arange(len(size)), size) * len(known) + word, return_counts=True)
        return known, pair, times

    def most_matches(self, item: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """How many words each passage (range of hashes) has in common with its item at most, repeats counted."""
        known, pair, times = self.held
        size = end - start
        total, cut = np.zeros(len(item), np.int64), np.cumsum(size) // _CELLS
        for part in np.split(np.arange(len(item)), np.flatnonzero(np.diff(cut)) + 1):
            n = size[part]
            spot = np.repeat(part, n)
            word = hashes[np.repeat(start[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            at = np.minimum(np.searchsorted(known, word), len(known) - 1)
            wanted = item[spot] * len(known) + at
            place = np.minimum(np.searchsorted(pair, wanted), len(pair) - 1)
            shared = (known[at] == word) & (pair[place] == wanted)
            found, often = np.unique(spot[shared] * len(pair) + place[shared], return_counts=True)
            np.add.at(total, found // len(pair), np.minimum(often, times[found % len(pair)]))
        return total

    def hits(self, words: Words, hashes: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
        """Word index in the texts and index of the seed of every occurrence of a seed; None if there are over most."""
        total = 0
        coarse = np.zeros(1 << _FILTER_BITS, bool)
        coarse[self.hash >> np.uint64(64 - _FILTER_BITS)] = True
        found = [np.zeros((2, 0), np.int64)]
        for size in self.sizes:
            at, gram = _grams(words, hashes, size)
            likely = coarse[gram >> np.uint64(64 - _FILTER_BITS)]
            at, gram = at[likely], gram[likely]
            low, high = np.searchsorted(self.hash, gram, "left"), np.searchsorted(self.hash, gram, "right")
            n = high - low
            total += int(n.sum())
            if most is not None and total > most:
                return None
            seed = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found.append(np.stack([np.repeat(at, n), seed]))
        return tuple(np.concatenate(found, axis=1))


def _seeds(items: list, seed_words: int) -> Seeds:
    """All n-grams of the items; an item with fewer words is one seed as a whole, one without words has none."""
    words, hashes = _words(pa.array([text for _, text in items], pa.string()))
    sizes = sorted({min(seed_words, int(n)) for n in words.counts} - {0})
    parts = []
    for size in sizes:
        at, gram = _grams(words, hashes, size)
        item = np.searchsorted(words.first, at, "right") - 1
        own = np.minimum(words.counts[item], seed_words) == size
        parts.append((gram[own], item[own], (at - words.first[item])[own]))
    gram, item, at = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64),) * 3
    order = np.argsort(gram, kind="stable")
    per_item = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    ids = [item_id for item_id, _ in items]
    return Seeds(gram[order], item[order].astype(np.int64), at[order].astype(np.int64), sizes, per_item, ids)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment (Smith-Waterman, gaps cost the same per word) of each pair: score, and where it ends.

    The end is a word index in the passage; of equal scores the first row's first end counts. Pairs of similar
    lengths are computed together, a row of all their matrices at a time.
    """
    score, end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    order = sorted(range(len(items)), key=lambda i: (len(passages[i]), len(items[i])))
    at = 0
    while at < len(order):
        part = [order[at]]
        while at + len(part) < len(order) and len(passages[order[at + len(part)]]) * (len(part) + 1) <= _CELLS // 8:
            part.append(order[at + len(part)])
        at += len(part)
        wide, high = max(len(passages[i]) for i in part), max(len(items[i]) for i in part)
        # Numbers that no word hash equals in the same place: unequal padding on both sides.
        text = np.zeros((len(part), wide), np.uint64)
        item = np.full((len(part), high), np.uint64(1), np.uint64)
        inside = np.zeros((len(part), wide), bool)
        rows = np.zeros(len(part), np.int64)
        for k, i in enumerate(part):
            text[k, : len(passages[i])], inside[k, : len(passages[i])] = passages[i], True
            item[k, : len(items[i])], rows[k] = items[i], len(items[i])
        slope = -GAP * np.arange(wide, dtype=np.int32)
        above = np.zeros((len(part), wide + 1), np.int32)
        best, where = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        for r in range(high):
            step = np.where((text == item[:, r : r + 1]) & inside, MATCH, MISMATCH).astype(np.int32)
            here = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] + GAP), 0)
            here = np.maximum.accumulate(here + slope, axis=1) - slope
            here[r >= rows] = 0
            top = here.argmax(axis=1)
            value = here[np.arange(len(part)), top]
            better = value > best
            best[better], where[better] = value[better], top[better]
            above[:, 1:] = here
        score[part], end[part] = best, where
    return score, end


def _copies(column: pa.Array, seeds: Seeds, least_score: float) -> pd.DataFrame:
    """Row of the text, row of the item, score, and the words (start, end) of the best alignment of each copy."""
    words, hashes = _words(column)
    # Texts, and then items, are halved until a step's hits fit in memory; passages of other pairs change nothing.
    some_items = np.unique(seeds.item)
    one = len(column) < 2 and len(some_items) < 2
    hits = seeds.hits(words, hashes, None if one else _HITS)
    if hits is None and len(column) > 1:
        half = len(column) // 2
        left, right = (_copies(c, seeds, least_score) for c in (column[:half], column[half:]))
        return pd.concat([left, right.assign(doc=right["doc"] + half)], ignore_index=True)
    if hits is None:
        upper = seeds.item >= some_items[len(some_items) // 2]
        found = pd.concat([_copies(column, seeds.keep(p), least_score) for p in (~upper, upper)], ignore_index=True)
        return found.sort_values(["doc", "item"], ignore_index=True)
    word, seed = hits
    doc = np.searchsorted(words.first, word, "right") - 1
    item = seeds.item[seed]
    size = np.array([len(w) for w in seeds.item_words], np.int64)[item]
    # Half the item's length is left for insertions on either side of where the seed puts the item.
    start = np.maximum(word - seeds.at[seed] - size // 2 - 1, words.first[doc])
    end = np.minimum(word - seeds.at[seed] + size + size // 2 + 1, words.first[doc + 1])
    spots = pd.DataFrame({"doc": doc, "item": item, "start": start, "end": end}).drop_duplicates()
    if spots.empty:
        return spots.assign(score=0.0, start_word=0, end_word=0)
    spots = spots.sort_values(["doc", "item", "start"], ignore_index=True)
    reached = spots.groupby(["doc", "item"])["end"].cummax()
    new = (spots["start"] >= reached.shift(fill_value=0)) | (spots[["doc", "item"]].diff() != 0).any(axis=1)
    spots = spots.groupby(new.cumsum()).agg({"doc": "first", "item": "first", "start": "first", "end": "max"})
    ranges = (spots[c].to_numpy(dtype=np.int64) for c in ("item", "start", "end"))
    length = np.array([len(seeds.item_words[i]) for i in spots["item"]], np.int64)
    spots = spots[seeds.most_matches(*ranges, hashes) / np.maximum(1, length) >= least_score]
    items = [seeds.item_words[i] for i in spots["item"]]
    passages = [hashes[a:b] for a, b in zip(spots["start"], spots["end"], strict=True)]
    best, last = align(items, passages)
    spots["score"] = best / np.maximum(1, MATCH * np.array([len(i) for i in items], np.int64))
    spots["last"] = last
    good = (spots["score"] >= least_score).to_numpy() & (best > 0)
    spots = spots[good]
    kept = np.flatnonzero(good)
    backward = [passages[i][: last[i] + 1][::-1] for i in kept]
    _, length = align([items[i][::-1] for i in kept], backward)
    first = words.first[spots["doc"].to_numpy(dtype=np.int64)]
    spots["end_word"] = spots["start"] - first + spots["last"] + 1
    spots["start_word"] = spots["end_word"] - length - 1
    spots = spots.sort_values(["doc", "item", "score", "start_word"], ascending=[True, True, False, True])
    return spots.drop_duplicates(["doc", "item"])


def _blocks(benchmark: DataFrame, seed_words: int) -> Iterator[Seeds]:
    """Seeds of the items, a block at a time, so that what is sent to executors stays bounded."""
    items = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    rows = (tuple(r) for r in items.orderBy("item_id", "text").toLocalIterator())
    for block in batched(rows, BLOCK_ITEMS):
        seeds = _seeds(list(block), seed_words)
        if len(seeds.hash):
            yield seeds


def copies(
    docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS, least_score: float = LEAST_SCORE
) -> DataFrame:
    """Passages of documents that copy a benchmark item, exactly or edited.

    doc_id, item_id, score (alignment score over that of the item with itself, at least least_score), start_word and
    end_word of the best alignment in the document's words (letters and digits in lower case). One row for each
    document row and item. Null or empty texts and items have no words and take no part; an item with fewer words
    than a seed is a seed itself; repeated items count once, repeated rows give repeated rows. Other columns are not
    read; without items, or without documents, the result is empty.
    """
    item_type = benchmark.schema["item_id"].dataType
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("item_id", item_type)]
        + T.StructType.fromDDL("score double, start_word long, end_word long").fields
    )
    arrow_type = to_arrow_type(item_type)
    found = docs.sparkSession.createDataFrame([], schema)
    for seeds in _blocks(benchmark, seed_words):

        def scan(batches: Iterator[pa.RecordBatch], seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches, SLICE_BYTES):
                spots = _copies(batch["text"], seeds, least_score)
                ids = pa.array([seeds.item_ids[i] for i in spots["item"]], arrow_type)
                columns = {"doc_id": batch["doc_id"].take(pa.array(spots["doc"], pa.int64())), "item_id": ids}
                columns |= {c: pa.array(spots[c].to_numpy()) for c in ("score", "start_word", "end_word")}
                if len(spots):
                    yield pa.record_batch(columns)

        found = found.unionByName(docs.select("doc_id", "text").mapInArrow(scan, schema))
    return found


def without_copies(
    docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS, least_score: float = LEAST_SCORE
) -> DataFrame:
    """The documents, with all their columns, in which copies() finds nothing. No shuffle is needed."""
    for seeds in _blocks(benchmark, seed_words):

        def scan(batches: Iterator[pa.RecordBatch], seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches, SLICE_BYTES):
                clean = np.ones(batch.num_rows, bool)
                clean[_copies(batch["text"], seeds, least_score)["doc"].to_numpy(dtype=np.int64)] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
