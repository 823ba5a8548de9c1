"""Training sequences of lexically related documents: a sharded BM25 inverted index fills each seed document's window.

Documents are dealt to shards by content: related ones, wherever they stand in the input, are put side by side. Random
projections of the weighted terms say which cluster of a tree (fitted on a bounded sample) a document is in, and within a
cluster documents are ordered by weighted min-hashes of their terms, so that copies and near copies are neighbours.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlake.llm.encoding import encoder
from forumlake.llm.words import gathered
from forumlake.session import stored

WINDOW = 2048
#: A shard of the index ends with the document that brings it to so many documents or tokens.
SHARD_DOCUMENTS, SHARD_TOKENS = 512, 1 << 19
#: Tokens of a task that builds shards.
PART_TOKENS = 1 << 22
#: The tree of clusters: dimensions of the projection, documents it is fitted on (about), levels, fewest documents split.
DIMENSIONS, SAMPLE_DOCUMENTS, LEVELS, LEAST_SPLIT = 12, 8192, 8, 32
MIN_HASHES = 3
#: A term of so many documents of a shard is scored by a matrix product.
COMMON_DOCUMENTS = 64
K1, B = 1.2, 0.75
SLICE_BYTES = 2 << 20
_TOKENS_AT_ONCE = 1 << 18
_ENCODED = "doc_id long, n_tokens long, ids binary"


def encoded(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int) -> DataFrame:
    """doc_id, n_tokens and ids (two or four bytes each) of every document, end_id after each."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer, keeps_space)
        for batch in gathered(batches, SLICE_BYTES):
            ids, sizes = known.encode(batch["text"])
            ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
            parts = np.split(ids, np.cumsum(sizes + 1)[:-1]) if len(sizes) else []
            body = [p.astype("<u2" if p.max() <= 0xFFFF else "<u4").tobytes() for p in parts]
            columns = {"doc_id": batch["doc_id"], "n_tokens": pa.array(sizes + 1), "ids": pa.array(body, pa.binary())}
            yield pa.record_batch(columns)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, _ENCODED)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the documents and all their ids."""
    sizes = batch["n_tokens"].to_numpy()
    bodies = batch["ids"].to_pylist()
    if all(len(x) == 2 * n for x, n in zip(bodies, sizes.tolist(), strict=True)):
        return sizes, np.frombuffer(b"".join(bodies), "<u2").astype("<u4")
    parts = [np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4").astype("<u4") for x, n in zip(bodies, sizes, strict=True)]
    return sizes, np.concatenate(parts)


def _postings(sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term, document and frequency, in order of term and document."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pair = ids.astype(np.int64) * len(sizes) + doc
    if len(pair) and pair.max() < 1 << 32:
        pair = pair.astype(np.uint32)
    pair, n = np.unique(pair, return_counts=True)
    pair = pair.astype(np.int64)
    return pair // len(sizes), pair % len(sizes), n


def _statistics(docs: DataFrame) -> tuple[np.ndarray, int, int]:
    """Documents with each term, and the numbers of documents and tokens, over the whole corpus.

    Terms are token ids, so what reaches the driver is bounded by the vocabulary.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents, tokens = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            sizes, ids = _unpacked(batch)
            own = np.bincount(_postings(sizes, ids)[0])
            if len(own) > len(total):
                own, total = total, own
            total[: len(own)] += own
            documents, tokens = documents + len(sizes), tokens + len(ids)
        terms = np.flatnonzero(total)
        yield pa.record_batch(
            {
                "term": pa.array(np.concatenate([terms, [-1, -2]])),
                "n": pa.array(np.concatenate([total[terms], [documents, tokens]])),
            }
        )

    counts = docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(counts["term"].tolist(), counts["n"].tolist(), strict=True))
    documents, tokens = counts.pop(-1, 0), counts.pop(-2, 0)
    frequency = np.zeros(max(counts, default=-1) + 1, np.int64)
    frequency[list(counts)] = list(counts.values())
    return frequency, documents, tokens


class Places:
    """Where documents go: a vector and min-hashes from their terms, a cluster from the vector, a task from the cluster."""

    def __init__(self, frequency: np.ndarray, documents: int):
        # A term of one document relates it to none.
        weight = np.log1p((documents - frequency + 0.5) / (frequency + 0.5)) * (frequency > 1)
        rng = np.random.default_rng(9)
        self.terms = (weight[:, None] * rng.standard_normal((len(weight), DIMENSIONS))).astype(np.float32)
        clocks = rng.exponential(size=(len(weight), MIN_HASHES)) / np.maximum(weight, 1e-9)[:, None]
        self.clocks = np.where(weight[:, None] > 0, clocks, np.inf).astype(np.float32)
        self.axes = np.zeros((1 << LEVELS, DIMENSIONS), np.float32)
        self.limits = np.full(1 << LEVELS, np.inf, np.float32)
        self.first, self.last = (np.zeros(1 << LEVELS, np.int64) for _ in range(2))

    def of_documents(self, sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors and min-hashes."""
        start = np.cumsum(sizes) - sizes
        vectors = np.zeros((len(sizes), DIMENSIONS), np.float32)
        least = np.full((len(sizes), MIN_HASHES), np.inf, np.float32)
        at = 0
        while at < len(ids):
            to = min(at + _TOKENS_AT_ONCE, len(ids))
            low, high = np.searchsorted(start, at, "right") - 1, np.searchsorted(start, to)
            inside = np.maximum(start[low:high] - at, 0)
            vectors[low:high] += np.add.reduceat(self.terms[ids[at:to]], inside, axis=0)
            least[low:high] = np.minimum(least[low:high], np.minimum.reduceat(self.clocks[ids[at:to]], inside, axis=0))
            at = to
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9), least

    def fit(self, sample: np.ndarray, tokens: np.ndarray, parts: int) -> None:
        """Halve the sample's vectors level by level along their main axis, and give each cluster its share of the tasks.

        Shares are by tokens. A cluster is in one task unless it holds more than one task's share: then it is spread.
        """
        node = np.ones(len(sample), np.int64)
        for level in range(LEVELS):
            for number in range(1 << level, 2 << level):
                own = np.flatnonzero(node == number)
                if len(own) >= LEAST_SPLIT:
                    centred = sample[own] - sample[own].mean(axis=0)
                    self.axes[number] = np.linalg.eigh(centred.T @ centred)[1][:, -1]
                    self.limits[number] = np.median(sample[own] @ self.axes[number])
            node = 2 * node + self._right(sample, node)
        held = np.bincount(node - (1 << LEVELS), tokens, minlength=1 << LEVELS)
        ends = np.cumsum(held) * parts / max(1, tokens.sum())
        begins = np.concatenate([[0.0], ends[:-1]])
        spread = ends - begins > 1
        middle = np.minimum(((begins + ends) / 2).astype(np.int64), parts - 1)
        self.first = np.where(spread, begins.astype(np.int64), middle)
        self.last = np.where(spread, np.minimum(np.ceil(ends).astype(np.int64), parts) - 1, middle)

    def _right(self, vectors: np.ndarray, node: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", vectors, self.axes[node]) > self.limits[node]

    def cluster(self, vectors: np.ndarray) -> np.ndarray:
        node = np.ones(len(vectors), np.int64)
        for _ in range(LEVELS):
            node = 2 * node + self._right(vectors, node)
        return node - (1 << LEVELS)


def placed(docs: DataFrame) -> tuple[DataFrame, np.ndarray, float]:
    """The encoded documents in tasks and in the order in which shards take them; term weights; mean length."""
    frequency, documents, tokens = _statistics(docs)
    idf = np.log1p((documents - frequency + 0.5) / (frequency + 0.5))
    places, parts = Places(frequency, documents), max(1, -(-tokens // PART_TOKENS))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.of_documents(*_unpacked(batch))[0]
            yield pa.record_batch({"vector": pa.array(list(found), pa.list_(pa.float32())), "n_tokens": batch["n_tokens"]})

    share = int(min(1.0, SAMPLE_DOCUMENTS / max(1, documents)) * (1 << 30))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.length("ids")), F.lit(1 << 30)) < share)
    sample = chosen.mapInArrow(vectors, "vector array<float>, n_tokens long").toPandas()
    found = np.stack(sample["vector"]) if len(sample) else np.zeros((0, DIMENSIONS), np.float32)
    places.fit(found, sample["n_tokens"].to_numpy(np.float64), parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            found, least = places.of_documents(*_unpacked(batch))
            cluster = places.cluster(found)
            turn = seen + np.arange(len(cluster))
            seen += len(cluster)
            part = places.first[cluster] + turn % (places.last[cluster] - places.first[cluster] + 1)
            columns = {"part": pa.array(part.astype(np.int32)), "cluster": pa.array(cluster)}
            columns |= {f"least_{k}": pa.array(least[:, k]) for k in range(MIN_HASHES)}
            yield pa.record_batch(columns | {c: batch[c] for c in ("doc_id", "n_tokens", "ids")})

    keys = [f"least_{k}" for k in range(MIN_HASHES)]
    dealt = docs.mapInArrow(deal, f"part int, cluster long, {', '.join(f'{k} float' for k in keys)}, {_ENCODED}")
    ordered = dealt.repartitionById(parts, "part").sortWithinPartitions("cluster", *keys, "doc_id", "n_tokens", "ids")
    return ordered.select("doc_id", "n_tokens", "ids"), idf, tokens / max(1, documents)


class Shard:
    """The inverted index of a shard: postings with BM25 weights that use the corpus' statistics.

    Terms of many of its documents are scored for all seeds by one matrix product, the others by their postings.
    """

    def __init__(self, sizes: np.ndarray, ids: np.ndarray, idf: np.ndarray, mean: float):
        term, doc, n = _postings(sizes, ids)
        norm = K1 * (1 - B + B * sizes / mean)
        weight = idf[term] * n * (K1 + 1) / (n + norm[doc])
        number = np.cumsum(np.diff(term, prepend=-1) != 0) - 1
        common = np.bincount(number) >= COMMON_DOCUMENTS
        often = common[number]
        dense = np.zeros((int(common.sum()), len(sizes)), np.float32)
        dense[(np.cumsum(common) - 1)[number[often]], doc[often]] = weight[often]
        self.base = (dense > 0).astype(np.float32).T @ dense
        self.doc, self.weight, term = doc[~often], weight[~often], number[~often]
        new = np.diff(term, prepend=-1) != 0
        self.first = np.append(np.flatnonzero(new), len(term))
        by_doc = np.argsort(self.doc, kind="stable")
        self.terms = np.split((np.cumsum(new) - 1)[by_doc], np.cumsum(np.bincount(self.doc, minlength=len(sizes)))[:-1])

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the terms of the seed."""
        terms = self.terms[seed]
        low, n = self.first[terms], self.first[terms + 1] - self.first[terms]
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.base[seed] + np.bincount(self.doc[at], self.weight[at], len(self.terms))


def fill(sizes: np.ndarray, scores, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard's documents in full windows.

    A window begins with a seed: the document cut last, or else the first unused one. The unused
    documents follow by falling score for the seed, ties to the first; one that doesn't fit is cut and seeds
    the next window. Only a shard's last window can have room left.
    """
    pieces, left = [], sizes.copy()
    unused = left > 0
    seed, sequence = None, 0
    for doc in range(len(sizes)):
        while unused[doc] or seed is not None:
            at = doc if seed is None else seed
            room, seed, order, k = window, None, None, 0
            lead = at
            while True:
                n = int(min(room, left[at]))
                pieces.append((at, int(sizes[at] - left[at]), n, sequence, window - room))
                left[at] -= n
                room -= n
                unused[at] = left[at] > 0
                if unused[at]:
                    seed = at
                if not room:
                    break
                if order is None:
                    order = np.argsort(-scores(lead), kind="stable")
                while k < len(order) and not unused[order[k]]:
                    k += 1
                if k == len(order):
                    break
                at = int(order[k])
            sequence += 1
    return pieces


def pack(
    docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """Sequences of at most window tokens, as pieces of documents.

    doc_id, start (ids of the document before the piece), length, ids_crc32, doc_tokens, sequence_id, offset (place in
    the sequence, without gaps), and ids on request. Each text is encoded whole and followed by end_id; null
    counts as empty, so every row has at least one piece and repeated rows have their own. Each id lies in exactly
    one piece. Documents are dealt to shards by content; each shard's windows are full but for its last. A
    document of any length is cut into windows, and the rest of it seeds the next one. An empty table gives no pieces.
    Other columns are not read.
    """
    docs, idf, mean = placed(stored(encoded(docs, tokenizer, keeps_space, end_id)))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, tokens = [], 0, 0
        for batch in batches:
            begin, sizes = 0, batch["n_tokens"].to_numpy()
            for row, size in enumerate(sizes.tolist()):
                n, tokens = n + 1, tokens + size
                if n >= SHARD_DOCUMENTS or tokens >= SHARD_TOKENS:
                    yield pa.Table.from_batches([*held, batch.slice(begin, row + 1 - begin)]).combine_chunks().to_batches()[0]
                    held, n, tokens, begin = [], 0, 0, row + 1
            if begin < len(sizes):
                held.append(batch.slice(begin))
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 22
        if encoder.cache_info().currsize:  # the worker has encoded before; room is needed for shards now
            encoder(tokenizer, keeps_space).forget()
        for shard in shards(batches):
            sizes, ids = _unpacked(shard)
            found = np.array(fill(sizes, Shard(sizes, ids, idf, mean).scores, window), np.int64)
            doc, start, length, sequence, offset = found.T
            at = (np.cumsum(sizes) - sizes)[doc] + start
            parts = [ids[a : a + n] for a, n in zip(at, length, strict=True)]
            columns = {
                "doc_id": shard["doc_id"].take(pa.array(doc)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                "doc_tokens": pa.array(sizes[doc]),
                "sequence_id": pa.array((number << 20) + sequence),
                "offset": pa.array(offset),
            }
            if with_ids:
                columns["ids"] = pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))
            yield pa.record_batch(columns)
            number += 1

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.mapInArrow(place, schema + ", ids array<int>" * with_ids)
