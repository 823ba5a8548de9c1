"""Quality of texts by votes of their nearest labelled neighbours in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlake.llm.sampling import per_label
from forumlake.llm.words import SPACE, Words, gathered, mixed, split_words, word_hashes

TABLE_BITS = 14
DIMENSIONS = 32
NEIGHBOURS = 25
LEAST_SCORE = 0.3
#: Weight of the marks of a text's length and share of distinct words; a term that occurs once has 1.
MARK_WEIGHT = 3.0
#: Votes count by this power of the cosine.
SHARPNESS = 8
#: Labelled documents of each class that are broadcast as vectors; the space is fitted on them too.
SAMPLE_DOCUMENTS = 1000
SLICE_BYTES = 1 << 20
_ROWS_AT_ONCE = 1024
# What a byte looks like: an upper-case letter, a lower-case one (or one of another script), a digit, or itself.
_LOOK = np.array(
    [
        65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b
        for b in range(256)
    ],
    np.uint8,
)


def _looks(words: Words) -> np.ndarray:
    """Hash of each word's shape: what its bytes look like, with runs of equal looks as one."""
    look = _LOOK[words.data]
    kept = np.ones(len(look), bool)
    kept[1:] = look[1:] != look[:-1]
    kept[words.start] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    short = Words(look[kept], words.text_start, place[words.start], place[words.end], words.first)
    return word_hashes(short)


def _named(kind: int, values: np.ndarray) -> np.ndarray:
    """Hashes of numbers that mean something of their own."""
    return mixed(values.astype(np.uint64) + np.uint64((kind + 1) << 40))


def _entries(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, table entry and weight (1 + log of the count) of the terms of some texts.

    Terms are words in lower case, shapes of words, shapes of two neighbouring words, whether a word stood shortly
    before (per distance up to eight), how long the word is, and marks of the text's length and share of distinct words.
    """
    n = len(column)
    words = split_words(column, SPACE)
    lower = split_words(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), SPACE)
    text, shape, exact, spelled = words.text_of(), _looks(words), word_hashes(words), word_hashes(lower)
    size = np.minimum(words.end - words.start, 40).astype(np.uint64)
    found = [(text, shape), (lower.text_of(), spelled), (text, _named(0, size))]
    for back in range(1, min(9, len(text))):
        near = text[back:] == text[:-back]
        again = near & (exact[back:] == exact[:-back])
        found.append((text[back:][again], np.repeat(_named(1, np.array([back])), again.sum())))
        if back == 1:
            found.append((text[1:][near], mixed(shape[1:][near] * np.uint64(3) + shape[:-1][near])))
    row, entry = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    pair, count = np.unique(row << TABLE_BITS | _entries(entry), return_counts=True)
    row, entry, weight = pair >> TABLE_BITS, pair & ((1 << TABLE_BITS) - 1), 1 + np.log(count)
    once = np.unique(lower.text_of() << 40 | (spelled >> np.uint64(24)).astype(np.int64))
    tenths = np.bincount(once >> 40, minlength=n) * 10 // np.maximum(1, lower.counts)
    marks = [_entries(_named(2, np.log2(words.counts + 1).astype(np.int64))), _entries(_named(3, tenths))]
    row = np.concatenate([row, np.arange(n), np.arange(n)])
    return row, np.concatenate([entry, *marks]), np.concatenate([weight, np.full(2 * n, MARK_WEIGHT)])


@dataclass
class Model:
    """The space (inverse document frequencies times singular vectors), the labelled vectors, and their votes."""

    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float

    def embed(self, column: pa.Array) -> np.ndarray:
        """Unit vectors of some texts; zero for a text that has no part in the space."""
        row, entry, weight = terms(column)
        order = np.argsort(row, kind="stable")
        row, entry, weight = row[order], entry[order], weight[order]
        total = np.zeros((len(column), self.space.shape[1]), np.float32)
        if len(row):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            total[row[first]] = np.add.reduceat(self.space[entry] * weight[:, None].astype(np.float32), first, axis=0)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        return np.divide(total, norm, out=np.zeros_like(total), where=norm > 0)

    def scores(self, column: pa.Array) -> np.ndarray:
        """Share of label 1 among the neighbours' votes, each weighted by its cosine."""
        if not len(self.labels):
            return np.full(len(column), self.prior)
        out = np.empty(len(column))
        k = min(NEIGHBOURS, len(self.labels))
        embedded = self.embed(column)
        for at in range(0, len(column), _ROWS_AT_ONCE):
            cosine = embedded[at : at + _ROWS_AT_ONCE] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS * self.votes[near]
            total = weight.sum(axis=1)
            ones = (weight * self.labels[near]).sum(axis=1)
            out[at : at + _ROWS_AT_ONCE] = np.where(total > 0, ones / np.where(total > 0, total, 1), self.prior)
        return np.clip(out, 0, 1)


def train(texts: list[str], labels: list[int], shares: dict[int, float]) -> Model:
    """The space by a randomised singular value decomposition of the sample's weighted terms, and the sample in it.

    shares: the classes' shares of all labelled documents. A class that the sample holds more of votes less.
    """
    y = np.array(labels, np.int64)
    prior = float(shares.get(1, 0.0))
    if not texts:
        return Model(np.zeros((1 << TABLE_BITS, 1), np.float32), np.zeros((0, 1), np.float32), y, np.zeros(0), prior)
    column = pa.array(texts, pa.string())
    row, entry, weight = terms(column)
    table, m = 1 << TABLE_BITS, len(texts)
    frequency = np.bincount(entry, minlength=table)
    idf = np.where(frequency > 0, np.log((1 + m) / (1 + frequency)) + 0.1, 0)
    value = weight * idf[entry]
    norm = np.sqrt(np.bincount(row, value**2, len(texts)))
    value = value / np.where(norm > 0, norm, 1)[row]

    def times(dense: np.ndarray, of: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
        """The sparse matrix, or its transpose, times a dense one."""
        return np.stack([np.bincount(to, value * column[of], n) for column in dense.T], axis=1)

    rank = min(DIMENSIONS, len(texts))
    basis = np.random.default_rng(11).normal(size=(table, rank + 8))
    for _ in range(4):
        left = np.linalg.qr(times(basis, entry, row, len(texts)))[0]
        basis = np.linalg.qr(times(left, row, entry, table))[0]
    singular = np.linalg.svd(times(basis, entry, row, len(texts)), full_matrices=False)[2][:rank]
    basis = basis @ singular.T
    space = (idf[:, None] * basis).astype(np.float32)
    held = {label: max(1, int((y == label).sum())) for label in set(labels)}
    votes = np.array([shares.get(label, 0.0) * m / held[label] for label in labels])
    model = Model(space, np.zeros((0, rank), np.float32), y, votes, prior)
    model.vectors = model.embed(column)
    return model


def learn(docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> Model:
    """A model from the rows of docs (doc_id, text) that labels (doc_id, quality 0 or 1) marks.

    At most so many documents of each class are used, and the model (with their vectors, some hundred kilobytes) is what
    is broadcast. Where label rows of a document differ, the smaller counts; null labels, labels without a document
    and null texts are ignored. Without labelled texts every score is 0.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample, counts = per_label(docs, marks, "quality", sample_documents)
    shares = {label: n / sum(counts.values()) for label, n in counts.items()}
    return train(sample["text"].tolist(), sample["quality"].astype(int).tolist(), shares)


def quality(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from least_score on) of every whole text.

    A document is compared with every labelled vector. Its nearest ones vote with their label, weighted by a power of the
    cosine and by how much rarer their class is in the sample than among all labels. A null or empty text has only
    its marks for length as terms. Only doc_id and text are read; repeated rows give repeated rows, an empty
    table an empty one.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SLICE_BYTES):
            scores = model.scores(batch["text"])
            predicted = pa.array((scores >= least_score).astype(np.int32))
            yield pa.record_batch({"doc_id": batch["doc_id"], "score": pa.array(scores), "predicted": predicted})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double, predicted int")
