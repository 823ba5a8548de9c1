"""Toxicity of texts by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlake.llm.sampling import per_label
from forumlake.llm.words import gathered, mixed, slices, split_words, word_hashes

TABLE_BITS = 22
#: Confirmed toxic and unlabelled documents that the model learns from, with their whole texts.
SAMPLE_POSITIVE, SAMPLE_UNLABELLED = 2000, 6000
STEPS, RATE, DECAY = 200, 0.2, 1e-3
#: A word or part of one takes part if its share among toxic examples is so many standard errors off that among unlabelled texts.
LEAST_Z = 5.0
LEAST_DOCUMENTS = 5
SLICE_BYTES = 1 << 20
# Words are letters and digits.
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and table entry of every word, and of every run of four and five bytes within a word, in lower case."""
    words = split_words(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), _SEPARATOR)
    size = words.end - words.start
    at = np.repeat(words.start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    left = np.repeat(words.end, size) - at
    text = words.text_of()
    rows, entries = [text], [word_hashes(words)]
    text = np.repeat(text, size)
    for n in (4, 5):
        inside = left >= n
        begin = at[inside]
        total = np.full(len(begin), n, np.uint64)
        for k in range(n):
            total = total * np.uint64(0x100000001B3) + words.data[begin + k]
        rows.append(text[inside])
        entries.append(mixed(total))
    return np.concatenate(rows), (np.concatenate(entries) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Model:
    """Weights of the table entries that take part."""

    entries: np.ndarray
    weights: np.ndarray
    bias: float

    def pairs(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row and position in entries of every entry that occurs in a text, once."""
        place = np.full(1 << TABLE_BITS, -1, np.int32)
        place[self.entries] = np.arange(len(self.entries))
        n = max(1, len(self.entries))
        found = [np.zeros(0, np.int64)]
        for at, end in slices(column, SLICE_BYTES):
            row, entry = _features(column.slice(at, end - at))
            own = place[entry]
            found.append(np.unique((row[own >= 0] + at) * n + own[own >= 0]))
        pair = np.concatenate(found)
        return pair // n, pair % n

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability of being toxic by which words and parts of words occur, however often."""
        row, entry = self.pairs(column)
        total = np.bincount(row, self.weights[entry], len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _telling(column: pa.Array, n: int) -> np.ndarray:
    """Entries whose share among the first n texts, the examples, is far from that among the others."""
    counts = np.zeros((2, 1 << TABLE_BITS), np.int32)
    for at, end in slices(column, SLICE_BYTES):
        row, entry = _features(column.slice(at, end - at))
        pair = np.unique(row << TABLE_BITS | entry)
        kind = ((pair >> TABLE_BITS) + at >= n).astype(np.int64)
        np.add.at(counts, (kind, pair & ((1 << TABLE_BITS) - 1)), 1)
    m = len(column)
    common = np.flatnonzero(counts.sum(axis=0) >= LEAST_DOCUMENTS)
    counts = counts[:, common]
    share = counts.sum(axis=0) / m
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n + 1 / (m - n)))
    return common[counts[0] / n - counts[1] / (m - n) >= LEAST_Z * error]


def train(positive: list[str], unlabelled: list[str], prior: float) -> Model:
    """A linear classifier of occurrence that minimises the non-negative risk of Kiryo et al. (2017).

    The risk is prior * R(positive as positive) + max(0, R(unlabelled as negative) - prior * R(positive as negative)) with
    the logistic loss. Where the part in brackets falls below zero its gradient is turned round, so that the classifier
    does not go on to call known positives negative. Only words and parts of words that mark toxic examples off from
    unlabelled texts take part (LEAST_Z standard errors, LEAST_DOCUMENTS texts), so those that happen to stand in few
    examples do not.
    """
    none = np.zeros(0, np.int64)
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(none, np.zeros(0), float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))))
    column = pa.array([*positive, *unlabelled], pa.string())
    n, m = len(positive), len(column)
    entries = _telling(column, n)
    row, entry = Model(entries, none, 0.0).pairs(column)
    w, bias = np.zeros(len(entries)), float(np.log(prior / (1 - prior)))
    squares, bias_squares = np.full(len(w), 1e-6), 1e-6
    is_positive = np.arange(m) < n
    share = np.where(is_positive, prior / n, 1.0 / (m - n))
    for _ in range(STEPS):
        score = np.clip(np.bincount(row, w[entry], m) + bias, -30, 30)
        chance = 1 / (1 + np.exp(-score))
        as_negative = share * np.logaddexp(0, score)
        turn = 1.0 if as_negative[n:].sum() >= as_negative[:n].sum() else -1.0
        # Of the loss as positive: chance - 1; of the loss as negative: chance.
        pull = np.where(is_positive, share * (chance - 1) - turn * share * chance, turn * share * chance)
        gradient = np.bincount(entry, pull[row], len(w)) + DECAY * w
        squares += gradient**2
        w -= RATE * gradient / np.sqrt(squares)
        bias_squares += pull.sum() ** 2
        bias -= RATE * pull.sum() / np.sqrt(bias_squares)
    return Model(entries, w, bias)


def learn(
    docs: DataFrame, labels: DataFrame, positive: int = SAMPLE_POSITIVE, unlabelled: int = SAMPLE_UNLABELLED
) -> Model:
    """A model from the rows of docs (doc_id, text) that labels (doc_id, toxic) marks 1, and of any rows as unlabelled text.

    The class prior is the share of toxic rows among all labelled ones. At most so many documents of either kind
    are used. A document counts as toxic if any of its label rows says so; labels without a document and null labels
    are ignored. Without a toxic example every text gets the prior as its score.
    """
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic = marks.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"))
    found, counts = per_label(docs, toxic, "toxic", positive)
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    # Unlabelled text is any text, so it holds toxic documents in their usual share.
    every = docs.where("doc_id IS NOT NULL").select("doc_id", F.lit(0).alias("kind")).distinct()
    others, _ = per_label(docs, every, "kind", unlabelled)
    return train(found["text"][found["toxic"] == 1].tolist(), others["text"].tolist(), prior)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of every whole text.

    A null or empty text has the score of a text without words. Only doc_id and text are read; repeated rows give
    repeated rows, an empty table an empty one.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SLICE_BYTES):
            scores = model.scores(batch["text"])
            predicted = pa.array((scores >= 0.5).astype(np.int32))
            yield pa.record_batch({"doc_id": batch["doc_id"], "score": pa.array(scores), "predicted": predicted})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double, predicted int")
