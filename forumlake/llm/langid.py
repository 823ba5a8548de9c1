"""Language of words and documents by a linear-chain conditional random field, for text that switches languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlake.llm.sampling import per_label
from forumlake.llm.words import Words, gathered, split_words, word_hashes

TABLE_BITS = 18
#: Labelled documents of each language that the model learns from, with their whole texts.
SAMPLE_DOCUMENTS = 120
#: For training, texts are cut into pieces of so many words, and so many pieces of any language make a sequence.
PIECE_WORDS, SEQUENCE_PIECES = 40, 8
EPOCHS, RATE, DECAY = 12, 0.5, 1e-4
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
#: accepted() leaves out documents of so many words whose words are in other languages than the rejected ones with less
#: than this mean probability. Shorter ones give too little evidence.
REJECTED = frozenset({UNKNOWN})
LEAST_SCORE, LEAST_WORDS = 0.25, 8
# Words are ASCII letters and all bytes of other scripts.
_SEPARATOR = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


@dataclass
class Features:
    """Table rows of the features: one n-gram per byte of a word, and five per word (affixes and the word itself)."""

    words: Words
    gram: np.ndarray
    gram_first: np.ndarray
    of_word: np.ndarray


def _bucket(parts: list[np.ndarray], kind: int) -> np.ndarray:
    total = np.full(len(parts[0]), kind * 0x2545F491 & 0xFFFFFFFF, np.uint32)
    for part, multiplier in zip(parts, _MULTIPLIERS, strict=False):
        total = (total ^ part) * multiplier
        total ^= total >> np.uint32(15)
    return total >> np.uint32(32 - TABLE_BITS)


def features(column: pa.Array) -> Features:
    """Letter trigrams with word borders, first and last two and three bytes, and the whole word, in lower case."""
    spaced = pc.binary_join_element_wise(pc.utf8_lower(column.fill_null("")), "", " ")
    words = split_words(spaced, _SEPARATOR)
    data = np.where(_SEPARATOR[words.data], np.uint8(32), words.data).astype(np.uint32)
    data = np.concatenate([[32, 32], data, [32, 32, 32]]).astype(np.uint32)
    start, end = words.start + 2, words.end + 2
    size = end - start
    first = np.cumsum(size) - size
    at = np.repeat(start - first, size) + np.arange(size.sum())
    gram = _bucket([data[at - 1], data[at], data[at + 1]], 1)
    head = [data[start], np.where(size > 1, data[start + 1], 32), np.where(size > 2, data[start + 2], 32)]
    tail = [data[end - 1], data[end - 2], np.where(size > 1, data[end - 3], 32)]
    whole = (word_hashes(words) >> np.uint64(32)).astype(np.uint32)
    per_word = [_bucket(head[:2], 2), _bucket(head, 3), _bucket(tail[:2], 4), _bucket(tail, 5), _bucket([whole], 6)]
    return Features(words, gram, first, np.stack(per_word, axis=1) if len(start) else np.zeros((0, 5), np.uint32))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # table row x label
    transitions: np.ndarray  # from x to

    def scores(self, found: Features) -> np.ndarray:
        """Score of each label for each word on its own."""
        total = self.weights[found.of_word].sum(axis=1, dtype=np.float32)
        if len(total):
            total += np.add.reduceat(self.weights[found.gram], found.gram_first, axis=0)
        return total


def _chain(scores: np.ndarray, transitions: np.ndarray, begins: np.ndarray):
    """Forward and backward vectors of sequences that stand one after the other, both scaled to sum 1.

    The sequences are one chain in which a step into a new sequence forgets the one before. The chain is cut into
    blocks; the matrix product of each block gives the vectors at all block borders, from which
    all blocks are then filled in side by side, one step of every block at a time.
    """
    n, k = scores.shape
    step = np.exp(transitions - transitions.max()).astype(np.float64)
    even = np.full(k, 1.0 / k)
    length = max(1, int(np.sqrt(n)))
    blocks = -(-n // length)
    pad = blocks * length - n
    likely = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    likely = np.concatenate([likely, np.ones((pad, k))]).reshape(blocks, length, k)
    fresh = np.concatenate([begins, np.ones(pad, bool)]).reshape(blocks, length)

    def forward(vector: np.ndarray, t: int) -> np.ndarray:
        """Row vectors (any number for each block) moved one word on."""
        moved = vector @ step
        new = fresh[:, t]
        if new.any():
            moved[new] = vector[new].sum(axis=-1, keepdims=True) * even
        return moved * (likely[:, t] if vector.ndim == 2 else likely[:, t][:, None])

    product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for t in range(length):
        product = forward(product, t)
        product /= product.max(axis=(1, 2), keepdims=True)
    into, out_of = np.empty((blocks, k)), np.empty((blocks, k))
    vector = even
    for b in range(blocks):
        into[b] = vector
        vector = vector @ product[b]
        vector = vector / vector.sum()
    vector = even
    for b in range(blocks - 1, -1, -1):
        out_of[b] = vector
        vector = product[b] @ vector
        vector = vector / vector.sum()
    ahead, behind = np.empty_like(likely), np.empty_like(likely)
    vector = into
    for t in range(length):
        vector = forward(vector, t)
        vector = vector / vector.sum(axis=1, keepdims=True)
        ahead[:, t] = vector
    vector = out_of
    for t in range(length - 1, -1, -1):
        behind[:, t] = vector
        weighed = vector * likely[:, t]
        back = weighed @ step.T
        new = fresh[:, t]
        if new.any():
            back[new] = weighed[new].sum(axis=1, keepdims=True) * even
        vector = back / back.sum(axis=1, keepdims=True)
    return ahead.reshape(-1, k)[:n], behind.reshape(-1, k)[:n], step, likely.reshape(-1, k)[:n]


def posteriors(scores: np.ndarray, transitions: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Probability of each label for each word given its whole sequence (forward-backward)."""
    if not len(scores):
        return np.zeros(scores.shape)
    ahead, behind, _, _ = _chain(scores, transitions, begins)
    both = ahead * behind
    return both / both.sum(axis=1, keepdims=True)


def train(texts: list[str], langs: list[str]) -> Model:
    """Maximum likelihood of the words' labels, by AdaGrad over all features, transitions included.

    Every word of a text has the text's language. Texts are cut into pieces that are dealt in a fixed random order,
    so that sequences switch languages and the transitions are learned from the switches.
    """
    labels = sorted(set(langs))
    k = len(labels)
    weights, transitions = np.zeros((1 << TABLE_BITS, k), np.float32), np.zeros((k, k))
    model = Model(labels, weights, transitions)
    found = features(pa.array(texts, pa.string()))
    words = found.words
    n = len(words.start)
    if not n or k < 2:
        return model
    text = words.text_of()
    gold = np.searchsorted(labels, np.array(langs)[text])
    within = np.arange(n) - words.first[:-1][text]
    piece = np.cumsum((within % PIECE_WORDS) == 0) - 1
    dealt = np.random.default_rng(7).permutation(piece[-1] + 1)
    order = np.argsort(dealt[piece], kind="stable")
    turn = dealt[piece][order]
    begins = np.concatenate([[True], (turn[1:] != turn[:-1]) & (turn[1:] % SEQUENCE_PIECES == 0)])
    inner = ~begins[1:]
    truth = np.eye(k)[gold]
    gram_word = np.repeat(np.arange(n), words.end - words.start)
    squares, step_squares = np.full(weights.shape, 1e-8, np.float32), np.full((k, k), 1e-8)
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[order][:-1][inner], gold[order][1:][inner]), 1)
    # Transitions start from how often labels follow one another; fitting goes on from there.
    transitions += np.log((seen + 1) / (seen + 1).sum(axis=1, keepdims=True))
    for _ in range(EPOCHS):
        ahead, behind, step, likely = _chain(model.scores(found)[order], transitions, begins)
        both = ahead * behind
        chance = np.empty((n, k))
        chance[order] = both / both.sum(axis=1, keepdims=True)
        pull = truth - chance
        for label in range(k):
            gradient = np.bincount(found.gram, pull[gram_word, label], weights.shape[0])
            gradient += np.bincount(found.of_word.ravel(), np.repeat(pull[:, label], 5), weights.shape[0])
            gradient = (gradient / n - DECAY * weights[:, label] / n).astype(np.float32)
            squares[:, label] += gradient**2
            weights[:, label] += RATE * gradient / np.sqrt(squares[:, label])
        after = likely[1:][inner] * behind[1:][inner]
        before = ahead[:-1][inner]
        before /= ((before @ step) * after).sum(axis=1, keepdims=True)
        gradient = (seen - step * (before.T @ after)) / n
        step_squares += gradient**2
        transitions += RATE * gradient / np.sqrt(step_squares)
    return model


def scrambled(texts: list[str]) -> list[str]:
    """The texts' words with their letters in a random (but fixed) order, which is no language."""
    rng = np.random.default_rng(11)
    return [" ".join("".join(rng.permutation(list(w))) for w in text.split() if w.isalpha()) for text in texts]


def learn(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, other: bool = False) -> Model:
    """A model of the languages in docs (doc_id, text, lang), from at most so many documents of each language.

    With `other` the label `und` stands for text in none of them: it is learned from as many of these documents as half
    a language has at most, evenly taken from all, with scrambled words.
    """
    labels = docs.where("lang IS NOT NULL").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    sample, _ = per_label(docs, labels, "lang", sample_documents)
    texts, langs = sample["text"].tolist(), sample["lang"].tolist()
    if other and texts:
        odd = scrambled(texts[:: max(1, -(-2 * len(texts) // sample_documents))])
        texts, langs = texts + odd, langs + [UNKNOWN] * len(odd)
    return train(texts, langs)


def _has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def _label(column: pa.Array, model: Model):
    found = features(column)
    words = found.words
    begins = np.zeros(len(words.start), bool)
    begins[words.first[:-1][words.counts > 0]] = True
    return words, posteriors(model.scores(found), model.transitions, begins)


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """Language of each whole text: doc_id, lang_pred, score, switches.

    A document's language is the label with the largest sum of word probabilities, score is their mean for that label,
    switches counts neighbouring words with different labels. Texts that are null or hold no letter, and all texts if
    the model has no label, are `und` with score 0. Ties go to the first label in order. Only doc_id and text are read;
    repeated rows give repeated rows, an empty table an empty one.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SLICE_BYTES):
            langs, scores, switches = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), [0] * batch.num_rows
            if model.labels:
                words, chance = _label(batch["text"], model)
                best = chance.argmax(axis=1)
                for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                    if a == b or not _has_letter(batch["text"][row].as_py()):
                        continue
                    mean = chance[a:b].mean(axis=0)
                    langs[row], scores[row] = model.labels[int(mean.argmax())], min(1.0, float(mean.max()))
                    switches[row] = int((best[a : b - 1] != best[a + 1 : b]).sum())
            columns = {"doc_id": batch["doc_id"], "lang_pred": pa.array(langs), "score": pa.array(scores)}
            yield pa.record_batch(columns | {"switches": pa.array(switches, pa.int64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, switches long"
    return docs.select("doc_id", "text").mapInArrow(predict, schema)


def word_labels(docs: DataFrame, model: Model) -> DataFrame:
    """Runs of words in one language: doc_id, runs (first word, word after the last, language), in order.

    Words are runs of letters. A text without words, or any text if the model has no label, has no runs.
    """
    runs = pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64(), "lang": pa.string()}))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SLICE_BYTES):
            out = [[] for _ in range(batch.num_rows)]
            if model.labels:
                words, chance = _label(batch["text"], model)
                best = chance.argmax(axis=1)
                for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                    turns = [0, *(np.flatnonzero(np.diff(best[a:b])) + 1).tolist(), int(b - a)]
                    out[row] = [
                        {"start": s, "end": e, "lang": model.labels[best[a + s]]}
                        for s, e in zip(turns[:-1], turns[1:], strict=True)
                        if s < e
                    ]
            yield pa.record_batch({"doc_id": batch["doc_id"], "runs": pa.array(out, runs)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start: bigint, end: bigint, lang: string>>"
    return docs.select("doc_id", "text").mapInArrow(label, schema)


def accepted(
    docs: DataFrame,
    model: Model,
    least_score: float = LEAST_SCORE,
    rejected: frozenset[str] = REJECTED,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The documents, with all their columns, that hold a letter and are not mostly in rejected labels.

    The mean probabilities of all other labels are added up over the text's distinct words, so a text may be spread over
    any number of them, and a word that is repeated over and over counts once; a text of at least least_words distinct
    words goes if the sum is below least_score. A model learned with other=True has the
    label `und` for what is in none of its languages; where a model has no rejected label, that sum is 1 for every
    text. Null and empty texts go; repeated rows are judged alike, and an empty table stays empty.
    """
    known = np.array([label not in rejected for label in model.labels], bool)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SLICE_BYTES):
            good = np.array([_has_letter(t) for t in batch["text"].to_pylist()], bool)
            if not known.all():
                words, chance = _label(batch["text"], model)
                wanted, hashes = chance[:, known].sum(axis=1), word_hashes(words)
                for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                    if b - a >= least_words and good[row]:
                        _, which, n = np.unique(hashes[a:b], return_inverse=True, return_counts=True)
                        if len(n) >= least_words:
                            good[row] = (np.bincount(which, wanted[a:b]) / n).mean() >= least_score
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
