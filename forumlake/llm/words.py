"""Words of Arrow text columns as numpy arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The bytes between words: space, and tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

SLICE_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 18


@dataclass
class Words:
    """Words of some texts: byte ranges, the text each belongs to, and where each text's words begin."""

    data: np.ndarray  # bytes of all texts
    text_start: np.ndarray  # byte range of each text, one entry more than texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # index of each text's first word, one entry more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def slices(column: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column that hold about most_bytes each; a longer text is a range of its own."""
    sizes = np.concatenate([[0], np.cumsum(text_bytes(column))])
    at = 0
    while at < len(column):
        end = int(np.searchsorted(sizes, sizes[at] + most_bytes, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end
        at = end


def text_bytes(column: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for null."""
    lengths = pc.binary_length(column.cast(pa.large_binary()))
    return np.asarray(lengths.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its texts; null is an empty text."""
    column = pa.concat_arrays([column.cast(pa.large_string()).fill_null("")])
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(column: pa.Array, separator: np.ndarray = SPACE) -> Words:
    """Words are the longest runs of bytes that are no separators; a word never spans two texts."""
    data, offsets = raw(column)
    inside = ~separator[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # first bytes of texts that aren't empty
    begins[edges] = inside[edges]
    inner = edges[edges > 0] - 1
    ends[inner] = inside[inner]
    start = np.flatnonzero(begins)
    return Words(data, offsets, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


_UP, _DOWN = _powers(_STEP)


def word_hashes(words: Words, data: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes by differences of running sums, then mixed."""
    data = words.data if data is None else data
    out = np.empty(len(words.start), np.uint64)
    at = 0
    while at < len(out):
        low = words.start[at]
        to = max(at + 1, int(np.searchsorted(words.end, low + _STEP - 1, "right")))
        high = words.end[to - 1]
        up, down = (_UP, _DOWN) if high - low < _STEP else _powers(int(high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        start = words.start[at:to] - low
        out[at:to] = (sums[words.end[at:to] - low] - sums[start]) * down[start]
        at = to
    return mixed(out)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data | 32, data)


def windows(words: Words, size: int) -> np.ndarray:
    """Index of the first word of every run of size words that lies in one text."""
    n = np.maximum(words.counts - size + 1, 0)
    before = np.cumsum(n) - n
    return np.repeat(words.first[:-1] - before, n) + np.arange(n.sum())


def gathered(batches: Iterator[pa.RecordBatch], most_bytes: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of about most_bytes of text each: small ones are put together, large ones cut."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at, end in slices(batch[text], most_bytes):
            part = batch.slice(at, end - at)
            n = int(text_bytes(part[text]).sum())
            if waiting and size + n > most_bytes:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting, size = [], 0
            waiting.append(part)
            size += n
    if waiting and sum(b.num_rows for b in waiting):
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def free_name(columns: list[str], wanted: str) -> str:
    """A column name that the table does not have, in any case of its letters."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
