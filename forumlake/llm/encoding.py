"""Token ids of whole texts by the tokenizers library, with each distinct stretch of text encoded once per worker.

Texts are cut where the tokenizer starts a new piece in any case, so stretches can be encoded on their own.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from forumlake.llm.words import Words, lowered, raw, word_hashes

#: Stretches a worker remembers. When there are more, those it has met once only are forgotten, if need be all.
MOST_KNOWN = 800_000
_AT_ONCE = 20_000
# Kinds of bytes. No cut is made beside one whose kind is open: it may be a part of any character, or of white space.
_OPEN, _SPACE, _BREAK, _LETTER, _DIGIT, _SIGN, _BEYOND = range(7)
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[ord("'"), *range(0x1C, 0x20)]] = _OPEN
_KIND[0x20] = _SPACE
_KIND[0x09:0x0E] = _BREAK
_KIND[0x30:0x3A] = _DIGIT
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x80:] = _BEYOND
# White space beyond ASCII in UTF-8.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def stretches(column: pa.Array, keeps_space: bool) -> Words:
    """Stretches of texts that are encoded alike wherever they stand.

    A cut is made between ASCII letters, digits and signs (apostrophes aside). keeps_space: white space begins a
    stretch together with what follows, and a single line break or tab stands alone (byte-level pieces with a space
    before a word). Otherwise ASCII white space is left out and A-Z are put in lower case (lower-case word pieces).
    """
    data, offsets = raw(column)
    if not keeps_space:
        data = lowered(data)
    n = len(data)
    kind = _KIND[data]
    for match in _WIDE_SPACE.finditer(data):
        kind[match.start() : match.end()] = _OPEN
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[_OPEN], kind[:-1]]) if n else kind
    plain = (kind >= _LETTER) & (kind <= _SIGN)
    cut = plain & (before >= _LETTER) & (before <= _SIGN) & (kind != before)
    blank = (kind == _SPACE) | (kind == _BREAK)
    if keeps_space:
        cut |= blank & (before >= _LETTER)
        alone = np.zeros(n, bool)  # after a line break that has no white space on either side
        if n > 2:
            alone[2:] = (before[2:] == _BREAK) & (before[1:-1] >= _LETTER) & (kind[2:] >= _LETTER)
            alone[2:] &= ~edge[1 : n - 1]
        start = np.flatnonzero(cut | alone | edge[:n])
        end = np.append(start[1:], n) if n else start
    else:
        gap = np.concatenate([[True], blank[:-1]]) if n else blank
        start = np.flatnonzero(~blank & (cut | gap | edge[:n]))
        stop = np.concatenate([cut[1:] | blank[1:], [True]]) | edge[1:] if n else blank
        end = np.flatnonzero(~blank & stop) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


class Encoder:
    """A tokenizer and the ids of the stretches it has met, by their 64-bit hash."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("only added tokens that are found as they stand are supported")
        self.added = {token.content: number for number, token in added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self.keeps_space = keeps_space
        self._set(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32))

    def _set(self, hashes: np.ndarray, first: np.ndarray, ids: np.ndarray) -> None:
        """Entries by hash in order. Sorted arrays need a tenth of a dictionary's memory."""
        self.hashes, self.first, self.ids = hashes, first, ids
        self.entry = np.arange(len(hashes), dtype=np.int32)
        self.met = np.ones(len(hashes), np.int8)

    def forget(self) -> None:
        again = self.met[self.entry] > 1
        again &= again.sum() <= MOST_KNOWN // 2
        kept = self.entry[again]
        size = np.diff(self.first)[kept]
        begin = np.cumsum(size) - size
        ids = self.ids[np.repeat(self.first[kept] - begin, size) + np.arange(size.sum())]
        self._set(self.hashes[again], np.concatenate([[0], np.cumsum(size)]), ids)

    def _missing(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the hashes stand or belong among the known ones, and which are not there."""
        at = np.searchsorted(self.hashes, hashes)
        there = at < len(self.hashes)
        there[there] = self.hashes[at[there]] == hashes[there]
        return at, np.flatnonzero(~there)

    def _learn(self, hashes: np.ndarray, at: np.ndarray, texts: list[str]) -> None:
        sizes, ids = [], [self.ids]
        for k in range(0, len(texts), _AT_ONCE):
            encoded = self.tokenizer.encode_batch_fast(texts[k : k + _AT_ONCE], add_special_tokens=False)
            found = [e.ids for e in encoded]
            sizes += map(len, found)
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
        before = len(self.hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.entry = np.insert(self.entry, at, np.arange(before, before + len(texts), dtype=np.int32))
        self.met = np.concatenate([self.met, np.zeros(len(texts), np.int8)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.ids = np.concatenate(ids)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of ids of each text; null is an empty text.

        As the library does, added tokens (such as an end of text) are found first, and what stands between them is
        encoded as if it were a text of its own.
        """
        found = [pc.match_substring(column, token).fill_null(False) for token in self.added]
        if not found or not any(pc.any(f).as_py() for f in found):
            return self._encode(column)
        texts, rows, marks = [], [], []
        for row, text in enumerate(column.to_pylist()):
            parts = self.cut.split(text or "")  # texts and tokens in turn
            texts += parts[::2]
            marks += [*(self.added[token] for token in parts[1::2]), -1]
            rows += [row] * (len(parts) // 2 + 1)
        ids, sizes = self._encode(pa.array(texts, pa.large_string()))
        token = np.array(marks, np.int64)
        after = np.flatnonzero(token >= 0)
        ids = np.insert(ids, np.cumsum(sizes)[after], token[after])
        sizes[after] += 1
        of_text = np.zeros(len(column), sizes.dtype)
        np.add.at(of_text, rows, sizes)
        return ids, of_text

    def _encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = stretches(column, self.keeps_space)
        found, seen, which = np.unique(word_hashes(parts), return_index=True, return_inverse=True)
        at, new = self._missing(found)
        if len(self.hashes) + len(new) > MOST_KNOWN:
            self.forget()
            at, new = self._missing(found)
        if len(new):
            body = parts.data.tobytes()
            begin, end = parts.start[seen[new]].tolist(), parts.end[seen[new]].tolist()
            self._learn(found[new], at[new], [body[a:b].decode() for a, b in zip(begin, end, strict=True)])
        place = self.entry[np.searchsorted(self.hashes, found)]
        often = np.bincount(which, minlength=len(place))
        self.met[place] = np.minimum(self.met[place] + np.minimum(often, 2), 2).astype(np.int8)
        row = place[which]
        size = self.first[row + 1] - self.first[row]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.first[row] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(np.concatenate([[0], ends])[parts.first])


@lru_cache(maxsize=4)
def encoder(path: str, keeps_space: bool) -> Encoder:
    """One encoder for each worker process, so what it has learned serves later tasks."""
    return Encoder(path, keeps_space)
