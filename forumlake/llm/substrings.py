"""Repeated passages across documents, by suffixes of fixed depth in groups by variable-length prefixes; no tree is built.

A suffix starts at every word that has min_words - 1 words after it in its document, and is cut after min_words
words, so a tree's nodes at that depth are the deep ones and the further extent of a repeat is a run of neighbouring
suffixes. What cannot repeat is left out first: each slice of documents lists the cells its suffixes hash to, cells are
compared by ranges, and only suffixes whose cell a second slice has too go on (others share a cell by chance with
probability 2^-7 at most; none that repeats is lost). A suffix's prefix, three hash bits of each of 13 words in order,
says which group it belongs to. Within a group it is known by 80 hash bits of all its words; equal ones are one node.
Two suffixes that differ, in one word or in all, have equal bits with probability 2^-80.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlake.llm.words import free_name, gathered, mixed, split_words, windows, word_hashes

MIN_WORDS = 13
#: Most suffixes of a group, unless that makes more than MOST_GROUPS groups. Fewer where that leaves
#: too few groups, down to LEAST_SUFFIXES.
GROUP_SUFFIXES = 2 << 20
LEAST_GROUPS, MOST_GROUPS, LEAST_SUFFIXES = 40, 1 << 20, 1 << 14
#: Most documents and bytes of text that are hashed, and put together again, in one step. A longer text is one step.
GROUP_DOCUMENTS = 8000
SLICE_BYTES = 4 << 20
#: Suffixes of a range of cells, and cells for each suffix as a power of two.
RANGE_SUFFIXES, CELL_BITS = 1 << 20, 7
_LEAST_RANGE_BITS = 4
_CODE_BITS = 39
_FIRST_BITS = 15
_MORE_BITS = 8


def _whole(hashes: np.ndarray, at: np.ndarray, min_words: int) -> np.ndarray:
    """64 hash bits of all words of the suffixes that start at the given words."""
    whole = np.zeros(len(at), np.uint64)
    for k in range(min_words):
        whole = whole * np.uint64(0x5851F42D4C957F2D) + hashes[at + k]
    return mixed(whole)


def _suffixes(batch: pa.RecordBatch, min_words: int) -> dict[str, np.ndarray]:
    """The suffixes of some documents in order of their hash bits, equal ones in order of doc_id.

    prefix: what deals a suffix to a group; key, check: 64 and 16 hash bits of all its words; doc: row of the document; lead: whether its document is the smallest of the batch with this suffix.
    """
    words = split_words(batch["text"])
    at = windows(words, min_words)
    doc = np.repeat(np.arange(batch.num_rows), np.maximum(words.counts - min_words + 1, 0))
    hashes = word_hashes(words)
    coded = min(min_words, _CODE_BITS)
    bits = _CODE_BITS // coded
    prefix, other = (np.zeros(len(at), np.uint64) for _ in range(2))
    again = mixed(hashes + np.uint64(0xD1B54A32D192ED03))
    for k in range(min_words):
        if k < coded:
            prefix |= (hashes[at + k] >> np.uint64(64 - bits)) << np.uint64(64 - bits * (k + 1))
        other = other * np.uint64(0x2545F4914F6CDD1D) + again[at + k]
    key, check = _whole(hashes, at, min_words), (mixed(other) >> np.uint64(48)).astype(np.uint16)
    ids = batch["doc_id"].to_numpy(zero_copy_only=False)
    order = np.lexsort((check, key))  # documents stand in order of doc_id
    prefix, key, check, doc = prefix[order], key[order], check[order], doc[order]
    start = at[order] - words.first[doc]
    node, first = _nodes(key, check)
    lead = ids[doc] == ids[doc[first]][node]
    return {"prefix": prefix, "key": key, "check": check, "doc": doc, "start": start, "lead": lead, "ids": ids}


def _nodes(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the node at full depth of each suffix of a sorted subtree, and the first suffix of each node."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches, SLICE_BYTES):
        batch = batch.filter(pc.is_valid(batch["doc_id"]))
        if batch.num_rows:
            yield batch.take(pc.sort_indices(batch["doc_id"]))


def _prefix_counts(docs: DataFrame, min_words: int, bits: int, parents: np.ndarray) -> pd.DataFrame:
    """Suffixes by the first bits of their prefixes, below the given shorter prefixes (all, if bits is the first)."""
    first = bits == _FIRST_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        totals = pd.Series(dtype="int64")
        for batch in _with_ids(batches):
            found = _suffixes(batch, min_words)
            whole = found["prefix"][found["lead"]]
            if not first:
                whole = whole[np.isin(whole >> np.uint64(64 - bits + _MORE_BITS), parents)]
            prefix, n = np.unique(whole >> np.uint64(64 - bits), return_counts=True)
            totals = totals.add(pd.Series(n, index=prefix.astype(np.int64)), fill_value=0)
        yield pa.RecordBatch.from_pydict(
            {"prefix": pa.array(totals.index, pa.int64()), "n": pa.array(totals.to_numpy().astype("int64"))}
        )

    counts = docs.mapInArrow(count, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    return counts.orderBy("prefix").toPandas()


def group_starts(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[np.ndarray, int]:
    """The first prefix of each group of suffixes, and the number of suffixes.

    Prefixes of 15 bits (five words) are counted over all documents. A prefix with more suffixes than a group may
    hold is made longer by eight bits at a time; neighbouring short ones share a group. So the driver sees
    at most 32,768 counts, and 256 for each prefix that is too large, of which there are at most MOST_GROUPS.
    """
    counts = _prefix_counts(docs, min_words, _FIRST_BITS, np.zeros(0, np.uint64))
    total = int(counts["n"].sum())
    most = max(min(GROUP_SUFFIXES, max(total // LEAST_GROUPS, LEAST_SUFFIXES)), total // MOST_GROUPS)
    bits, ranges = _FIRST_BITS, []
    while True:
        heavy = (counts["n"] > most) & (bits < _CODE_BITS)
        shift = np.uint64(64 - bits)
        light = counts[~heavy]
        ranges += list(zip((light["prefix"].to_numpy().astype(np.uint64) << shift).tolist(), light["n"], strict=True))
        if not heavy.any():
            break
        bits = min(bits + _MORE_BITS, _CODE_BITS)
        counts = _prefix_counts(docs, min_words, bits, counts["prefix"][heavy].to_numpy().astype(np.uint64))
    starts, held = [0], 0
    for start, n in sorted(ranges):
        if held and held + n > most:
            starts.append(start)
            held = 0
        held += n
    return np.array(starts, np.uint64), total


def _planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes first: what the numbers have in common compresses well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of all rows of a column of planes, one row after the other."""
    size = np.dtype(kind).itemsize
    parts = [np.frombuffer(b, np.uint8).reshape(size, -1).T for b in column.to_pylist()]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).ravel() if parts else np.zeros(0, kind)


def _pack(keys: np.ndarray, columns: dict[str, np.ndarray], name: str) -> pa.RecordBatch:
    """One row for each key, with the values of each column as planes of bytes."""
    order = np.argsort(keys, kind="stable")
    found, first = np.unique(keys[order], return_index=True)
    out = {name: pa.array(found.astype(np.int64))}
    for column, values in columns.items():
        parts = np.split(values[order], first[1:]) if len(found) else []
        out[column] = pa.array([_planes(p) for p in parts], pa.binary())
    return pa.record_batch(out)


def _marks(rows: np.ndarray, start: np.ndarray, homes: int) -> pa.RecordBatch:
    return _pack(rows % homes, {"rows": rows, "starts": start.astype(np.int32)}, "home")


@dataclass
class Cells:
    """Numbers that suffixes hash to, in ranges; CELL_BITS more bits than it takes to count the suffixes."""

    bits: int
    range_bits: int

    @classmethod
    def of(cls, suffixes: int) -> Cells:
        ranges = max(-(-suffixes // RANGE_SUFFIXES) - 1, 0).bit_length()
        return cls(min(suffixes.bit_length() + CELL_BITS, 62), max(ranges, _LEAST_RANGE_BITS))

    def cells(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranges(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges that some sorted cells are in, and where each begins."""
        return np.unique(cells >> (self.bits - self.range_bits), return_index=True)


def _home_slices(docs: pa.Table) -> Iterator[pa.RecordBatch]:
    """The documents of a home without repeated rows, by doc_id, in slices that are the same whenever they are made."""
    rows, ids = docs["row"].to_numpy(), docs["doc_id"]
    _, first = np.unique(rows, return_index=True)
    docs = docs.take(pa.array(first)).filter(pc.is_valid(ids.take(pa.array(first))))
    docs = docs.take(pc.sort_indices(docs, [("doc_id", "ascending"), ("row", "ascending")]))
    yield from gathered(docs.to_batches(), SLICE_BYTES)


def met_twice(dealt: DataFrame, cells: Cells, min_words: int) -> DataFrame:
    """Which cells of each slice another slice has too: home, slice, rng, flags (a bit for each distinct cell, in order).

    dealt: doc_id, text, row and home. A slice sends each of its cells once, as a step from the one before, so a passage
    that all documents share is one number for each slice.
    """
    listed = pa.schema([("rng", pa.int64()), ("home", pa.int64()), ("slice", pa.int64()), ("steps", pa.binary())])

    def list_cells(home, docs):
        parts = []
        for number, batch in enumerate(_home_slices(docs)):
            words = split_words(batch["text"])
            found = np.unique(cells.cells(_whole(word_hashes(words), windows(words, min_words), min_words)))
            ranges, first = cells.ranges(found)
            steps = np.diff(found, prepend=0)
            steps[first] = found[first] - (ranges << (cells.bits - cells.range_bits))
            packed = [_planes(p) for p in np.split(steps.astype(np.uint32), first[1:])] if len(found) else []
            n = len(ranges)
            columns = [ranges, np.full(n, home[0].as_py()), np.full(n, number)]
            parts.append(pa.record_batch([*(pa.array(c, pa.int64()) for c in columns), pa.array(packed, pa.binary())], schema=listed))
        return pa.Table.from_batches(parts, listed)

    def compare(rows: pa.Table) -> pa.Table:
        steps = [np.frombuffer(s, np.uint8).reshape(4, -1).T for s in rows["steps"].to_pylist()]
        steps = [np.ascontiguousarray(s).view(np.uint32).ravel() for s in steps]
        found = np.concatenate([np.cumsum(s, dtype=np.int64) for s in steps])
        order = np.argsort(found, kind="stable")
        same = np.diff(found[order]) == 0
        twice = np.zeros(len(found), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        flags = [np.packbits(p).tobytes() for p in np.split(twice, np.cumsum([len(s) for s in steps])[:-1])]
        return pa.table({n: rows[n] for n in ("home", "slice", "rng")} | {"flags": pa.array(flags, pa.binary())})

    lists = dealt.groupBy("home").applyInArrow(list_cells, "rng long, home long, slice long, steps binary")
    return lists.groupBy("rng").applyInArrow(compare, "home long, slice long, rng long, flags binary")


def repeat_starts(dealt: DataFrame, homes: int, groups: np.ndarray, cells: Cells, min_words: int = MIN_WORDS) -> DataFrame:
    """Where suffixes start that also start in a document with a smaller doc_id.

    dealt: doc_id long, text, row (a number for the pair of both) and home (row modulo homes). Returns home, rows and
    starts: packed row numbers and word positions. Within a slice only the suffixes of the smallest document are
    sent on, so a passage that a third of all documents share sends one row for each slice to its group.
    """
    per_run = {"ids": np.int64, "rows": np.int64, "counts": np.int32, "base": np.int32}
    per_suffix = {"key": np.uint64, "check": np.uint16, "step": np.uint16}
    names = [*per_run, *per_suffix, "starts"]
    schema = pa.schema([("grp", pa.int64()), *((n, pa.binary()) for n in names)])

    def deal(docs: pa.Table, flags: pa.Table) -> pa.Table:
        twice: dict[int, list[bytes]] = {}
        flags = flags.sort_by([("slice", "ascending"), ("rng", "ascending")])
        for number, bits in zip(flags["slice"].to_pylist(), flags["flags"].to_pylist(), strict=True):
            twice.setdefault(number, []).append(bits)
        parts = [p for n, batch in enumerate(_home_slices(docs)) for p in _dealt(batch, twice.get(n, []))]
        return pa.Table.from_batches(parts, schema)

    def _dealt(batch: pa.RecordBatch, flags: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = _suffixes(batch, min_words)
        row = batch["row"].to_numpy(zero_copy_only=False)
        doc, lead = found["doc"], found["lead"]
        # What is a repeat within the slice is known here; it takes part under a negative number.
        own = _marks(row[doc[~lead]], found["start"][~lead], homes)
        columns = {n: own[n] if n in ("rows", "starts") else pa.nulls(own.num_rows, pa.binary()) for n in names}
        yield pa.record_batch({"grp": pc.subtract(-1, own["home"])} | columns, schema=schema)
        cell, number = np.unique(cells.cells(found["key"]), return_inverse=True)
        ends = np.append(cells.ranges(cell)[1][1:], len(cell))
        met = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(flags, np.diff(ends, prepend=0), strict=True)] if len(cell) else []
        go = lead & np.concatenate(met).astype(bool)[number] if met else lead
        # Within a group by document and position. A run of one document's suffixes has its number and first
        # position once, and each suffix the step from the one before.
        group = np.searchsorted(groups, found["prefix"][go], "right") - 1
        columns = [found["key"][go], found["check"][go], found["start"][go], doc[go], group]
        order = np.lexsort(columns[2:])
        key, check, start, doc, group = (c[order] for c in columns)
        step = np.diff(start, prepend=0)
        new = (np.diff(group, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0) | (step > 0xFFFF)
        first = np.flatnonzero(new)
        step[first] = 0
        counts = np.diff(np.append(first, len(doc))).astype(np.int32)
        head = {"ids": found["ids"][doc[first]], "rows": row[doc[first]], "counts": counts}
        head = _pack(group[first], head | {"base": start[first].astype(np.int32)}, "grp")
        each = _pack(group, {"key": key, "check": check, "step": step.astype(np.uint16)}, "grp")
        columns = {n: head[n] for n in per_run} | {n: each[n] for n in per_suffix}
        columns["starts"] = pa.nulls(each.num_rows, pa.binary())
        yield pa.record_batch({"grp": each["grp"]} | columns, schema=schema)

    def subtree(group, table):
        if group[0].as_py() < 0:
            home = pa.array(np.full(table.num_rows, -1 - group[0].as_py()))
            return pa.table({"home": home, "rows": table["rows"], "starts": table["starts"]})
        columns = per_run | per_suffix
        part = {n: _numbers(table[n], kind) for n, kind in columns.items()}
        order = np.lexsort((part["check"], part["key"]))
        run = np.repeat(np.arange(len(part["counts"]), dtype=np.int32), part["counts"])
        ids = part["ids"][run[order]]
        node, first = _nodes(part["key"][order], part["check"][order])
        least = np.minimum.reduceat(ids, first) if len(first) else ids
        later = order[ids > least[node]]
        moved = np.cumsum(part["step"], dtype=np.int64)
        start = part["base"][run] + moved - moved[np.cumsum(part["counts"]) - part["counts"]][run]
        return pa.Table.from_batches([_marks(part["rows"][run[later]], start[later], homes)])

    flags = met_twice(dealt, cells, min_words)
    sent = dealt.groupBy("home").cogroup(flags.groupBy("home")).applyInArrow(deal, "grp long, " + ", ".join(f"{n} binary" for n in names))
    return sent.groupBy("grp").applyInArrow(subtree, "home long, rows binary, starts binary")


def _kept(text: str | None, starts: np.ndarray, min_words: int) -> tuple[str, int, int, list[dict]]:
    """A text without the words of the windows that start at the given words, how many it had, how many went, and the runs."""
    words = (text or "").encode().split()
    if not len(starts):
        return b" ".join(words).decode(), len(words), 0, []
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + min_words, -1)
    covered = np.cumsum(edge[:-1]) > 0
    turns = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    kept = b" ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c).decode()
    return kept, len(words), int(covered.sum()), [{"start": int(a), "end": int(b)} for a, b in turns.reshape(-1, 2)]


def _apply(docs: DataFrame, min_words: int, build, schema: T.StructType) -> DataFrame:
    """build(rows, starts by row number) over groups of documents together with their marks.

    One shuffle deals whole documents to homes of bounded size; listing cells, sending suffixes and putting documents
    together all start from it.
    """
    wide = {c: free_name(["doc_id", "text", "row", "home"], f"c{k}") for k, c in enumerate(docs.columns)}
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    homes = max(1, -(-size["n"] // GROUP_DOCUMENTS), -(-size["bytes"] // SLICE_BYTES))
    row = F.xxhash64("doc_id", "text")
    narrow = [F.col("doc_id").cast("long").alias("doc_id"), "text", row.alias("row"), F.expr(f"pmod(xxhash64(doc_id, text), {homes})").alias("home")]
    others = [F.col(f"`{c}`").alias(name) for c, name in wide.items() if c != "text"]
    dealt = docs.select(*narrow, *others)
    groups, suffixes = group_starts(docs.select(*narrow[:2]), min_words)
    marks = repeat_starts(dealt, homes, groups, Cells.of(suffixes), min_words)

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, starts = _numbers(right["rows"], np.int64), _numbers(right["starts"], np.int32)
        order = np.argsort(rows, kind="stable")
        found, first = np.unique(rows[order], return_index=True)
        by_row = dict(zip(found.tolist(), np.split(starts[order], first[1:]), strict=False)) if len(found) else {}
        marked = [by_row.get(r, _NONE) for r in left["row"].to_pylist()]
        given = {c: left["text" if c == "text" else name] for c, name in wide.items()}
        return build(pa.table(given), marked)

    return dealt.groupBy("home").cogroup(marks.groupBy("home")).applyInArrow(put_together, schema)


_NONE = np.zeros(0, np.int32)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """What remains of every document: doc_id, kept_text, n_words, n_removed, spans.

    A window is min_words consecutive words (bytes between ASCII white space). A word goes if a window over it also
    starts in a document with a smaller doc_id. Windows are judged on the input. spans holds the removed runs
    of words (start, end), whose windows may come from different documents; kept_text is the other words, joined by a
    space.
    A null, empty or short text has no window. Rows with the same doc_id never remove one another's words; a null
    doc_id takes no part. Other columns are not read, and repeated rows give repeated rows.
    """

    def build(rows: pa.Table, marked: list[np.ndarray]) -> pa.Table:
        out = {"doc_id": rows["doc_id"], "kept_text": [], "n_words": [], "n_removed": [], "spans": []}
        for text, starts in zip(rows["text"].to_pylist(), marked, strict=True):
            found = _kept(text, starts, min_words)
            for name, value in zip(("kept_text", "n_words", "n_removed", "spans"), found, strict=True):
                out[name].append(value)
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string()}
        kinds["spans"] = pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))
        return pa.table({n: pa.chunked_array([pa.array(v, kinds[n])]) if n in kinds else v for n, v in out.items()})

    added = "kept_text string, n_words long, n_removed long, spans array<struct<start: bigint, end: bigint>>"
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(added).fields])
    return _apply(docs.select("doc_id", "text"), min_words, build, schema)


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, with all their columns, whose text is cut as by repeats().

    A text without a repeat stays as it is, byte for byte. A document whose words all go is left out.
    """
    columns = docs.columns

    def build(rows: pa.Table, marked: list[np.ndarray]) -> pa.Table:
        texts, stays = [], []
        for text, starts in zip(rows["text"].to_pylist(), marked, strict=True):
            kept = _kept(text, starts, min_words)[0] if len(starts) else text
            texts.append(kept)
            stays.append(not len(starts) or kept != "")
        column = pa.chunked_array([pa.array(texts, pa.string())])
        return rows.set_column(columns.index("text"), "text", column).filter(pa.array(stays))

    return _apply(docs, min_words, build, docs.schema)
