"""Phrases of two or three words that occur together more than their parts would, by stripes.

A stripe holds, for one first word, how often each continuation (the next word or the end of the piece, and the one
after it) follows. Stripes of the same word are added elementwise. A merged stripe has the word's count (its total), the
counts of its two-word phrases (subtotals) and three-word phrases (entries), and for each two-word phrase the count of
its commonest extension.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlake.llm.words import Words, gathered, lowered, mixed, raw, split_words, word_hashes
from forumlake.session import stored

LEAST, TOP, SUBSUMED_PERCENT = 10, 2000, 50
SLICE_BYTES = 8 << 20
#: Words of a slice whose stripes are built at once; word numbers and the end of a piece fit in 21 bits.
CHUNK_WORDS = (1 << 21) - 8
#: Text that a bucket of stripes stands for.
BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 48
RANK_SLICES = 256
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_GAPS = _BREAKS.copy()
_GAPS[[0x20, 0x09]] = True
_BITS = 21
_ROW = ["bucket", "lang", "words", "first", "second", "third", "n"]
_ROW_TYPES = "bucket long, lang string, words binary, first binary, second binary, third binary, n binary"
_COUNTS = "lang string, first string, second string, third string, f long, extension long"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, pa.Array, np.ndarray]]:
    """For runs of words: the languages, each first word's language, the distinct words, and a row (first, second, third).

    Words are numbered from 1; 0 stands for the end of a piece. Every word is once the first one of a row.
    """
    lang = pc.dictionary_encode(batch["lang"])
    words = split_words(batch["text"], _GAPS)
    data = lowered(words.data)
    pieces = np.cumsum(_BREAKS[data], dtype=np.int32)
    text = words.text_of()
    follows = np.zeros(len(text) + 2, bool)
    if len(text):
        follows[: len(text) - 1] = (pieces[words.start[1:]] == pieces[words.end[:-1] - 1]) & (text[1:] == text[:-1])
    language = lang.indices.to_numpy(zero_copy_only=False)[text]
    for at in range(0, len(text), CHUNK_WORDS):
        to, seen = min(at + CHUNK_WORDS, len(text)), min(at + CHUNK_WORDS + 2, len(text))
        body = data[words.start[at] : words.end[seen - 1]]
        offsets = np.concatenate([[0], np.cumsum(words.end[at:seen] - words.start[at:seen])])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(body[~_GAPS[body]])]
        coded = pc.dictionary_encode(pa.Array.from_buffers(pa.large_binary(), seen - at, buffers))
        number = np.append(coded.indices.to_numpy().astype(np.int64) + 1, [0, 0])
        n = to - at
        rows = np.zeros((3, n), np.int64)
        rows[0] = number[:n]
        rows[1] = np.where(follows[at:to], number[1 : n + 1], 0)
        rows[2] = np.where(follows[at:to] & follows[at + 1 : to + 1], number[2 : n + 2], 0)
        yield lang.dictionary.to_pylist(), language[at:to], coded.dictionary, rows


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word by its number; the end of a piece has 0."""
    data, offsets = raw(words.cast(pa.large_string()))
    as_words = Words(data, offsets, offsets[:-1], offsets[1:], offsets)
    return np.concatenate([np.zeros(1, np.uint64), word_hashes(as_words)])


def _keys(lang: str, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    return mixed(hashes[first] + np.uint64(xxhash.xxh64_intdigest(lang)))


def _within(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the known ones, which are in order."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _home(lang: str, hashes: np.ndarray, rows: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What deals a row to a bucket: its first word, the first two if that one is hot, all three if these are."""
    key = _keys(lang, hashes, rows[0])
    at = np.flatnonzero(_within(key, hot[0]))
    key[at] = mixed(key[at] * _ODD + hashes[rows[1, at]])
    at = at[_within(key[at], hot[1])]
    key[at] = mixed(key[at] * _ODD + hashes[rows[2, at]])
    return key


def _hot(docs: DataFrame, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first words and of the first two words that begin at least the given share of all rows.

    A slice reports those with half of that share of its own rows, so none is missed, and whatever is returned has
    half of that share of all: there are at most 2 / share of either.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SLICE_BYTES):
            for langs, language, words, rows in _chunks(batch):
                least, hashes = rows.shape[1] * share / 2, _hashes(words)
                kinds, keys, counts = [0], [0], [rows.shape[1]]
                for k, lang in enumerate(langs):
                    own = rows[:, language == k]
                    n = np.bincount(own[0], minlength=len(hashes))
                    often = np.flatnonzero((n > 0) & (n >= least))
                    kinds += [1] * len(often)
                    keys += _keys(lang, hashes, often).view(np.int64).tolist()
                    counts += n[often].tolist()
                    own = own[:, (n >= least)[own[0]]]
                    pair, n = np.unique(own[0] << _BITS | own[1], return_counts=True)
                    pair, n = pair[n >= least], n[n >= least]
                    both = mixed(_keys(lang, hashes, pair >> _BITS) * _ODD + hashes[pair & ((1 << _BITS) - 1)])
                    kinds += [2] * len(pair)
                    keys += both.view(np.int64).tolist()
                    counts += n.tolist()
                yield pa.record_batch({"kind": pa.array(kinds), "key": pa.array(keys), "n": pa.array(counts)})

    found = docs.mapInArrow(find, "kind long, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    found = stored(found)
    total = found.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    rows = found.where((F.col("kind") > 0) & (F.col("n") >= F.lit(total * share / 2))).collect()
    return tuple(np.sort(np.array([r["key"] for r in rows if r["kind"] == k], np.int64).view(np.uint64)) for k in (1, 2))


def _packed(numbers: np.ndarray, most: int) -> bytes:
    return numbers.astype("<u2" if most < 1 << 16 else "<u4").tobytes()


def _unpacked(body: bytes, n: int) -> np.ndarray:
    return np.frombuffer(body, "<u2" if len(body) == 2 * n else "<u4").astype(np.int64)


def _stripes(docs: DataFrame, buckets: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The stripes of each slice; those that go to the same bucket travel as one row with a dictionary of their words."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, SLICE_BYTES):
            for langs, language, words, rows in _chunks(batch):
                hashes = _hashes(words)
                for k, lang in enumerate(langs):
                    own = rows[:, language == k]
                    if not own.size:
                        continue  # a language of the slice without words in this run
                    entry, n = np.unique(own[0] << 2 * _BITS | own[1] << _BITS | own[2], return_counts=True)
                    own = np.stack([entry >> 2 * _BITS, entry >> _BITS & ((1 << _BITS) - 1), entry & ((1 << _BITS) - 1)])
                    home = (_home(lang, hashes, own, hot) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(home, kind="stable")
                    found, first = np.unique(home[order], return_index=True)
                    for bucket, at in zip(found.tolist(), np.split(order, first[1:]), strict=True):
                        part = own[:, at]
                        used = np.unique(part)
                        used = used[used > 0]
                        local = np.searchsorted(used, part) + (part > 0)
                        blob = b" ".join(words.take(pa.array(used - 1)).to_pylist())
                        values = [blob, *(_packed(x, len(used)) for x in local), _packed(n[at], int(n[at].max()))]
                        columns = [pa.array([bucket]), pa.array([lang], pa.string())]
                        columns += [pa.array([v], pa.binary()) for v in values]
                        yield pa.record_batch(columns, _ROW)

    return docs.mapInArrow(build, _ROW_TYPES)


def _merged(lang: str, rows: list[dict], least: int, hot: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """The stripes of one language in one bucket, added up: counts of phrases that are frequent or may be in parts."""
    lists = [r["words"].split(b" ") for r in rows]
    coded = pc.dictionary_encode(pa.array([w for words in lists for w in words], pa.large_binary()))
    before = np.concatenate([[0], np.cumsum([len(words) for words in lists])])
    number = coded.indices.to_numpy().astype(np.int64) + 1
    sizes = [len(r["first"]) // (2 if len(words) < 1 << 16 else 4) for r, words in zip(rows, lists, strict=True)]
    columns = []
    for c in ("first", "second", "third"):
        local = [_unpacked(r[c], n) for r, n in zip(rows, sizes, strict=True)]
        found = [np.where(x > 0, number[b + x - 1], 0) for x, b in zip(local, before, strict=False)]
        columns.append(np.concatenate(found))
    n = np.concatenate([_unpacked(r["n"], size) for r, size in zip(rows, sizes, strict=True)])
    first, second, third = columns
    if len(coded.dictionary) < (1 << _BITS) - 1:
        order = np.argsort(first << 2 * _BITS | second << _BITS | third)
    else:
        order = np.lexsort((third, second, first))
    first, second, third, n = first[order], second[order], third[order], n[order]

    def heads(*keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.append(True, reduce(np.logical_or, (np.diff(k) != 0 for k in keys))))

    at = heads(first, second, third)
    first, second, third, n = first[at], second[at], third[at], np.add.reduceat(n, at)
    hashes = _hashes(coded.dictionary)
    one, two = heads(first), heads(first, second)
    total, subtotal = np.add.reduceat(n, one), np.add.reduceat(n, two)
    extension = np.maximum.reduceat(np.where(third > 0, n, 0), two)
    key = _keys(lang, hashes, first[one])
    keep = (total >= least) | _within(key, hot[0])
    one, total = one[keep], total[keep]
    key = mixed(_keys(lang, hashes, first[two]) * _ODD + hashes[second[two]])
    keep = (second[two] > 0) & ((subtotal >= least) | _within(key, hot[1]))
    two, subtotal, extension = two[keep], subtotal[keep], extension[keep]
    three = np.flatnonzero((third > 0) & (n >= least))
    words = pa.concat_arrays([pa.nulls(1, pa.large_string()), coded.dictionary.cast(pa.large_string())]).cast(pa.string())

    def shown(numbers: np.ndarray, *blanks: int) -> pa.Array:
        return words.take(pa.array(np.concatenate([*(np.zeros(b, np.int64) for b in blanks), numbers])))

    f = np.concatenate([[n.sum()], total, subtotal, n[three]])
    return pa.record_batch(
        {
            "lang": pa.array([lang] * len(f), pa.string()),
            "first": shown(np.concatenate([first[one], first[two], first[three]]), 1),
            "second": shown(np.concatenate([second[two], second[three]]), 1, len(one)),
            "third": shown(third[three], 1, len(one), len(two)),
            "f": pa.array(f),
            "extension": pa.array(np.concatenate([np.zeros(1 + len(one), np.int64), extension, np.zeros(len(three), np.int64)])),
        }
    )


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, first, second, third (null beyond the phrase's words), f, extension of phrases that occur least times.

    extension is the count of the commonest phrase of three words that begins with the two. A row without words has the
    number of all words of the language. Stored.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    hot = _hot(docs, 1 / (4 * buckets))

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, list[dict]] = {}
        for batch in rows:
            for row in batch.to_pylist():
                by_lang.setdefault(row["lang"], []).append(row)
        for lang in sorted(by_lang):
            yield _merged(lang, by_lang.pop(lang), least, hot)

    # One task for each bucket; a hash of the bucket would put several into one.
    dealt = _stripes(docs, buckets, hot).repartitionById(buckets, F.col("bucket").cast("int"))
    found = dealt.mapInArrow(merge, _COUNTS)
    words = ["lang", "first", "second", "third"]
    summed = found.groupBy(*words).agg(F.sum("f").alias("f"), F.max("extension").alias("extension"))
    return stored(summed.where((F.col("f") >= least) | F.col("first").isNull()))


def _score(a: str, l: str, r: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in exact arithmetic for counts below 10^15."""
    count = "decimal(15,0)"
    return F.expr(f"(1000000BD * CAST({a} AS {count}) * CAST({a} AS {count})) div (CAST({l} AS {count}) * CAST({r} AS {count}))")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, subsumed_percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of two or three words.

    A-Z become lower case; texts are split at .,;:!? and line breaks into pieces, and these at spaces and tabs into words. a, l
    and r are the counts within pieces of the phrase and of its first and last part; the cut with the lowest score
    counts, the earlier one of equals. n is the number of the language's words. Phrases occur at least `least` times;
    one goes if a longer such phrase that holds its words has at least subsumed_percent of its count.
    The top phrases by score, count and phrase (by bytes) are returned.

    Null texts are empty and a null lang counts as und. Repeated rows count each time. An empty table, or one without
    words, gives no rows. Other columns are not read. One text, and one bucket of stripes, must fit in a worker's memory.
    """
    counts = phrase_counts(docs, least)
    words = counts.where("first IS NOT NULL AND second IS NULL").select("lang", F.col("first").alias("word"), "f")
    pairs = counts.where("second IS NOT NULL AND third IS NULL")
    triples = counts.where("third IS NOT NULL").withColumnRenamed("f", "a").drop("extension")

    def with_count(rows: DataFrame, one: str, name: str) -> DataFrame:
        return rows.join(words.select("lang", F.col("word").alias(one), F.col("f").alias(name)), ["lang", one])

    def with_pair(rows: DataFrame, one: str, other: str, name: str) -> DataFrame:
        known = pairs.select("lang", F.col("first").alias(one), F.col("second").alias(other), F.col("f").alias(name))
        return rows.join(known, ["lang", one, other])

    before = triples.groupBy("lang", F.col("second").alias("first"), F.col("third").alias("second"))
    held = pairs.join(before.agg(F.max("a").alias("before")), ["lang", "first", "second"], "left")
    longer = F.greatest("extension", F.coalesce("before", F.lit(0)))
    subsumed = (longer >= least) & (longer * 100 >= F.col("f") * subsumed_percent)
    two = held.where(~subsumed).select("lang", "first", "second", F.col("f").alias("a"))
    two = with_count(with_count(two, "first", "l"), "second", "r")
    two = two.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = with_count(with_pair(triples, "second", "third", "r1"), "first", "l1")
    three = with_count(with_pair(three, "first", "second", "l2"), "third", "r2")
    three = three.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    later = F.col("s2") < F.col("s1")
    three = three.select(
        "lang",
        F.concat_ws(" ", "first", "second", "third").alias("phrase"),
        "a",
        F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(later, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    # Best phrases of each slice first, so that a language is never ranked whole.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    sliced = two.unionByName(three).withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES)))
    of_slice = F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))
    best = sliced.withColumn("rank", of_slice).where(F.col("rank") <= top).drop("rank", "slice")
    of_lang = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = best.withColumn("rank", of_lang).where(F.col("rank") <= top)
    totals = counts.where("first IS NULL").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
