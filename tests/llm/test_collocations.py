import re
from collections import Counter

import numpy as np
import pytest

from forumlake.llm import collocations
from forumlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def expected(docs, least=10, top=2000, percent=50):
    counts, words_of = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        found = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            words_of[lang] += len(words)
            for k in (1, 2, 3):
                found.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        phrases = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in phrases.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= percent * found[q]}
        rows = []
        for p, a in phrases.items():
            if p not in gone:
                cuts = [(10**6 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words_of[lang], -score))
    return sorted(out)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def tiny(monkeypatch):
    """Slices, runs of words and buckets so small that stripes of a phrase meet from many of them."""
    monkeypatch.setattr(collocations, "SLICE_BYTES", 300)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 7)
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 200)


def test_provided_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()]
    assert rows_of(QUERIES["op13_collocations"](spark, SF_DIR)) == expected(docs)


TEXTS = [
    ("en", "New York, new york new york! a b\tc.a b c\nA b c: x"),
    ("en", "the new york the new york the cat the cat"),
    (None, "new york new york"),
    ("und", "new york É É  é"),
    ("de", None),
    ("de", ""),
    ("de", " .,; \t"),
    ("fr", "un deux trois quatre " * 40),
    ("", "a a a a a"),
    ("en", "İ x" + " " * 50 + "y z"),
]


@pytest.mark.parametrize("least, top, percent", [(1, 50, 50), (2, 3, 50), (3, 100, 80), (1, 100, 101)])
def test_small_texts(spark, tiny, least, top, percent):
    docs = TEXTS + TEXTS[:2]
    df = spark.createDataFrame([(x, t, "en") for x, t in docs], "lang string, text string, phrase string").repartition(3)
    assert rows_of(collocations.collocations(df, least, top, percent)) == expected(docs, least, top, percent)


def test_random_words_with_a_hot_first_word(spark, tiny):
    rng = np.random.default_rng(5)
    common = ["the", "of", "a", "big", "one"]
    docs = []
    for k in range(40):
        words = [common[i] if i < 5 else f"w{i}" for i in rng.geometric(0.2, 60)]
        docs.append(("en" if k % 3 else "fr", " ".join("the " + w if i % 4 == 0 else w for i, w in enumerate(words))))
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    assert rows_of(collocations.collocations(df, 2, 400, 60)) == expected(docs, 2, 400, 60)


def test_stripes_merge_alike_with_few_and_many_word_numbers(spark, monkeypatch):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    wanted = rows_of(collocations.collocations(df, 1))
    monkeypatch.setattr(collocations, "_BITS", 21)
    order = np.lexsort
    called = []
    monkeypatch.setattr(np, "lexsort", lambda keys: called.append(1) or order(keys))
    rows = [{"words": b"x y", "first": b"\1\0\2\0", "second": b"\2\0\0\0", "third": b"\0\0\0\0", "n": b"\3\0\1\0"}]
    one = collocations._merged("en", rows, 1, (np.zeros(0, np.uint64),) * 2).to_pylist()
    assert [(r["first"], r["second"], r["f"]) for r in one] == [(None, None, 4), ("x", None, 3), ("y", None, 1), ("x", "y", 3)]
    assert wanted == expected(TEXTS, 1)


def test_scores_beyond_64_bits(spark):
    one = spark.range(1).selectExpr("900000000000000 AS a", "900000000000001 AS l", "999999999999999 AS r")
    a, left, right = 900000000000000, 900000000000001, 999999999999999
    assert one.select(collocations._score("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


def test_hot_words_are_found(spark, tiny):
    df = spark.createDataFrame([("en", "the cat " * 300 + " ".join(f"w{i}" for i in range(300)))], "lang string, text string")
    one, two = collocations._hot(df, 0.1)
    assert len(one) == 2 and len(two) == 2  # "the", "cat"; "the cat", "cat the"


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert rows_of(collocations.collocations(df)) == []
