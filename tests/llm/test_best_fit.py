import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from forumlake.llm import best_fit
from forumlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_plan(counts, window):
    groups = best_fit.plan(counts, window)
    placed = np.zeros_like(counts)
    for group in groups:
        assert group.copies > 0 and sum(a * b for a, b in group.runs) <= window
        for length, times in group.runs:
            placed[length] += times * group.copies
    assert placed.tolist() == counts.tolist()
    return sum(g.copies for g in groups)


def first_fit_decreasing(lengths, window):
    rooms = []
    for x in sorted(lengths, reverse=True):
        for i, room in enumerate(rooms):
            if room >= x:
                rooms[i] -= x
                break
        else:
            rooms.append(window - x)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w), max_size=60))))
def test_plan_places_everything_once(case):
    window, lengths = case
    n = check_plan(np.bincount(lengths, minlength=window + 1), window)
    assert -(-sum(lengths) // window) <= n <= first_fit_decreasing(lengths, window) + 1


def test_complements_of_one_two_and_three_pieces():
    lengths = best_fit._Lengths(np.bincount([7, 3, 3, 1, 1, 1], minlength=11))
    assert lengths.complement(7, 3) == (7,) and lengths.complement(4, 1) is None
    assert lengths.complement(4, 2) == (3, 1) and lengths.complement(6, 2) == (3, 3)
    assert lengths.complement(5, 2) is None and lengths.complement(5, 3) == (3, 1, 1)
    assert lengths.triple(3) == (1, 1, 1) and lengths.triple(6) is None
    lengths.change(1, -1)
    assert lengths.triple(3) is None and lengths.pair(2) == (1, 1)


def test_sums_of_pairs_follow_the_counts():
    rng = np.random.default_rng(3)
    lengths = best_fit._Lengths(rng.integers(0, 4, 30) * (np.arange(30) > 0))
    for _ in range(200):
        x = int(rng.integers(1, 30))
        lengths.change(x, int(rng.integers(-lengths.left[x], 3)))
        assert lengths.pairs.tolist() == best_fit._Lengths(lengths.left).pairs.tolist()


def test_perfect_packings_are_found():
    assert check_plan(np.bincount([1500] * 9 + [548] * 9, minlength=2049), 2048) == 9
    assert check_plan(np.bincount([1000] * 5 + [600] * 5 + [448] * 5, minlength=2049), 2048) == 5
    assert check_plan(np.bincount([903] * 4 + [502] * 4 + [402] * 4 + [241] * 4, minlength=2049), 2048) == 4


def expected(texts, end_id, window):
    tokenizer = Tokenizer.from_file(WORDS)
    out = []
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        for k, at in enumerate(range(0, len(ids), window)):
            part = ids[at : at + window]
            out.append((doc, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def check_places(rows, window):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(by_sequence)


@pytest.mark.parametrize("partitions", [1, 7])
def test_provided_documents(spark, partitions):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(partitions)
    rows = best_fit.pack(docs, WORDS, False, 0, 2048).collect()
    wanted = expected([tuple(r) for r in docs.select("doc_id", "text").collect()], 0, 2048)
    assert sorted((tuple(r)[:5] for r in rows), key=str) == wanted
    n, lengths = check_places(rows, 2048), [w[3] for w in wanted]
    assert n <= first_fit_decreasing(lengths, 2048) and n <= 1.02 * sum(lengths) / 2048 + 1
    assert n == check_plan(np.bincount(lengths, minlength=2049), 2048)


def test_registered_query(spark):
    found = QUERIES["op12_best_fit"](spark, SF_DIR)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.selectExpr("sum(length)").first()[0] > 2048 * (found.select("sequence_id").distinct().count() - 2)


def test_edges_and_ids(spark):
    texts = [(1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (4, "word " * 500), (5, "x" * 3000), (6, " \n ")]
    df = spark.createDataFrame([(d, t, 7) for d, t in texts], "doc_id long, text string, length int").repartition(3)
    packed = best_fit.pack(df, WORDS, False, 0, 16, with_ids=True)
    rows = packed.collect()
    assert sorted(((*tuple(r)[:4], r["ids_crc32"]) for r in rows), key=str) == expected(texts, 0, 16)
    check_places(rows, 16)
    whole = {r["sequence_id"]: r["ids"] for r in best_fit.sequences(packed).collect()}
    for r in rows:
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]


def test_one_hot_length(spark):
    df = spark.createDataFrame([(i, "a b c" if i % 3 else "d") for i in range(3000)], "doc_id long, text string").repartition(9)
    rows = best_fit.pack(df, WORDS, False, 0, 10).collect()
    assert len(rows) == 3000 and check_places(rows, 10) == 1000


def test_empty_table(spark):
    assert best_fit.pack(spark.createDataFrame([], "doc_id long, text string"), WORDS, False, 0).collect() == []
