import re

import numpy as np
import pytest

from forumlake.llm import decontaminate
from forumlake.llm.queries import QUERIES

DOCS, ITEMS = "doc_id long, text string, score string, item_id int", "item_id long, text string, doc_id int"


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def slow_score(item, text):
    best, above = 0, [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, max(row)), row
    return best


def brute(docs, items, least=0.5):
    out = []
    for doc, text in docs:
        for item, question in items:
            a, b = tokens(question), tokens(text)
            if a and b and slow_score(a, b) / (2 * len(a)) >= least:
                out.append((doc, item, round(slow_score(a, b) / (2 * len(a)), 9)))
    return sorted(out)


def found(spark, docs, items):
    left = spark.createDataFrame([(d, t, "x", 7) for d, t in docs], DOCS)
    right = spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS)
    rows = decontaminate.copies(left, right).select("doc_id", "item_id", "score").collect()
    return sorted((d, i, round(s, 9)) for d, i, s in rows)


@pytest.fixture(scope="module")
def cases():
    rng = np.random.default_rng(2)
    rare, common = [f"wörd{i}" for i in range(4000)], ["the", "of", "and", "a", "to"]

    def some(n):
        return [str(rng.choice(common if rng.random() < 0.4 else rare)) for _ in range(n)]

    items = [(i, some(int(rng.integers(15, 50)))) for i in range(12)]
    docs = []
    for d in range(150):
        words = some(int(rng.integers(0, 200)))
        if d % 3 == 0:
            copy = list(items[d % 7][1])
            for _ in range(len(copy) // 8 if d % 2 else 0):
                k = int(rng.integers(len(copy)))
                copy[k : k + 1] = [["changed"], [], ["one", "more"]][int(rng.integers(3))]
            words[len(words) // 2 : len(words) // 2] = copy
        if d % 5 == 0:
            words += items[d % 12][1][:6]  # a short quote is no copy
        docs.append((d, " ".join(words).capitalize().replace(" ", ", ", 3)))
    docs += [(900, " ".join(items[3][1] * 40)), (901, None), (902, ""), (903, "..."), (0, docs[0][1])]
    items = [(i, " ".join(w)) for i, w in items] + [(50, None), (51, ""), (52, "Solo!"), (53, "two words"), (3, " ".join(items[3][1]))]
    return docs, items


def test_copies_against_brute_force(spark, cases):
    docs, items = cases
    assert found(spark, docs, items) == brute(docs, sorted(set((i, t) for i, t in items), key=str))


def test_blocks_and_slices_change_nothing(spark, cases, monkeypatch):
    docs, items = cases
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 500)
    monkeypatch.setattr(decontaminate, "_CELLS", 3000)
    assert found(spark, docs, items) == brute(docs, sorted(set((i, t) for i, t in items), key=str))


def test_alignment_against_definition():
    rng = np.random.default_rng(9)
    items = [rng.integers(2, 8, int(n)).astype(np.uint64) for n in rng.integers(1, 20, 60)]
    texts = [rng.integers(2, 8, int(n)).astype(np.uint64) for n in rng.integers(1, 60, 60)]
    score, _ = decontaminate.align(items, texts)
    assert score.tolist() == [slow_score(a.tolist(), b.tolist()) for a, b in zip(items, texts, strict=True)]


def test_span_of_a_copy(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = spark.createDataFrame([(1, f"x y z {item} and more"), (2, "nothing of it")], "doc_id long, text string")
    rows = decontaminate.copies(docs, spark.createDataFrame([(5, item)], "item_id int, text string")).collect()
    assert [tuple(r) for r in rows] == [(1, 5, 1.0, 3, 11)]


def test_clean_documents_stay_with_all_columns(spark, cases):
    docs, items = cases
    left = spark.createDataFrame([(d, t, "x", 7) for d, t in docs], DOCS)
    right = spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS)
    kept = decontaminate.without_copies(left, right)
    bad = {d for d, _, _ in brute(docs, items)}
    assert kept.columns == left.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in left.collect() if r["doc_id"] not in bad)


@pytest.mark.parametrize("hits", [1 << 15, 200])
def test_edited_and_cut_copies_in_many_documents(spark, monkeypatch, hits):
    monkeypatch.setattr(decontaminate, "_HITS", hits)
    item, other = [f"q{i}" for i in range(40)], [f"p{i}" for i in range(40)]
    edited = [f"new{i}" if i % 8 == 3 else w for i, w in enumerate(item)]
    docs = [(k, f"text {k} " + " ".join(edited)) for k in range(1000)]
    docs += [(1000 + k, " ".join(other[:24]) + f" and {k}") for k in range(300)]
    docs += [(2000 + k, " ".join(other[-24:])) for k in range(2)] + [(3000, " ".join(item[:6]) + " and no more")]
    rows = [(i, f"q0 q1 q2 other{i} words{i} follow{i} here{i}", 3) for i in range(2, 30)]
    rows += [(0, " ".join(item), 3), (1, " ".join(other), 3)]
    left = spark.createDataFrame([(d, t, "x", 7) for d, t in docs], DOCS)
    right = spark.createDataFrame(rows, ITEMS)
    found = decontaminate.copies(left, right).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found)) == [(d, int(d >= 1000)) for d, _ in docs if d < 3000]
    assert [r["doc_id"] for r in decontaminate.without_copies(left, right).collect()] == [3000]


def test_empty_tables(spark, cases):
    docs, items = cases
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("length(text) < 2500").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op4_decontaminate"](spark, sf_dir).collect()
    short = {d for d, _ in docs}
    assert sorted((r[0], r[1], round(r[2], 9)) for r in rows if r[0] in short) == brute(docs, items)
