import hashlib

import numpy as np
import pytest

from forumlake.llm import substrings
from forumlake.llm.queries import QUERIES


def brute(rows, n=13):
    """(doc_id, kept, words, removed) of every row by the definition."""
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - n + 1):
            w = tuple(words[i : i + n])
            if doc is not None:
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - n + 1):
            if doc is not None and first[tuple(words[i : i + n])] < doc:
                gone.update(range(i, i + n))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((doc, kept, len(words), len(gone)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "kept_text", "n_words", "n_removed").collect()), key=str)


@pytest.fixture(scope="module")
def cases():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(500)] + ["é", "ß|", "a"] * 20

    def some(n):
        return list(rng.choice(vocabulary, n))

    shared = [some(k) for k in (12, 13, 14, 40)]
    rows = [(i, " ".join(some(20) + shared[i % 4] + some(5))) for i in range(60)]
    rows += [(200, rows[7][1]), (-5, rows[9][1]), (201, None), (202, ""), (203, " \t\n"), (204, "short text")]
    rows += [(205, " ".join(["again and"] * 40)), (206, " ".join(["again and"] * 30)), (207, rows[3][1] + "\r\n" + rows[4][1])]
    rows += [(208, rows[2][1]), (208, rows[2][1]), (208, " ".join(some(30))), (None, rows[2][1]), (None, None)]
    rows += [(300 + i, " ".join(some(300) + shared[3])) for i in range(10)]
    return rows


@pytest.mark.parametrize("group, slice_bytes", [(1 << 18, 8 << 20), (50, 400)])
def test_repeats_against_brute_force(spark, cases, monkeypatch, group, slice_bytes):
    monkeypatch.setattr(substrings, "GROUP_SUFFIXES", group)
    monkeypatch.setattr(substrings, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(substrings, "GROUP_DOCUMENTS", 7)
    df = spark.createDataFrame(cases, "doc_id long, text string").repartition(5)
    assert result(substrings.repeats(df)) == brute(cases)


@pytest.mark.parametrize("n", [1, 3, 60])
def test_other_window_sizes(spark, cases, n):
    df = spark.createDataFrame(cases, "doc_id long, text string")
    assert result(substrings.repeats(df, n)) == brute(cases, n)


def test_templates_with_one_differing_word_are_no_repeats(spark):
    # Pairs of names whose windows agree in 39 bits of prefix and 25 of the whole.
    pairs = [(188344, 211011), (98124, 142110), (14948, 133453), (12193, 47440), (203048, 297474), (87424, 116209)]
    names = [n for pair in pairs for n in pair]
    words = [f"t{i}" for i in range(13)]
    rows = [(i, " ".join(words[:6] + [f"name{n}"] + words[7:])) for i, n in enumerate(names)]
    for parts in (1, 12):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert result(substrings.repeats(df)) == brute(rows)


def test_spans_are_the_removed_runs(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(1, passage), (2, "x y " + passage + " z")]
    found = {r["doc_id"]: r["spans"] for r in substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: [], 2: [(2, 22)]}


def test_documents_keep_their_columns_and_clean_texts(spark, cases):
    df = spark.createDataFrame([(d, t, "a", 1, None) for d, t in cases], "doc_id long, text string, home string, grp int, n void")
    df = df.withColumn("n", df["n"].cast("int"))
    cut = substrings.without_repeats(df)
    assert cut.columns == df.columns
    by_text = {}
    for doc, text in cases:
        by_text.setdefault(doc, []).append(text)
    wanted = sorted((d, k) for d, k, n, g in brute(cases) if d is not None and g and k)
    texts = sorted((r["doc_id"], r["text"]) for r in cut.collect() if r["doc_id"] is not None and r["text"] not in by_text[r["doc_id"]])
    assert texts == wanted
    emptied = sum(1 for d, k, n, g in brute(cases) if g and not k)
    assert emptied and cut.count() == len(cases) - emptied


def test_cells_lose_no_repeat_and_few_others_go_on(spark, monkeypatch):
    """With hardly any cells, and with ranges of a few, results are the same; without repeats hardly any go on."""
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 400, 60))) for i in range(120)]
    rows += [(1000 + i, rows[i * 7][1]) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(substrings, "SLICE_BYTES", 1500)
    for bits, ranges in ((7, 1 << 20), (7, 40), (-6, 1 << 20)):
        monkeypatch.setattr(substrings, "CELL_BITS", bits)
        monkeypatch.setattr(substrings, "RANGE_SUFFIXES", ranges)
        assert result(substrings.repeats(df)) == brute(rows)
    monkeypatch.undo()
    cells = substrings.Cells.of(120 * 48)
    keys = rng.integers(0, 2**63, 120 * 48).astype(np.uint64) * np.uint64(2)
    assert len(np.unique(cells.cells(keys))) > 0.98 * len(keys)


def test_rows_repeated_and_awkward_column_names(spark):
    text = " ".join(f"p{i}" for i in range(20))
    rows = [(5, text, 1, "a"), (5, text, 1, "a"), (4, text, 2, None), (None, text, 3, "b"), (6, None, 4, "c")]
    df = spark.createDataFrame(rows, "doc_id int, text string, row int, `c.0` string").withColumnRenamed("row", "Row")
    kept = substrings.without_repeats(df)
    assert kept.columns == df.columns and kept.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[2], rows[3], rows[4]], key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.repeats(df).collect() == [] and substrings.without_repeats(df).collect() == []


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    wanted = sorted((d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, k, n, g in brute(rows))
    found = QUERIES["op6_substrings"](spark, sf_dir).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect())) == wanted
