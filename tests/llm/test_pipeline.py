"""The pipeline, stage by stage, against the operators' brute-force versions."""

import numpy as np
import pyarrow as pa
import pytest
import test_simhash
import test_substrings
import test_tokens

import corpus_pipeline
from forumlake.llm import decontaminate
from forumlake.session import stored


SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows each stage gets, and what the last one returns."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    junk = [(10_001, None, None, "x", None), (10_002, "", "en", None, 0), (10_003, "12 -- !", "fr", "x", 7)]
    docs = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF_DIR)))
    return found


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_all_but_the_last_stage_return_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "repeated_passages", "benchmark_copies", "sequences"
    ]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_language_rejects_texts_without_letters_only(stages):
    before, after = rows(stages[0]), rows(stages[1])
    gone = {d for d, _ in before} - {d for d, _ in after}
    assert {10_001, 10_002, 10_003} <= gone and len(gone) <= 3 + 0.03 * len(before)
    assert set(after) <= set(before)


def test_language_keeps_every_text_with_letters(stages):
    gone = {d for d, _ in rows(stages[0])} - {d for d, _ in rows(stages[1])}
    assert gone == {d for d, t in rows(stages[0]) if not any(c.isalpha() for c in t or "")}


def test_near_duplicates(stages):
    first = {d for d, _, c in test_simhash.brute(rows(stages[1])) if d == c}
    assert rows(stages[2]) == [r for r in rows(stages[1]) if r[0] in first]
    assert len(rows(stages[2])) < len(rows(stages[1]))


def test_repeated_passages(stages):
    texts = dict(rows(stages[2]))
    wanted = [(d, kept if gone else texts[d]) for d, kept, n, gone in test_substrings.brute(rows(stages[2])) if kept or not gone]
    assert rows(stages[3]) == sorted(wanted, key=str)
    assert any(texts[d] != t for d, t in wanted)


def test_benchmark_copies(spark, stages):
    before = rows(stages[3])
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    words, hashes = decontaminate._words(pa.array([t for _, t in before]))
    texts = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    words, hashes = decontaminate._words(pa.array(items))
    items = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    bad = set()
    for item in items:
        score, _ = decontaminate.align([item] * len(texts), texts)
        bad |= {before[k][0] for k in np.flatnonzero(score / (2 * len(item)) >= 0.5)}
    assert bad and rows(stages[4]) == [r for r in before if r[0] not in bad]


def test_sequences(stages):
    pieces = stages[5].collect()
    tokens = {d: len(ids) + 1 for (d, _), ids in zip(rows(stages[4]), test_tokens.direct(test_tokens.WORDS, [t for _, t in rows(stages[4])]), strict=True)}
    lengths = {}
    for p in pieces:
        lengths[p["doc_id"]] = lengths.get(p["doc_id"], 0) + p["length"]
        assert p["doc_tokens"] == tokens[p["doc_id"]]
    assert lengths == tokens


def test_run_gives_the_last_stage(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns[:3] == ["doc_id", "start", "length"] and result.count() > 0
