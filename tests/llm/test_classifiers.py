import numpy as np
import pyarrow as pa
import pytest

from forumlake.llm import quality, toxicity
from forumlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id long, text string, score double, predicted string", "doc_id long, quality int, toxic int"
AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "!!! ### 12"), (5, "word " * 120_000), (5, "short"), (None, "no id")]


def area(score, truth):
    """Chance that a random positive scores above a random negative."""
    rank = np.argsort(np.argsort(score)) + 1
    n = truth.sum()
    return (rank[truth].sum() - n * (n + 1) / 2) / (n * (~truth).sum())


def held_out(spark, name, label):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", label)
    rows = QUERIES[name](spark, SF_DIR).where("held_out").join(labels, "doc_id").select("score", "predicted", label)
    score, predicted, truth = (np.array(x) for x in zip(*rows.collect(), strict=True))
    assert ((score >= 0) & (score <= 1)).all()
    return score, predicted == 1, truth == 1


def test_toxicity_held_out(spark):
    score, predicted, truth = held_out(spark, "op5_toxicity", "toxic")
    assert area(score, truth) > 0.94 and (predicted == (score >= 0.5)).all()
    assert (predicted & truth).sum() / truth.sum() > 0.8 and (predicted & ~truth).sum() / (~truth).sum() < 0.01


def test_quality_held_out(spark):
    score, predicted, truth = held_out(spark, "op7_quality", "quality")
    assert area(score, truth) > 0.97 and (predicted == (score >= 0.3)).all()
    assert (predicted == truth).mean() > 0.95


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(80)]
    texts = [" ".join(rng.choice(words, 30)) for _ in range(300)]
    toxic = [i % 5 == 0 for i in range(300)]
    return [t + " you nasty" * b for t, b in zip(texts, toxic, strict=True)], np.array(toxic)


def test_unlabelled_examples_do_not_count_as_negative(small):
    texts, toxic = small
    known = [t for t, b in zip(texts, toxic, strict=True) if b][:30]
    model = toxicity.train(known, texts, 0.2)
    assert ((model.scores(pa.array(texts)) >= 0.5) == toxic).all()


def test_risk_without_correction_would_go_below_zero(small):
    """With a prior far too large, the corrected risk still leaves clean texts clean."""
    texts, toxic = small
    known = [t for t, b in zip(texts, toxic, strict=True) if b]
    model = toxicity.train(known, texts, 0.35)
    scores = model.scores(pa.array(texts))
    assert scores[toxic].min() > scores[~toxic].max()


def test_neighbours_against_brute_force(small):
    texts, toxic = small
    model = quality.train(texts[:200], toxic[:200].astype(int).tolist(), {0: 0.8, 1: 0.2})
    column = pa.array(texts[200:] + ["", None], pa.string())
    vectors = model.embed(column)
    wanted = []
    for v in vectors:
        cosine = np.array([float(v @ u) for u in model.vectors])
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** quality.SHARPNESS * model.votes[near]
        wanted.append((weight * model.labels[near]).sum() / weight.sum() if weight.sum() > 0 else 0.2)
    assert np.allclose(model.scores(column), wanted, atol=1e-3)
    alone = np.concatenate([model.embed(column[i : i + 1]) for i in range(len(column))])
    assert np.allclose(vectors, alone, atol=1e-5)


@pytest.mark.parametrize("module, apply", [(toxicity, toxicity.toxicity), (quality, quality.quality)])
def test_awkward_rows_and_empty_tables(spark, small, module, apply):
    texts, toxic = small
    rows = [*AWKWARD, *((100 + i, t) for i, t in enumerate(texts))]
    docs = spark.createDataFrame([(d, t, 9.0, "x") for d, t in rows], DOCS)
    marks = [(100 + i, int(not b), int(b)) for i, b in enumerate(toxic[:200].tolist())]
    marks += [(1, 1, 0), (None, 0, 1), (7777, 0, 1), (101, None, None), (100, 0, 1)]
    labels = spark.createDataFrame(marks, LABELS)
    model = module.learn(docs, labels)
    found = apply(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in found)
    by_text = {r["doc_id"]: r["score"] for r in found}
    assert by_text[1] == by_text[2]
    none = spark.createDataFrame([], DOCS)
    assert apply(none, model).collect() == []
    unlearned = module.learn(none, spark.createDataFrame([], LABELS))
    assert [r["predicted"] for r in apply(docs, unlearned).collect()] == [0] * len(rows)
