from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from forumlake.llm import langid
from forumlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute(scores, transitions):
    """Word probabilities by adding up all label sequences."""
    n, k = scores.shape
    total = np.zeros((n, k))
    for labels in product(range(k), repeat=n):
        value = sum(scores[i, a] for i, a in enumerate(labels))
        value = np.exp(value + sum(transitions[a, b] for a, b in zip(labels[:-1], labels[1:], strict=True)))
        for i, a in enumerate(labels):
            total[i, a] += value
    return total / total.sum(axis=1, keepdims=True)


def test_forward_backward_against_all_sequences():
    rng = np.random.default_rng(0)
    sizes = [1, 5, 2, 6, 1, 1, 4]
    scores, transitions = rng.normal(0, 3, (sum(sizes), 3)), rng.normal(0, 2, (3, 3))
    first = np.cumsum([0, *sizes[:-1]])
    begins = np.isin(np.arange(sum(sizes)), first)
    wanted = np.concatenate([brute(scores[a : a + n], transitions) for a, n in zip(first, sizes, strict=True)])
    assert np.allclose(langid.posteriors(scores, transitions, begins), wanted)


def test_features_do_not_depend_on_neighbours():
    texts = ["One two", None, "", "éa b", "123 !?", "x" * 50]
    whole = langid.features(pa.array(texts))
    row = 0
    for text in texts:
        alone = langid.features(pa.array([text], pa.string()))
        n = len(alone.words.start)
        assert np.array_equal(whole.of_word[row : row + n], alone.of_word)
        row += n
    assert row == len(whole.of_word)


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(spark.read.parquet(f"{SF_DIR}/documents.parquet"), sample_documents=40)


def test_switches_are_found_word_by_word(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) > 500").orderBy("doc_id")
    texts = {lang: docs.where(f"lang = '{lang}'").first()["text"] for lang in ("en", "fr", "de", "es")}
    pieces = [" ".join([w for w in t.split() if w.isalpha()][:40]) for t in texts.values()]
    df = spark.createDataFrame([(1, " ".join(pieces)), (2, None), (3, "12 3!")], "doc_id long, text string")
    rows = {r["doc_id"]: r["runs"] for r in langid.word_labels(df, model).collect()}
    right = sum(min(r["end"], 40 * (i + 1)) - max(r["start"], 40 * i) for i, lang in enumerate(texts) for r in rows[1]
                if r["lang"] == lang and r["start"] < 40 * (i + 1) and r["end"] > 40 * i)
    assert right >= 140 and rows[2] == rows[3] == []


def test_documents_without_letters_and_long_ones(spark, model):
    rows = [(1, None), (2, ""), (3, "  12 -- § €"), (4, "ж"), (5, "the and of that with " * 60000), (5, "the and of"), (None, "the and of")]
    df = spark.createDataFrame([(d, t, "x", 0.1) for d, t in rows], "doc_id long, text string, lang_pred string, score double")
    found = sorted((tuple(r) for r in langid.languages(df, model).collect()), key=str)
    assert len(found) == len(rows)
    by_id = {d: (lang, score) for d, lang, score, _ in found}
    assert [by_id[d][0] for d in (1, 2, 3)] == ["und"] * 3 and by_id[1][1] == 0.0
    assert by_id[4][0] in model.labels and by_id[5][0] == by_id[None][0] == "en"
    kept = langid.accepted(df, model)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} >= {5, None} and not {1, 2, 3} & {r["doc_id"] for r in kept.collect()}


def test_texts_in_several_languages_and_short_ones_are_accepted(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) > 500").orderBy("doc_id")
    texts = [docs.where(f"lang = '{lang}'").first()["text"] for lang in ("en", "fr", "de", "es")]
    pieces = [" ".join([w for w in t.split() if w.isalpha()][:40]) for t in texts]
    rows = [(1, " ".join(pieces)), (2, " ".join(pieces[:3])), (3, "ж"), (4, "qqzx"), (5, "Ελλάδα και"), (6, "12 3!"), (7, None), (8, "€ §")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in langid.accepted(df, model).orderBy("doc_id").collect()] == [1, 2, 3, 4, 5]
    assert [r["doc_id"] for r in langid.accepted(df, langid.learn(df.selectExpr("*", "string(null) lang"))).orderBy("doc_id").collect()] == [1, 2, 3, 4, 5]
    rejected = langid.accepted(df, model, rejected=frozenset({"fr"})).orderBy("doc_id").collect()
    assert {1, 2} <= {r["doc_id"] for r in rejected}
    only = spark.createDataFrame(list(enumerate(pieces)), "doc_id long, text string")
    assert [r["doc_id"] for r in langid.accepted(only, model, rejected=frozenset({"fr"})).orderBy("doc_id").collect()] == [0, 2, 3]


FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "qzxw kjhq wvxz pqkx zzqj xkcd vbnm qwrt sdfg zxcv hjkl qpwk " * 3,
]


def test_other_languages_and_noise_go_and_labelled_texts_stay(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.learn(docs, other=True)
    assert model.labels == ["de", "en", "es", "fr", "und"]
    kept = {r["doc_id"] for r in langid.accepted(docs, model).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()}
    longer = docs.where("length(text) > 500").orderBy("doc_id")
    texts = [longer.where(f"lang = '{lang}'").first()["text"] for lang in ("de", "en", "es", "fr")]
    clean = [" ".join([w for w in t.split() if w.isalpha()][:40]) for t in texts]
    assert all(len(t) > 100 for t in clean)
    mixed = [" ".join(clean), " ".join(clean[:2]), FOREIGN[0] + " " + " ".join(clean * 2)]
    short = ["ж", "qqzx", "Ελλάδα και", clean[0][:20]]
    rows = list(enumerate(clean + mixed + short)) + [(100 + i, t) for i, t in enumerate(FOREIGN)] + [(200, "12 3!"), (201, None)]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string")
    stay = sorted(r["doc_id"] for r in langid.accepted(df, model).collect())
    assert stay == sorted([*range(len(clean + mixed + short)), 0, 1])
    without = langid.accepted(df, langid.learn(docs))  # a model that knows no other language cannot tell them
    assert {100, 101, 102, 103, 104} <= {r["doc_id"] for r in without.collect()}


def test_scrambled_words_keep_their_letters():
    assert [sorted(w) for w in langid.scrambled(["abc de 12 f"])[0].split()] == [["a", "b", "c"], ["d", "e"], ["f"]]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.learn(empty)
    assert langid.learn(empty, other=True).labels == []
    assert langid.languages(empty, model).collect() == [] and langid.accepted(empty, model).collect() == []
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.languages(df, langid.learn(df)).collect()] == [(1, "und", 0.0, 0)]


def test_held_out_accuracy(spark):
    found = QUERIES["op1_langid"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").select("lang", "lang_pred", "score").collect()
    assert sum(a == b for a, b, _ in rows) / len(rows) > 0.97
    assert all(0 <= s <= 1 for _, _, s in rows)
