import numpy as np
import pytest

from forumlake.llm import ann
from forumlake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, rank int, score double"


def good(v, d):
    return v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, asked, k=10):
    d = max({len(v) for _, v in rows if v}, key=[len(v) for _, v in rows if v].count)
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and good(v, d)]
    out = {}
    for q, v in rows:
        if asked(q):
            away = {}
            for i, u in rows:
                if i != q:
                    away[i] = min(away.get(i, np.inf), float(np.sqrt(((u - v) ** 2).sum())))
            out[q] = sorted((s, i) for i, s in away.items())[:k]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = out.setdefault(r["query_id"], [])
        own.append((r["score"], r["vec_id"]))
        assert r["rank"] == len(own)
    return out


def frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, 0.5) for i, v in rows]
    return spark.createDataFrame(rows, SCHEMA)


def same(found, wanted):
    assert found.keys() == wanted.keys()
    for q in wanted:
        assert [i for _, i in found[q]] == [i for _, i in wanted[q]]
        assert np.allclose([s for s, _ in found[q]], [s for s, _ in wanted[q]], rtol=1e-12)


def test_queries_of_another_dimension_take_no_part(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4 if i % 10 == 0 and i else 8).tolist()) for i in range(100)]
    df = frame(spark, rows)
    found = result(ann.nearest(df.where("vec_id % 10 = 0"), df))
    same(found, {q: near for q, near in brute(rows, lambda i: i % 10 == 0).items()})
    assert found.keys() == {0}


def test_awkward_vectors_and_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 4).tolist()) for i in range(60)]
    rows += [(70, None), (71, []), (72, [0, 0, 0, 0]), (73, [1, None, 0, 0]), (74, [1, np.nan, 0, 0]), (75, [np.inf, 0, 0, 1])]
    rows += [(76, [1, 2, 3]), (None, [1, 1, 1, 1]), (5, rows[5][1]), (6, [9, 9, 9, 9])]
    df = frame(spark, rows)
    found = result(ann.nearest(df.where("vec_id % 10 = 0"), df))
    wanted = {}
    for q, near in brute(rows, lambda i: i % 10 == 0).items():
        wanted[q] = near
    same(found, wanted)


def test_fewer_candidates_than_asked_for_and_empty_tables(spark):
    rows = [(i, [i + 1.0, 2.0]) for i in range(5)]
    df = frame(spark, rows)
    same(result(ann.nearest(df.where("vec_id = 0"), df)), brute(rows, lambda i: i == 0))
    assert ann.nearest(df.limit(0), df).collect() == [] and ann.nearest(df, df.limit(0)).collect() == []
    one = frame(spark, rows[:1])
    assert ann.nearest(one, one).collect() == []


def test_copies_of_one_vector_are_read_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 50)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(i, [1.0] * 8) for i in range(300, 800)]
    df = frame(spark, rows)
    found = result(ann.nearest(df.where("vec_id = 400"), df))
    assert found == {400: [(0.0, i) for i in range(300, 310)]}


def test_lists_are_balanced_and_the_graph_finds_near_centroids():
    rng = np.random.default_rng(7)
    sample = np.concatenate([rng.normal(size=(3000, 16)), rng.normal(size=(1000, 16)) * 0.05 + 3])
    centroids = ann.fit(sample, 64)
    near, away = centroids.search(sample, ann.PLACE_BEAM)
    exact = np.sqrt(((sample[:, None] - centroids.points[None]) ** 2).sum(axis=2))
    assert np.allclose(away, np.take_along_axis(exact, near, 1)) and (np.diff(away, axis=1) >= 0).all()
    assert (near[:, 0] == exact.argmin(axis=1)).mean() > 0.97
    assert np.bincount(near[:, 0], minlength=len(centroids.points)).max() < 6 * len(sample) / 64


def test_recall_does_not_depend_on_the_width_of_the_graph_search(spark, monkeypatch):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(4000, 64))
    points = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    df = frame(spark, rows)
    monkeypatch.setattr(ann, "LIST_VECTORS", 20)
    wanted = {(q, i) for q, near in brute(rows, lambda i: i % 100 == 0).items() for _, i in near}
    hits = {}
    for beam in (16, 1000):
        monkeypatch.setattr(ann, "SEARCH_BEAM", beam)
        found = result(ann.nearest(df.where("vec_id % 100 = 0"), df))
        hits[beam] = len({(q, i) for q, near in found.items() for _, i in near} & wanted) / len(wanted)
    assert hits[16] >= hits[1000] - 0.03


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_of_the_query(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    wanted, found = brute(rows, lambda i: i % 100 == 0), result(QUERIES["op2_vectors"](spark, sf_dir))
    hits = sum(len({i for _, i in wanted[q]} & {i for _, i in found[q]}) for q in wanted)
    assert hits / sum(map(len, wanted.values())) >= 0.9
    for q, near in found.items():
        exact = dict((i, s) for s, i in brute([r for r in rows if r[0] in {q, *(i for _, i in near)}], lambda i, q=q: i == q)[q])
        assert all(np.isclose(s, exact[i], rtol=1e-12) for s, i in near) and len(near) == 10
