import numpy as np
import xxhash

from forumlake.llm import simhash
from forumlake.llm.components import smallest_reachable


def slow_print(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits=4):
    prints = [(i, slow_print(t)) for i, t in rows]
    label = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, f in prints:
            for j, g in prints:
                if (f ^ g).bit_count() <= max_bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return sorted((i, f"{f:016x}", label[i]) for i, f in prints)


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect())


def test_fingerprint_against_definition():
    texts = ["", None, "  \t", "One", "a b c", "Ä é ÜBER Straße and so ON", "x " * 50, "the same word here again"]
    for text in texts:
        assert simhash.fingerprint(text) == slow_print(text)


def test_components_of_links(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(i, i + 1) for i in range(100, 140)]
    label = {n: n for e in links for n in e}
    for _ in range(60):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {n for a, b in links if a != b for n in (a, b)}
    found = smallest_reachable(spark.createDataFrame(links, "a long, b long"), "a", "b")
    assert sorted(map(tuple, found.collect())) == sorted((n, label[n]) for n in linked if label[n] != n)


def test_ball_finds_every_close_pair(spark):
    rng = np.random.default_rng(5)
    prints = [int(x) for x in rng.integers(0, 2**63, 30)]
    for p in list(prints):
        for k in (1, 2, 3, 4, 5):
            prints.append(p ^ sum(1 << int(b) for b in rng.choice(63, k, replace=False)))
    prints = list(dict.fromkeys(prints))
    nodes = spark.createDataFrame(list(enumerate(prints)), "node long, fingerprint long")
    links = [tuple(r) for r in simhash.near_links(nodes, 4).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 * 60 for a, b in links)
    label = list(range(len(prints)))
    found = list(range(len(prints)))
    for _ in prints:
        for a in range(len(prints)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
        for a, b in links:
            found[a] = found[b] = min(found[a], found[b])
        if found == label:
            break
    assert found == label


def test_rounds_and_buckets_do_not_change_links(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    prints = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40)]))
    ids = np.arange(len(prints))
    ball = simhash.Ball(2, 6)

    def forest():
        parts = [simhash._collide(ball, b, prints, ids, 4) for b in range(64)]
        label = ids.copy()
        for _ in range(10):
            for a, b in [(a, b) for p in parts for a, b in p.itertuples(index=False)]:
                label[a] = label[b] = min(label[a], label[b])
        return label.tolist()

    whole = forest()
    monkeypatch.setattr(simhash, "ROUND_VARIANTS", 200)
    assert forest() == whole
    assert len(set(whole)) == 40


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = list(rng.choice(vocabulary, 120))
        rows.append((100 - 2 * i, " ".join(words)))
        words[int(rng.integers(120))] = "edited"
        rows.append((101 - 2 * i, " ".join(words).upper() if i % 3 == 0 else " ".join(words)))
    rows += [(500 + i, rows[4][1]) for i in range(30)] + [(600, None), (601, ""), (602, " \n"), (603, "one two")]
    rows.append((500, rows[4][1]))  # a repeated row
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, root int")
    assert result(simhash.near_duplicates(df)) == brute(rows)
    first = {i for i, _, c in brute(rows) if i == c}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i in first)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.keep_one(df).collect() == []


def test_provided_documents_against_brute_force(spark):
    from forumlake.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert result(QUERIES["op10_simhash"](spark, sf_dir)) == brute(rows)
