import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.functions import spark_partition_id
from tokenizers import Tokenizer

from forumlake.llm import encoding, packing, token_files
from forumlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "two  spaces", "tab\tand space \t x", "line\n next", "line \nnext", "it's we'll  I'm",
    "é  ü x  y", "x\u0085 y", "num 12 345 a1b2", "!!! ... ?!", "<|endoftext|> x<|endoftext|>y", "\x1c \x1d z",
    "ﬁ Å é ́x ΑΣ ΑΣ. Straße", "日本語 テキスト", "emoji 😀 👩‍👧 end", "﻿bom ​ zero", "a b c " * 300,
    "x<|endoftext|>y", "<|endoftext|>", "<|endoftext|><|endoftext|>", "<|startoftext|>a b<|endoftext|>", "x <|endoftext|",
    "<|<|endoftext|>|>", "<|ENDOFTEXT|>", "a \n<|endoftext|>  b\n\n<|startoftext|> \n", "it<|endoftext|>'s é<|endoftext|>é",
    "ΑΣ.a", "a'b c's! !'s 'S x''s", "a,'b", "x\n\ny", "x\ny", "x \ny", "\n", "\na", "a\n", "é\né", "é é  é\té", ",\n,",
    "1\n2 3", "a\xa0 b", "a \xa0b", "“q” – x", "I'LL don't WE'RE", "\t\tx", "a\r\nb", "é, è.", "x\x1cy \x1d",
]


def direct(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("path, keeps_space", [(BYTES, True), (WORDS, False)])
def test_stretches_give_the_ids_of_whole_texts(documents, monkeypatch, path, keeps_space):
    texts = TEXTS + [t for _, t in documents[:25]]
    wanted = direct(path, texts)
    for most in (10**6, 300):
        monkeypatch.setattr(encoding, "MOST_KNOWN", most)
        known = encoding.Encoder(path, keeps_space)
        for part in (slice(None), slice(None, None, -1), slice(10, 30), slice(0, 3), slice(0, 0)):
            ids, sizes = known.encode(pa.array(texts[part], pa.string()))
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes))[:-1]] == wanted[part]
    assert known.encode(pa.array([None], pa.string()))[1].tolist() == [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected_files(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*direct(BYTES, [text or ""])[0], 0]
        out.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    return sorted(out, key=str)


def test_files_round_trip(spark, tmp_path):
    rows = [(len(TEXTS) - i, t) for i, t in enumerate(TEXTS)] + [(90, None), (3, "again"), (3, "again"), (None, "no id")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, shard int").repartition(3)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df, path, BYTES, True, 0)
    read = token_files.read_tokens(spark, path)
    found = token_files.checksums(read).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found), key=str) == expected_files(rows)
    assert read.where("doc_id = 90").select("ids").first()[0] == [0]
    files = spark.read.parquet(path).select("shard", "doc_id").collect()
    by_shard = sorted((r["shard"], -1 if r["doc_id"] is None else r["doc_id"]) for r in files)
    assert [d for _, d in by_shard] == sorted(d for _, d in by_shard)


def test_encodings_and_page_index(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "tokens")
    token_files.write_tokens(spark.read.parquet(f"{SF_DIR}/documents.parquet"), path, BYTES, True, 0)
    group = pq.ParquetFile(next((tmp_path / "tokens").glob("*.parquet"))).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings and "DELTA_BINARY_PACKED" in columns["start_in_shard"].encodings
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    plan = token_files.read_tokens(spark, path, ("n_tokens",)).where("doc_id = 7")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(df, str(tmp_path / "none"), BYTES, True, 0)
    assert token_files.checksums(token_files.read_tokens(spark, str(tmp_path / "none"))).collect() == []
    assert packing.pack(df, WORDS, False, 1).collect() == []


def test_op3_against_direct_encoding(spark, documents):
    found = QUERIES["op3_tokens"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect()), key=str) == expected_files(documents)


def check_pieces(pieces, rows, window=2048):
    """Every id in one piece, in order; sequences without gaps and not too long. Returns the padding."""
    whole = sorted([*direct(WORDS, [t or ""])[0], 1] for _, t in rows)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1]]
        assert 0 < sum(p["length"] for p in own) <= window
    open_docs, texts = {}, []
    for p in sorted(pieces, key=lambda p: (str(p["doc_id"]), p["start"], p["sequence_id"], p["offset"])):
        assert p["ids_crc32"] == crc(p["ids"]) and p["length"] == len(p["ids"]) > 0
        open_docs.setdefault((str(p["doc_id"]), p["doc_tokens"], p["start"]), []).append(p["ids"])
    for (doc, total, start), firsts in list(open_docs.items()):
        if start == 0:
            for ids in firsts:
                ids = list(ids)
                while len(ids) < total:
                    ids += open_docs[(doc, total, len(ids))].pop()
                texts.append(ids)
    assert sorted(texts) == whole
    tokens = sum(p["length"] for p in pieces)
    return sum(window for _ in by_sequence) - tokens


def test_pieces_of_awkward_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 7)
    rows = list(enumerate(TEXTS)) + [(90, None), (91, "many words " * 4000), (92, ""), (92, ""), (None, "no id")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, shard int")
    check_pieces(packing.pack(df, WORDS, False, 1, with_ids=True).collect(), rows)


def test_neighbours_share_a_window(spark):
    topics = [" ".join(f"{t}{i}" for i in range(40)) for t in ("alpha", "beta", "gamma", "delta")]
    rows = [(i, f"{topics[i % 4]} doc") for i in range(16)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    size = len(direct(WORDS, [rows[0][1]])[0]) + 1
    pieces = packing.pack(df, WORDS, False, 1, window=4 * size + 8, with_ids=True).collect()
    first = {p["doc_id"] % 4 for p in pieces if p["sequence_id"] == 0 and p["length"] > 10}
    assert len(first) == 1  # all documents of one topic, whichever comes first


def test_bm25_against_definition():
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 40, 12)
    ids = rng.integers(0, 30, sizes.sum()).astype("<u4")
    idf = rng.random(30)
    shard = packing.Shard(sizes, ids, idf, float(sizes.mean()))
    docs = np.split(ids, np.cumsum(sizes)[:-1])
    for seed in range(12):
        for d in range(12):
            tf = {t: (docs[d] == t).sum() for t in set(docs[seed].tolist())}
            norm = 1.2 * (0.25 + 0.75 * sizes[d] / sizes.mean())
            wanted = sum(idf[t] * n * 2.2 / (n + norm) for t, n in tf.items())
            assert np.isclose(shard.scores(seed)[d], wanted)


def test_op9_pieces_and_padding(spark, documents):
    pieces = packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), WORDS, False, 1, with_ids=True).collect()
    padding = check_pieces(pieces, documents)
    assert padding < 2048
    query = QUERIES["op9_packing"](spark, SF_DIR)
    assert "ids" not in query.columns and query.count() == len(pieces)


def test_related_documents_meet_wherever_they_stand(spark):
    """Two documents of one topic are in the same of eight shards far more often than by chance."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rng = np.random.default_rng(4)
    topics = [[f"{''.join(rng.permutation(list('abcdefghij')))}" for _ in range(30)] for _ in range(150)]
    own = [(10**6 + i, " ".join(rng.choice(topics[i % 150], 120))) for i in range(3000)]
    df = docs.unionByName(spark.createDataFrame(own, "doc_id long, text string").repartition(40))
    order = [r["doc_id"] for r in packing.placed(packing.encoded(df, WORDS, False, 1))[0].collect()]
    shard = {d: k // packing.SHARD_DOCUMENTS for k, d in enumerate(order)}
    assert len(set(shard.values())) == 8
    pairs = rng.integers(0, 20, (600, 3))
    pairs = [(10**6 + t * 150 + p, 10**6 + u * 150 + p) for t, u, p in zip(*pairs.T[:2], rng.integers(0, 150, 600), strict=True) if t != u]
    assert np.mean([shard[a] == shard[b] for a, b in pairs]) > 0.4  # chance: an eighth


def test_a_hot_group_of_copies_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_TOKENS", 2000)
    rows = [(i, "copy of a long enough text " * 5 if i % 2 else f"text {i} " * 15) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ordered = packing.placed(packing.encoded(df, WORDS, False, 1))[0]
    sizes = [r[0] for r in ordered.groupBy(spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 400 and max(sizes) < 120
    check_pieces(packing.pack(df, WORDS, False, 1, with_ids=True).collect(), rows)


def test_documents_longer_than_a_shard_and_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 300)
    monkeypatch.setattr(packing, "_TOKENS_AT_ONCE", 64)
    rows = [(1, "word " * 5000), (2, "a b c"), (3, None), (3, None), (4, "word " * 299), (5, "same text"), (5, "same text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    check_pieces(packing.pack(df, WORDS, False, 1, window=128, with_ids=True).collect(), rows, 128)


def test_vectors_do_not_depend_on_how_tokens_are_cut(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 50, 30)
    ids = rng.integers(0, 40, sizes.sum()).astype("<u4")
    places = packing.Places(rng.integers(1, 9, 40), 30)
    whole = places.of_documents(sizes, ids)
    monkeypatch.setattr(packing, "_TOKENS_AT_ONCE", 7)
    for a, b in zip(whole, places.of_documents(sizes, ids), strict=True):
        assert np.allclose(a, b, atol=1e-5)
