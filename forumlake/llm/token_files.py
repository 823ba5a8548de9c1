"""Token ids as Parquet list columns that can be read selectively."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlake.llm.encoding import encoder
from forumlake.llm.words import gathered

SLICE_BYTES = 2 << 20
#: Row groups are what a reader skips by a file's footer, pages what it skips by the page index.
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 64 << 10, 500


def write_tokens(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool, end_id: int) -> None:
    """Encode every whole text, append end_id, and write the ids to Parquet files in ascending order of doc_id.

    Columns: shard (the file's place in the order), doc_id, start_in_shard, n_tokens, ids. The ids are dictionary
    encoded, the ascending numbers delta encoded; sizes of row groups and pages are set, and every page has its
    range of doc_id in the page index. Null texts count as empty, a null doc_id comes first, and equal doc_ids
    are ordered by text. An empty table gives an empty set of files with the same columns.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        known, before = encoder(tokenizer, keeps_space), 0
        for batch in gathered(batches, SLICE_BYTES):
            ids, sizes = known.encode(batch["text"])
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, end_id).astype(np.int32)
            offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
            n = len(sizes)
            yield pa.record_batch(
                {
                    "shard": pa.array(np.full(n, shard, np.int32)),
                    "doc_id": batch["doc_id"],
                    "start_in_shard": pa.array(before + offsets[:-1]),
                    "n_tokens": pa.array(np.diff(offsets)),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                }
            )
            before += int(offsets[-1])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard int, doc_id {kind}, start_in_shard long, n_tokens long, ids array<int>"
    writer = ordered.mapInArrow(encode, schema).write.option("compression", "zstd")
    options = {
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": ROW_GROUP_BYTES,
        "parquet.page.size": PAGE_BYTES,
        "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.enable.dictionary": "true",
        "parquet.dictionary.page.size": 1 << 20,
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#start_in_shard": "false",
        "parquet.enable.dictionary#n_tokens": "false",
    }
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """doc_id, start (ids of all documents before it) and the given columns of the files.

    What a file adds to the starts within it comes from a read of three narrow columns, one row for each file. A
    filter on doc_id reaches the files, where row groups and pages outside its range are skipped.
    """
    files = spark.read.parquet(path)
    sizes = files.groupBy("shard").agg(F.max(F.expr("start_in_shard + n_tokens")).alias("n")).orderBy("shard").collect()
    before = accumulate([r["n"] for r in sizes], initial=0)
    offsets = spark.createDataFrame(
        [(r["shard"], b) for r, b in zip(sizes, before, strict=False)], "shard int, before long"
    )
    joined = files.select("shard", "doc_id", "start_in_shard", *columns).join(F.broadcast(offsets), "shard")
    return joined.select("doc_id", F.expr("before + start_in_shard").alias("start"), *columns)


def checksums(tokens: DataFrame) -> DataFrame:
    """The rows with ids_crc32 in place of ids: crc32 of the ids as little-endian unsigned 32-bit numbers."""
    others = [c for c in tokens.columns if c != "ids"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            ids = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")
            offsets = lists.offsets.to_numpy()
            found = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.record_batch({c: batch[c] for c in others} | {"ids_crc32": pa.array(found, pa.int64())})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != "ids")
    return tokens.select(*others, "ids").mapInArrow(sums, f"{fields}, ids_crc32 long")
