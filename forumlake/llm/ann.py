"""Nearest vectors by balanced posting lists whose centroids are searched by a graph in memory."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlake.session import stored

#: Rows the centroids are fitted on; every row is indexed.
SAMPLE_ROWS = 20_000
#: Vectors of a list on average, unless that makes more lists than the sample can fit (eight rows each).
LIST_VECTORS = 100
#: Lists a vector may be in, and how much farther than the nearest centroid another may be for that.
REPLICAS, REPLICA_RATIO = 8, 1.2
#: Candidates the centroid search keeps for a vector to place and for a query, and links of a centroid. A query whose
#: lists go on past its candidates is compared with all centroids.
PLACE_BEAM, SEARCH_BEAM, LINKS = 16, 128, 16
#: A query reads the lists whose centroid is at most so many times as far as the nearest one.
SEARCH_RATIO = 1.12
#: A list with more vectors is read in blocks by several tasks.
BLOCK_VECTORS = 4096
_PIVOTS = 32
_BATCH = 2048
_WIDE = 256


def _finite(vectors: DataFrame) -> DataFrame:
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('infinity'))"
    exact = "float" if "float" in vectors.schema["embedding"].dataType.simpleString() else "double"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{exact}>"))
    return rows.where(f"vec_id IS NOT NULL AND embedding IS NOT NULL AND {finite} AND exists(embedding, x -> x <> 0)")


def dimension(vectors: DataFrame) -> int:
    """The most frequent dimension of the vectors that are otherwise usable, the smaller of two; 0 if there is none."""
    sizes = _finite(vectors).groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return sizes["d"] if sizes else 0


def usable(vectors: DataFrame, wanted: int) -> DataFrame:
    """vec_id and embedding of the rows that take part.

    Left out are null ids and vectors, vectors that hold null or non-finite components or only zeros, and vectors
    of another than the wanted dimension.
    """
    return _finite(vectors).where(F.size("embedding") == wanted)


@dataclass
class Centroids:
    points: np.ndarray
    links: np.ndarray
    pivots: np.ndarray

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids the graph search finds for each query, nearest first, with their distances.

        All queries of a batch go on side by side: each expands the nearest candidate it has not expanded, until every
        candidate in its beam is.
        """
        beam = min(beam, len(self.points))
        found = [self._batch(queries[at : at + _BATCH], beam) for at in range(0, len(queries), _BATCH)]
        if not found:
            return np.zeros((0, beam), np.int64), np.zeros((0, beam))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _batch(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, lists = len(queries), len(self.points)
        rows = np.arange(n)
        ids = np.broadcast_to(self.pivots, (n, len(self.pivots)))
        away = np.sqrt(((queries[:, None] - self.points[self.pivots][None]) ** 2).sum(axis=2))
        seen = np.zeros((n, lists + 1), bool)
        seen[:, lists] = True
        seen[rows[:, None], ids] = True
        size = max(beam, ids.shape[1])
        candidate = np.full((n, size), lists)
        distance = np.full((n, size), np.inf)
        order = np.argsort(away, axis=1, kind="stable")
        candidate[:, : ids.shape[1]] = np.take_along_axis(ids, order, 1)
        distance[:, : ids.shape[1]] = np.take_along_axis(away, order, 1)
        candidate, distance = candidate[:, :beam], distance[:, :beam]
        expanded = candidate == lists
        while not expanded.all():
            active = np.flatnonzero(~expanded.all(axis=1))
            at = np.argmin(np.where(expanded[active], np.inf, distance[active]), axis=1)
            expanded[active, at] = True
            near = self.links[candidate[active, at]]
            new = ~seen[active[:, None], near]
            seen[active[:, None], near] = True
            gap = queries[active][:, None] - self.points[np.where(new, near, 0)]
            away = np.where(new, np.sqrt((gap**2).sum(axis=2)), np.inf)
            ids = np.concatenate([candidate[active], np.where(new, near, lists)], axis=1)
            away = np.concatenate([distance[active], away], axis=1)
            done = np.concatenate([expanded[active], ~new], axis=1)
            order = np.argsort(away, axis=1, kind="stable")[:, :beam]
            candidate[active] = np.take_along_axis(ids, order, 1)
            distance[active] = np.take_along_axis(away, order, 1)
            expanded[active] = np.take_along_axis(done, order, 1)
        return candidate, distance


    def _all(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All centroids for each query, nearest first, with their distances."""
        square = (queries**2).sum(axis=1)[:, None] - 2 * queries @ self.points.T + (self.points**2).sum(axis=1)[None]
        away = np.sqrt(np.maximum(square, 0))
        order = np.argsort(away, axis=1, kind="stable")
        return order, np.take_along_axis(away, order, 1)

    def lists(self, queries: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and list of each list that a query reads: all that are near enough, more until they hold least vectors."""
        n = len(self.points)

        def chosen(rows: np.ndarray, near: np.ndarray, away: np.ndarray):
            held = np.where(near < n, sizes[np.minimum(near, n - 1)], 0)
            before = np.cumsum(held, axis=1) - held
            wanted = (away <= SEARCH_RATIO * away[:, :1]) | (before < least)
            row, place = np.nonzero(wanted & (near < n) & (held > 0))
            return wanted[:, -1] | (near[:, -1] == n), rows[row], near[row, place]

        rows = np.arange(len(queries))
        if not len(rows):
            return rows, rows
        goes_on, row, found = chosen(rows, *self.search(queries, SEARCH_BEAM))
        if n <= SEARCH_BEAM:
            return row, found
        ends = ~goes_on[row]
        parts = [(row[ends], found[ends])]
        wide = rows[goes_on]
        for at in range(0, len(wide), _WIDE):
            some = wide[at : at + _WIDE]
            parts.append(chosen(some, *self._all(queries[some]))[1:])
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def fit(sample: np.ndarray, lists: int) -> Centroids:
    """Centroids of clusters of equal size: the sample is halved again and again where it spreads most."""
    rng = np.random.default_rng(5)
    parts = [np.arange(len(sample))]
    while len(parts) < lists:
        parts.sort(key=len)
        part = parts.pop()
        if len(part) < 2:
            parts.append(part)
            break
        points = sample[part]
        ends = points[rng.choice(len(part), 2, replace=False)]
        for _ in range(4):
            along = ((points[:, None] - ends[None]) ** 2).sum(axis=2)
            side = along[:, 0] <= along[:, 1]
            if side.all() or not side.any():
                break
            ends = np.stack([points[side].mean(axis=0), points[~side].mean(axis=0)])
        order = np.argsort(points @ (ends[1] - ends[0]), kind="stable")
        parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    points = np.unique(np.stack([sample[p].mean(axis=0) for p in parts]), axis=0)
    n = len(points)
    near = min(LINKS, max(1, n - 1))
    links = np.zeros((n, 2 * near), np.int64)
    square = (points**2).sum(axis=1)
    for at in range(0, n, _BATCH):
        gap = square[at : at + _BATCH, None] - 2 * points[at : at + _BATCH] @ points.T + square[None]
        links[at : at + _BATCH, :near] = np.argsort(gap, axis=1)[:, 1 : near + 1] if n > 1 else 0
    # Links both ways where there is room, and random ones that join distant parts.
    links[:, near:] = rng.integers(0, n, (n, near))
    free = np.full(n, near)
    for a, row in enumerate(links[:, :near].tolist()):
        for b in row:
            if free[b] < 2 * near - 2:
                links[b, free[b]] = a
                free[b] += 1
    return Centroids(points, links, rng.permutation(n)[: min(_PIVOTS, n)])


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.float32)


def _double(values: list[bytes], like: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), like).reshape(len(values), -1).astype(np.float64)


def build(vectors: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Centroids | None, DataFrame]:
    """Centroids, and the posting lists (list, vec_id, vector) of all given vectors."""
    n = vectors.count()
    part = min(1.0, 1.2 * sample_rows / max(1, n))
    order = F.xxhash64(F.lit("sample"), "vec_id")
    thinned = vectors.where(F.pmod(order, F.lit(1 << 30)) < F.lit(part * (1 << 30))).select("embedding", order.alias("h"), "vec_id")
    sample = thinned.orderBy("h", "vec_id", "embedding").limit(sample_rows).select("embedding").toPandas()
    schema = "list long, vec_id long, vector binary"
    if sample.empty:
        return None, vectors.sparkSession.createDataFrame([], schema)
    points = np.stack(sample["embedding"].to_numpy()).astype(np.float64)
    centroids = fit(points, max(1, min(n // LIST_VECTORS, len(points) // 8)))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ids = _matrix(batch["embedding"]), batch["vec_id"].to_numpy()
            near, away = (x[:, :REPLICAS] for x in centroids.search(values.astype(np.float64), PLACE_BEAM))
            row, place = np.nonzero((away <= REPLICA_RATIO * away[:, :1]) & (near < len(centroids.points)))
            columns = [near[row, place], ids[row], [values[r].tobytes() for r in row]]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["list", "vec_id", "vector"])

    return centroids, vectors.select("vec_id", "embedding").mapInArrow(post, schema)


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 10, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The k nearest vectors found for each query, by Euclidean distance in double precision.

    query_id, rank (from 1), vec_id, score. A query never finds its own vec_id; ties go to the smaller vec_id. Rows with
    equal vec_id count once, at the smallest distance; so do queries. See usable() for rows that take no part; the
    dimension is that of most candidates, for queries too. A query reads the lists whose centroid is at most SEARCH_RATIO times as far as the nearest one, and more of the next
    until those hold four times k vectors. Large lists are read in blocks. Empty tables give an empty result.
    """
    size = dimension(vectors)
    both, asked = usable(vectors, size), usable(queries, size)
    centroids, posted = build(both, sample_rows)
    result = "query_id long, vec_id long, score double"
    if centroids is None:
        return _ranked(vectors.sparkSession.createDataFrame([], result), k)
    postings = stored(posted)
    kinds_of = (t.schema["embedding"].dataType.simpleString() for t in (asked, both))
    exact = ["<f4" if "float" in kind else "<f8" for kind in kinds_of]
    lists = len(centroids.points)
    sizes = np.zeros(lists, np.int64)
    for row in postings.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    blocks = np.maximum(1, -(-sizes // BLOCK_VECTORS))
    first = np.cumsum(blocks) - blocks

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, ids = _matrix(batch["embedding"]), batch["vec_id"].to_numpy()
            row, chosen = centroids.lists(values.astype(np.float64), sizes, 4 * k)
            n = blocks[chosen]
            block = np.repeat(first[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row = np.repeat(row, n)
            columns = [block, ids[row], [values[r].tobytes() for r in row]]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "query_id", "vector"])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, ids = batch["list"].to_numpy(), batch["vec_id"].to_numpy()
            block = first[where] + ids % blocks[where]
            yield pa.record_batch({"block": pa.array(block), "vec_id": batch["vec_id"], "vector": batch["vector"]})

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})]
        if len(left) and len(right):
            ids, points = right["vec_id"].to_numpy(), _double(right["vector"].tolist(), exact[1])
            for query, vector in zip(left["query_id"], _double(left["vector"].tolist(), exact[0]), strict=True):
                away = np.sqrt(((points - vector) ** 2).sum(axis=1))
                own = np.flatnonzero(ids != query)
                order = own[np.lexsort((ids[own], away[own]))]
                order = order[np.sort(np.unique(ids[order], return_index=True)[1])][:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[order], "score": away[order]}))
        return pd.concat(out)

    questions = asked.mapInArrow(ask, "block long, query_id long, vector binary")
    located = postings.mapInArrow(locate, "block long, vec_id long, vector binary")
    found = questions.groupBy("block").cogroup(located.groupBy("block")).applyInPandas(compare, result)
    return _ranked(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
