"""Nearest neighbours by largest inner product, found by counting collisions.

Vectors are scaled into the unit ball and lifted onto the sphere, where the largest inner
product is the least distance. A block of vectors is indexed by the sorted arrays of its
projections on random lines. Around a query's projection a window as wide as a radius asks
for is opened on each line; a vector that falls into enough windows is verified. The radius
starts small; the distances verified then say how far the windows have to be expanded.
"""

from __future__ import annotations

from math import ceil, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.llm.scratch import store
from subtide.operators.joins import hash_join

LINES, FIRST_LINES = 64, 16
BLOCK_ROWS, QUERY_ROWS = 8192, 512
FIRST_RADIUS, FIRST_VERIFIED = 0.6, 200
REACH = 1.75  # half a window in units of the radius
#: A vector at the radius's distance misses a window with this probability ...
MISS = 1 - erf(REACH / sqrt(2))
#: ... and is still verified if it misses so many standard deviations more than expected.
SLACK = 0.5
SEED = 7


def lines(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((LINES, dimensions + 1))


def allowed_misses(n: int) -> int:
    return ceil(n * MISS + SLACK * sqrt(n * MISS * (1 - MISS)))


class Block:
    """Vectors, and for each line their order along it and their places on it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray | None = None, places: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors.astype(np.float64)
        if order is None:
            norms = np.sqrt((self.vectors**2).sum(axis=1))
            scaled = self.vectors / norms.max()
            lifted = np.column_stack([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))])
            places = lifted @ lines(vectors.shape[1]).T
            order = np.argsort(places, axis=0, kind="stable").T.astype(np.int32)
            places = np.take_along_axis(places.T, order, axis=1)
        self.order, self.places = order.astype(np.intp), places
        self.longest = np.sqrt((self.vectors**2).sum(axis=1)).max()

    def misses(self, on_lines: np.ndarray, radius: float) -> np.ndarray:
        """For each vector, on how many of the query's lines its place is outside the window."""
        n, half = len(self.ids), REACH * radius
        outside = []
        for j, place in enumerate(on_lines):
            low, high = np.searchsorted(self.places[j], (place - half, place + half))
            outside += (self.order[j, :low], self.order[j, high:])
        return np.bincount(np.concatenate(outside), minlength=n)

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the k nearest vectors found."""
        query = query.astype(np.float64)
        length = np.sqrt((query**2).sum())
        at = lines_cached(len(query)) @ np.append(query / length, 0)

        def best(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            scores = self.vectors[rows] @ query
            if len(rows) > 4 * k:  # only those that reach the k-th score need sorting
                high = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                rows, scores = rows[high], scores[high]
            first = np.lexsort((self.ids[rows], -scores))[:k]
            return rows[first], scores[first]

        n = len(self.ids)
        if n <= max(4 * k, FIRST_VERIFIED):
            rows, scores = best(np.arange(n))
            return self.ids[rows], scores
        missed = self.misses(at[:FIRST_LINES], FIRST_RADIUS)
        tried = np.argpartition(missed, FIRST_VERIFIED)[:FIRST_VERIFIED]
        rows, scores = best(tried)
        # the k-th distance is at most this: windows are expanded to it
        radius = sqrt(max(0.0, 2 - 2 * scores[-1] / (length * self.longest))) if len(scores) == k else 2.0
        missed = self.misses(at, max(radius, 1e-6))
        close = missed <= allowed_misses(LINES)
        close[rows] = True
        rows, scores = best(np.flatnonzero(close))
        return self.ids[rows], scores


_lines: dict[int, np.ndarray] = {}


def lines_cached(dimensions: int) -> np.ndarray:
    if dimensions not in _lines:
        _lines[dimensions] = lines(dimensions)
    return _lines[dimensions]


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), dtype=np.float64).reshape(rows, -1)


def build_index(vectors: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """A row for each block: dims, block, ids, vectors, order, places (as bytes). ``blocks``
    says for each length of vectors how many there are."""
    def build(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("id"))
        block = Block(ids, _matrix(table.column("vector"), len(ids)))
        values = [np.asarray(table.column(c))[0] for c in ("dims", "block")]
        data = [block.ids.astype("<i8"), block.vectors.astype("<f8"), block.order.astype("<i4"), block.places.astype("<f8")]
        return pa.table({"dims": values[:1], "block": values[1:]} | {n: [d.tobytes()] for n, d in zip(("ids", "vectors", "order", "places"), data)})

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), _of_length(blocks)).cast("int")).select("dims", "block", "id", "vector")
    return dealt.groupBy("dims", "block").applyInArrow(build, "dims int, block int, ids binary, vectors binary, order binary, places binary")


def _per_length(vectors: DataFrame, rows: int) -> dict[int, int]:
    """For each length of vectors, how many groups of so many rows they make."""
    return {r.dims: ceil(r.n / rows) for r in vectors.groupBy("dims").agg(F.count("*").alias("n")).collect()}


def _of_length(numbers: dict[int, int]) -> Column:
    """The number of the row's length, a literal for the few lengths there are; null for
    others."""
    if not numbers:
        return F.lit(None).cast("int")
    return F.element_at(F.create_map(*(F.lit(x) for pair in numbers.items() for x in pair)), F.col("dims"))


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vector, dims of the rows that take part: no null, zero or empty vector, no null or
    non-finite component. Of rows with one id the least vector counts."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        table.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .filter(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
        # 0.0 for -0.0, so that equal vectors are one group
        .groupBy("id").agg(F.transform(F.min("vector"), lambda x: x + 0.0).alias("vector")).withColumn("dims", F.size("vector"))
    )


def distinct_vectors(kept: DataFrame, most: int) -> DataFrame:
    """(id, vector, dims, copies): each different vector once, under its least id, with the
    ``most`` least ids that have it. Of a vector's rows each task passes only so many on."""
    least = Window.partitionBy("vector").orderBy("id")
    first = kept.withColumn("nth", F.row_number().over(least)).filter(F.col("nth") <= most)
    return first.groupBy("vector", "dims").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("copies")).select("id", "vector", "dims", "copies")


def nearest(table: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k nearest rows of the table with
    another id, nearest first, ties to the smaller id; scores are exact inner products in
    double precision. Every row is indexed; blocks of queries meet blocks of the index, and
    a query's results are merged.

    Rows with equal vectors are searched as one and are all found with it, by ascending id.
    Vectors that are null, empty or zero, or hold null or non-finite entries take no part;
    neither do null ids; of rows with one id the least vector counts. Only vectors of one
    length are compared. Empty tables give no row.
    """
    kept = store(distinct_vectors(usable(table, key, vector), k + 1), "vectors")
    asked = store(usable(queries, key, vector), "vector-queries")
    blocks, groups = _per_length(kept, BLOCK_ROWS), _per_length(asked, QUERY_ROWS)
    index = store(build_index(kept, blocks), "vector-index")
    dealt = asked.withColumn("group", F.pmod(F.xxhash64("id"), _of_length(groups)).cast("int")).select(
        "dims", "id", "vector", "group", F.explode(F.sequence(F.lit(0), _of_length(blocks) - 1)).alias("block")
    )
    spread = index.withColumn("group", F.explode(F.sequence(F.lit(0), _of_length(groups) - 1)))

    def search(index: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if index.num_rows and asked.num_rows:
            row = index.slice(0, 1).to_pylist()[0]
            ids, dims = np.frombuffer(row["ids"], "<i8"), row["dims"]
            n = len(ids)
            block = Block(
                ids, np.frombuffer(row["vectors"], "<f8").reshape(n, dims),
                np.frombuffer(row["order"], "<i4").reshape(LINES, n), np.frombuffer(row["places"], "<f8").reshape(LINES, n),
            )
            for query_id, query in zip(asked.column("id").to_pylist(), _matrix(asked.column("vector"), asked.num_rows)):
                # one more, as the query's own vector is among them
                found, scores = block.search(query, k + 1)
                out.append((np.full(len(found), query_id), found, scores))
        query_ids, ids, scores = (np.concatenate(x) for x in zip(*out)) if out else ([], [], [])
        return pa.table({"query_id": pa.array(query_ids, pa.int64()), "id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    found = spread.groupBy("dims", "block", "group").cogroup(dealt.groupBy("dims", "block", "group")).applyInArrow(search, "query_id long, id long, score double")

    def first(rows: DataFrame, column: str, n: int) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), column)
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

    best = first(found, "id", k + 1).drop("rank")
    rows = hash_join(best, kept.select("id", "copies"), ["id"], "inner").select("query_id", "score", F.explode("copies").alias("vec_id"))
    return first(rows.filter("vec_id <> query_id"), "vec_id", k).select("query_id", "rank", "vec_id", "score")
