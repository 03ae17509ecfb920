"""Exact nearest vectors by vector-approximation files.

Vectors lie in blocks. A block keeps, for every component, the cell of its value, and for
every cell the least and the largest value in it. A query scans the cells for an upper bound
of its inner product with every vector, then reads exact vectors in the order of the bounds
until the k-th result is certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 64
BLOCK_ROWS = 8192
# Exact vectors that are read together.
READ_ROWS = 32
# Queries whose bounds are computed together.
QUERY_ROWS = 256


class ApproximationFile:
    """Cells and exact integer vectors of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, cells: int = CELLS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        low, high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        width = np.maximum((high.astype(np.float64) - low) / cells, 1e-300)
        self.cells = np.minimum((self.vectors - low.astype(np.float64)) / width, cells - 1).astype(np.uint8)
        dims = np.arange(vectors.shape[1])
        least = np.full((cells, len(dims)), np.inf)
        most = np.full((cells, len(dims)), -np.inf)
        np.minimum.at(least, (self.cells, dims), self.vectors.astype(np.float64))
        np.maximum.at(most, (self.cells, dims), self.vectors.astype(np.float64))
        self._least, self._most, self._dims = least, most, dims
        self.largest = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No inner product of a query (row) and a vector (column) is above its bound."""
        q = queries.astype(np.float64)
        least, most = self._least[self.cells, self._dims], self._most[self.cells, self._dims]
        found = np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T
        size = float(np.abs(q).max(initial=0)) * self.largest * max(1, q.shape[1])
        return found + (size * 2.0 ** -45 if size >= 2.0 ** 53 else 0)

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        size = float(np.abs(query.astype(np.float64)).max(initial=0)) * self.largest * max(1, len(query))
        if size < 2.0 ** 62:
            return self.vectors[rows] @ query
        scores = self.vectors[rows].astype(object) @ query.astype(object)
        return np.array([min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in scores], np.int64)

    def nearest(self, query_id: int, query: np.ndarray, bound: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, id)``, ties to the smaller id."""
        order, best, at, ready = None, [], 0, 0
        while at < len(bound):
            if at >= ready:  # sort as much of the order as is needed
                ready = min(len(bound), max(4 * READ_ROWS, 4 * at))
                if ready < len(bound):
                    floor = np.partition(bound, len(bound) - ready)[len(bound) - ready]
                    among = np.flatnonzero(bound >= floor)
                else:
                    among = np.arange(len(bound))
                order = among[np.lexsort((self.ids[among], -bound[among]))]
                ready = len(order)
            rows = order[at:at + READ_ROWS]
            if len(best) >= k and (bound[rows[0]] < best[k - 1][0] or (bound[rows[0]] == best[k - 1][0] and self._later(rows[0], best[k - 1], bound))):
                break
            found = [(int(s), int(i)) for s, i in zip(self.exact(query, rows), self.ids[rows]) if i != query_id]
            best = sorted(best + found, key=lambda x: (-x[0], x[1]))[:k]
            at += len(rows)
        return best

    def _later(self, row: int, last: tuple[int, int], bound: np.ndarray) -> bool:
        """Whether all vectors from ``row`` on lose a tie: those of an equal bound come by id."""
        return self.ids[row] > last[1]


def _packed(column: str):
    return F.col(column).cast("array<bigint>")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` largest inner products of each query.

    Both tables have ``vec_id long`` and ``vector array<bigint>``; rows with a null id or vector
    take no part, and a vector meets only queries of its own length. A query's own id is no
    result; of a query id that repeats, the least vector counts. Ties go to the smaller id;
    scores beyond 64 bits are clipped. Every query meets every block; blocks hold about
    ``block_rows`` vectors whatever the size of the table, and only the best ``k`` of each
    block go on.
    """
    vectors = vectors.where("vec_id is not null and vector is not null")
    queries = queries.where("vec_id is not null and vector is not null").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-vectors.count() // block_rows))
    size = F.size("vector").alias("dims")
    stored = vectors.select(size, F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("side"), "vec_id", _packed("vector").alias("vector"))
    asked = queries.select(size, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"), "vec_id", _packed("vector").alias("vector"))
    dealt = stored.union(asked).repartition("dims", "block").sortWithinPartitions("dims", "block", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, rows, file = None, [], [], None

        def answers(q_ids: np.ndarray, q_rows: np.ndarray) -> pa.RecordBatch:
            out = []
            for start in range(0, len(q_ids), QUERY_ROWS):
                part = q_rows[start:start + QUERY_ROWS]
                for query_id, query, bound in zip(q_ids[start:start + QUERY_ROWS], part, file.bounds(part)):
                    out += [(int(query_id), i, s) for s, i in file.nearest(int(query_id), query, bound, k)]
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("dims", "block", "side")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            batch_ids = batch.column("vec_id").to_numpy()
            for start, end in zip([0, *cuts], [*cuts, len(batch_ids)]):
                if start == end:
                    continue
                dims, block, side = (int(x) for x in keys[:, start])
                if (dims, block) != at:
                    at, ids, rows, file = (dims, block), [], [], None
                part = batch.column("vector").slice(start, end - start).flatten().to_numpy().reshape(end - start, dims)
                if side == 0:
                    ids.append(batch_ids[start:end])
                    rows.append(part)
                elif rows:
                    file = file or ApproximationFile(np.concatenate(ids), np.concatenate(rows))
                    yield answers(batch_ids[start:end], part)

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def scaled(embeddings: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", factor: int = 256) -> DataFrame:
    """``vec_id, vector`` with components floor(factor * x); vectors with null or non-finite ones are left out."""
    x = F.col(vector_column).cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    vector = F.transform(x, lambda v: F.floor(v * factor))
    return embeddings.where(F.col(vector_column).isNotNull() & F.coalesce(usable, F.lit(False))).select(F.col(id_column).alias("vec_id"), vector.alias("vector"))
