"""Nearest neighbours with vantage-point trees, one tree per shard of the vectors.

Every task cuts its vectors into shards of at most ``shard_rows``, builds a
vantage-point tree of each (median split on the distance to a vantage point)
and searches it for a whole block of queries at once. A subtree whose bound by
the triangle inequality is above the query's k-th distance so far, divided by
``factor``, is skipped. Factor 1 is the exact search; larger factors skip more.
The k best of a task's earlier shards stay in force, so later shards prune
against them. The tasks' answers, k per query, are merged by rank.

Every vector is indexed; nothing is sampled. Queries are broadcast in blocks of
at most ``query_block`` rows; more queries mean more passes over the vectors.

Edge cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows with a null id; a query skips every row of
its own id; vectors of another dimension than the query's are no candidates;
repeated rows are answers as often as they occur, and a repeated query is
answered once; ties go to the smaller id; an empty table gives no answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.store import materialize

SHARD_ROWS = 8192
LEAF_ROWS = 64
QUERY_BLOCK = 4096
FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances [row of a, row of b] in double precision, summed component by component."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        total += gap * gap
    return np.sqrt(total)


class Best:
    """The k nearest found so far of every query, ordered by (distance, id)."""

    def __init__(self, queries: int, k: int):
        self.d = np.full((queries, k), np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def offer(self, q: np.ndarray, d: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        d = np.where(ids[None, :] == own[q][:, None], np.inf, d)
        rows = np.flatnonzero((d <= self.d[q, -1:]).any(axis=1) & np.isfinite(d).any(axis=1))
        if len(rows):
            at = q[rows]
            all_d = np.concatenate([self.d[at], d[rows]], axis=1)
            all_i = np.concatenate([self.ids[at], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
            all_i = np.where(np.isinf(all_d), np.iinfo(np.int64).max, all_i)
            order = np.lexsort((all_i, all_d), axis=-1)[:, :self.d.shape[1]]
            self.d[at] = np.take_along_axis(all_d, order, axis=1)
            self.ids[at] = np.take_along_axis(all_i, order, axis=1)


class Tree:
    """Vantage-point tree of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.ids, self.vectors = ids, vectors
        self.root = self._build(np.arange(len(ids)), leaf_rows)

    def _build(self, rows: np.ndarray, leaf_rows: int):
        if len(rows) <= leaf_rows:
            return rows
        # vantage point: the row farthest from an arbitrary one
        start = distances(self.vectors[rows[:1]], self.vectors[rows])[0]
        pick = int(np.argmax(start))
        vantage, rest = rows[pick], np.delete(rows, pick)
        d = distances(self.vectors[[vantage]], self.vectors[rest])[0]
        inner = d <= np.median(d)
        if inner.all():
            inner = d < d.max()
        if not inner.any():  # all equally far, such as copies: a leaf
            return rows
        near, far = rest[inner], rest[~inner]
        return (vantage, d[inner].max(), d[~inner].min(), d[~inner].max(),
                self._build(near, leaf_rows), self._build(far, leaf_rows))

    def search(self, queries: np.ndarray, own: np.ndarray, best: Best, factor: float) -> int:
        """Offer the shard's rows to ``best``; returns the number of distances computed."""
        return self._visit(self.root, np.arange(len(queries)), queries, own, best, factor)

    def _visit(self, node, q: np.ndarray, queries, own, best, factor) -> int:
        if not len(q):
            return 0
        if isinstance(node, np.ndarray):
            for a in range(0, len(node), 1024):  # a leaf of copies may be long
                part = node[a:a + 1024]
                best.offer(q, distances(queries[q], self.vectors[part]), self.ids[part], own)
            return len(q) * len(node)
        vantage, near_max, far_min, far_max, near, far = node
        d = distances(queries[q], self.vectors[[vantage]])
        best.offer(q, d, self.ids[[vantage]], own)
        d = d[:, 0]
        slack = 1e-9 * (d + far_max)  # rounding of the distances
        reach = lambda: best.d[q, -1] / factor + slack
        first = d <= (near_max + far_min) / 2
        n = len(q) + self._visit(near, q[first], queries, own, best, factor)
        n += self._visit(far, q[np.maximum(far_min - d, d - far_max) <= reach()], queries, own, best, factor)
        return n + self._visit(near, q[~first & (d - near_max <= reach())], queries, own, best, factor)


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, vec array of double) of the rows that take part."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    bad: Column = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull())
            .filter(~bad & F.exists("vec", lambda x: x != 0)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def search(queries: DataFrame, vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           factor: float = 1.0, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the ``k`` nearest found of each query."""
    if factor < 1:
        raise ValueError("factor must be at least 1")
    spark = vectors.sparkSession
    asked = valid_vectors(queries, id_col, vec_col).distinct()
    base = valid_vectors(vectors, id_col, vec_col)
    total = asked.count()
    blocks = 1 if total <= query_block else -(-2 * total // query_block)
    merged = None
    for b in range(blocks):
        part = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) == b)
        rows = part.collect()  # a block of the query set
        by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim in sorted({len(r["vec"]) for r in rows}):
            same = [r for r in rows if len(r["vec"]) == dim]
            by_dim[dim] = (np.array([r["id"] for r in same], dtype=np.int64), np.array([r["vec"] for r in same]))
        block = spark.sparkContext.broadcast(by_dim)

        def scan(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            best = {dim: Best(len(ids), k) for dim, (ids, _) in block.value.items()}
            for batch in batches:
                for a in range(0, len(batch), shard_rows):
                    ids, vecs = batch.column("id").slice(a, shard_rows), batch.column("vec").slice(a, shard_rows)
                    sizes = vecs.value_lengths().to_numpy(zero_copy_only=False)
                    for dim in np.unique(sizes):
                        if int(dim) in best:
                            own, q = block.value[int(dim)]
                            keep = pa.array(sizes == dim)
                            Tree(ids.filter(keep).to_numpy(), _matrix(vecs.filter(keep))).search(q, own, best[int(dim)], factor)
            for dim, top in best.items():
                got = np.isfinite(top.d)
                who = np.broadcast_to(block.value[dim][0][:, None], top.d.shape)
                yield pa.RecordBatch.from_arrays([pa.array(who[got]), pa.array(top.ids[got]), pa.array(top.d[got])], FOUND.names)

        near = Window.partitionBy("query_id").orderBy("score", "vec_id")
        out = (base.mapInArrow(scan, FOUND).withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
               .select("query_id", "rank", "vec_id", "score"))
        if blocks > 1:
            out = materialize(out, "vptree-answers")
            block.unpersist()
        merged = out if merged is None else merged.unionByName(out)
    return merged
