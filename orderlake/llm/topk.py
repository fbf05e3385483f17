"""Exact top-k inner products with Fagin's threshold algorithm (operator 4).

The vectors are dealt into blocks.  A block is indexed once: per dimension, the rows sorted
by that component.  A query reads the lists of its dimensions in step, from the end that
its own component favours; every row met is scored in full.  The sum of the contributions
at the current depth bounds the score of every row not met yet; the search stops when the
bound cannot beat the k-th score.  Depth doubles, so that few steps are needed where the
bound falls slowly.

Queries form blocks too.  Every pair (vector block, query block) is a task of its own; the
k best of each block meet in a last ranking.  Scores are whole numbers, so the order of
work never changes a result.

Cases: vectors that are null or hold a null or a non-finite component take no part, neither
as query nor as candidate; missing trailing components count as zero; a candidate row with
the query's own vec_id is its own row; rows with a null vec_id take no part; ties go to the
smaller vec_id; a query with no candidate has no rows; repeated rows rank each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import pack, parts_for, staged, unpack

#: Vectors in a block, and queries in a block.
BLOCK_ROWS = 8192
QUERY_ROWS = 2048


def quantized(vectors: DataFrame, scale: int = 1024, vec_id: str = "vec_id",
              embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, for whole vectors only."""
    whole = F.col("x").isNotNull() & ~F.exists(
        "x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vectors.select(vectors[vec_id].cast("long").alias("vec_id"),
                          vectors[embedding].cast("array<double>").alias("x")) \
        .where(whole & F.col("vec_id").isNotNull()) \
        .select("vec_id", F.transform("x", lambda c: F.floor(c * F.lit(scale))).alias("v"))


def _matrix(ids: list, values: list) -> tuple[np.ndarray, np.ndarray]:
    width = max(map(len, values), default=0)
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return np.array(ids, np.int64), out


def _packed(vectors: DataFrame, rows: int, total: int) -> tuple[DataFrame, int]:
    """Blocks of about ``rows`` vectors: (block, n, payload of ids and matrix)."""
    blocks = parts_for(total, rows, least=1)

    def fold(key, table):
        ids, m = _matrix(table.column("vec_id").to_pylist(), table.column("v").to_pylist())
        order = np.argsort(ids, kind="stable")
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                         "payload": pa.array([pack(ids[order], *m[order].T.copy())], pa.binary())})

    keyed = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    return keyed.groupBy("block").applyInArrow(fold, "block int, payload binary"), blocks


class SortedLists:
    """One block: its rows and, per dimension, the row numbers by rising component."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids.astype(np.int64), matrix.astype(np.int64)
        self.by = np.argsort(self.matrix, axis=0, kind="stable")
        self.largest = float(np.abs(self.matrix).max(initial=0))
        self.floats = self.matrix.astype(np.float64)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(vec_ids, scores) of the k best rows other than ``own``, ties to smaller ids."""
        n, width = self.matrix.shape
        q = np.zeros(width, np.int64)
        q[:min(width, len(query))] = query[:width]
        used = np.flatnonzero(q)
        down = q[used] > 0
        # float64 products are exact (and faster) while every sum stays below 2^53
        exact = self.largest * float(np.abs(q).max(initial=0)) * max(width, 1) < 2.0 ** 53
        rows, qv = (self.floats, q.astype(np.float64)) if exact else (self.matrix, q)
        met = np.zeros(n, bool)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, max(4 * k, 64)
        while depth < n:
            to = min(n, depth + step)
            if len(used):
                new = np.concatenate((self.by[n - to:n - depth, used[down]].ravel(),
                                      self.by[depth:to, used[~down]].ravel()))
            else:
                new = np.arange(n)
                to = n
            new = np.unique(new[~met[new]])
            met[new] = True
            new = new[self.ids[new] != own]
            ids = np.concatenate((ids, self.ids[new]))
            scores = np.concatenate((scores, (rows[new] @ qv).astype(np.int64)))
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            depth, step = to, step * 2
            if len(ids) == k and len(used) and depth < n:
                edge = np.where(down, self.matrix[self.by[n - depth, used], used],
                                self.matrix[self.by[depth - 1, used], used])
                # a row not met scores at most this; an equal score could win the tie
                if int((edge * q[used]).sum()) < scores[-1]:
                    break
        return ids, scores


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows; ``is_query`` is a condition
    on ``vec_id``."""
    whole = staged(quantized(vectors, scale), "vectors")
    total = whole.count()
    queries = whole.where(is_query).dropDuplicates(["vec_id", "v"])
    asked = queries.count()
    data, _ = _packed(whole, BLOCK_ROWS, total)
    ask, ask_blocks = _packed(queries, QUERY_ROWS, asked)
    # every vector block meets every query block by an equi-join on the query block's number
    tasks = staged(data, "vector-blocks").withColumnRenamed("payload", "rows") \
        .select("rows", F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1))).alias("block")) \
        .join(staged(ask, "query-blocks").withColumnRenamed("payload", "asked"), "block")

    def search(batches):
        for batch in batches:
            for rows, asked in zip(batch.column("rows").to_pylist(), batch.column("asked").to_pylist()):
                ids, *m = unpack(rows)
                lists = SortedLists(ids, np.stack(m, axis=1) if m else np.zeros((len(ids), 0), np.int64))
                q_ids, *q = unpack(asked)
                q = np.stack([x.astype(np.int64) for x in q], axis=1) if q else np.zeros((len(q_ids), 0), np.int64)
                for own, query in zip(q_ids.astype(np.int64), q):
                    found, score = lists.search(int(own), query, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), own)), pa.array(found), pa.array(score)],
                        ["query_id", "vec_id", "score"])

    parts = max(1, ask_blocks * parts_for(total, BLOCK_ROWS, least=1))
    found = tasks.repartition(parts).mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
