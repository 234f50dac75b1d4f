"""Exact top-k by inner product with a KD-tree per shard.

Vectors are dealt into shards of a bounded number. In each, a tree splits at the median of the
widest dimension down to small leaves, and every node keeps the tight box of its vectors. For
a block of queries nodes are visited best first: a box bounds the score of all that lies in it,
and queries whose kth score is above the bound do not go on into the node. A query first
searches its own shard; its kth score then goes with it to the other shards as a bound from the start.

Queries go to the other shards in blocks, and each (shard, block) is a task of bounded size.
Scores are whole numbers and exact.

Defined results: vectors that are null or hold a null or non-finite component take no part;
shorter vectors count as filled up with zeros; ties go to the smaller id; rows of the query's own
id are no candidates; other rows of equal id are candidates each; a query id that comes twice
is searched once, with its smallest vector; rows without an id take no part; an empty table gives an empty
result; only the named id and vector columns are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm._storage import materialise

FOUND = "query_id long, vec_id long, score long"


def _matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(rows):
        return np.zeros((0, width))
    flat, sizes = rows.flatten().to_numpy(zero_copy_only=False).astype(float), np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(sizes), max(width, int(sizes.max()))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


class Tree:
    """Nodes in one list: (low, high, left child, right child, rows of a leaf)."""

    def __init__(self, x: np.ndarray, leaf: int):
        self.x, self.nodes = x, []
        if len(x):
            self._build(np.arange(len(x)), leaf)

    def _build(self, rows: np.ndarray, leaf: int) -> int:
        low, high = self.x[rows].min(0), self.x[rows].max(0)
        me = len(self.nodes)
        self.nodes.append([low, high, -1, -1, rows])
        if len(rows) > leaf and (high > low).any():
            at = np.argpartition(self.x[rows, int(np.argmax(high - low))], len(rows) // 2)
            self.nodes[me][4] = None
            self.nodes[me][2] = self._build(rows[at[: len(rows) // 2]], leaf)
            self.nodes[me][3] = self._build(rows[at[len(rows) // 2 :]], leaf)
        return me

    def bound(self, node: int, q: np.ndarray) -> np.ndarray:
        """The highest score that anything in the node's box can have, for each query."""
        low, high = self.nodes[node][:2]
        return np.maximum(q, 0) @ high + np.minimum(q, 0) @ low


def _dot(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    most = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    if most * most * q.shape[1] < 2**53:  # exact in double precision
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def search(tree: Tree, ids: np.ndarray, q: np.ndarray, query_ids: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each query's k best (scores, ids) in the tree, as far as they reach ``kth``; -1 << 62 where there are fewer."""
    none = -(1 << 62)
    score, found = np.full((len(q), k), none, np.int64), np.full((len(q), k), 1 << 62, np.int64)
    kth = kth.copy()
    if not tree.nodes or not len(q):
        return score, found
    reach = tree.bound(0, q)
    heap = [(-reach.max(), 0, np.arange(len(q)), reach)]
    while heap:
        _, node, who, reach = heapq.heappop(heap)
        # Bounds are sums of doubles; whole numbers beyond 2**53 may be rounded.
        stay = reach + np.abs(reach) * 1e-12 >= kth[who]
        who = who[stay]
        if not len(who):
            continue
        left, right, rows = tree.nodes[node][2:]
        if rows is None:
            for child in (left, right):
                reach = tree.bound(child, q[who])
                heapq.heappush(heap, (-reach.max(), child, who, reach))
            continue
        s = _dot(q[who], tree.x[rows])
        s[ids[rows][None, :] == query_ids[who][:, None]] = none
        better = (s >= kth[who][:, None]).any(1) & (s > none).any(1)
        who, s = who[better], s[better]
        if len(who):
            all_s = np.concatenate([score[who], s], 1)
            all_i = np.concatenate([found[who], np.broadcast_to(ids[rows], s.shape)], 1)
            order = np.lexsort((all_i, -all_s), axis=-1)[:, :k]
            score[who], found[who] = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_i, order, 1)
            kth[who] = np.maximum(kth[who], score[who, -1])
    return score, found


def _table(query_ids: np.ndarray, score: np.ndarray, found: np.ndarray) -> pa.Table:
    keep = score > -(1 << 62)
    return pa.table({"query_id": np.broadcast_to(query_ids[:, None], score.shape)[keep], "vec_id": found[keep], "score": score[keep]})


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256, shard_rows: int = 16384, block_rows: int = 2048, leaf: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product for every query row, ``is_query`` on column ``id``."""
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    sound = F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    v = v.filter(sound).select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))
    n = v.count()
    shards, blocks = 1 + n // shard_rows, 1 + v.filter(is_query).count() // block_rows
    v = v.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    queries = v.filter(is_query).groupBy("id", "shard").agg(F.min("v").alias("v"))
    queries = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int")).withColumn("kth", F.lit(-(1 << 62)).cast("long"))

    def in_shard(rows: pa.Table, asked: pa.Table) -> pa.Table:
        x = _matrix(rows.column("v"))
        q = _matrix(asked.column("v"), x.shape[1])
        if q.shape[1] > x.shape[1]:
            x = np.pad(x, ((0, 0), (0, q.shape[1] - x.shape[1])))
        ids = asked.column("id").to_numpy()
        return _table(ids, *search(Tree(x, leaf), rows.column("id").to_numpy(), q, ids, asked.column("kth").to_numpy(), k))

    def both(asked: DataFrame) -> DataFrame:
        spread = v.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        # Queries come from the same rows; under new names for Spark the two sides are told apart.
        asked = asked.toDF(*(f"q_{c}" for c in asked.columns)).toDF(*asked.columns)
        return spread.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(in_shard, FOUND)

    home = materialise(both(queries))
    if shards == 1:
        found = home
    else:
        bounds = home.groupBy("query_id").agg(F.count("*").alias("have"), F.min("score").alias("least"))
        asked = queries.join(bounds, queries["id"] == bounds["query_id"], "left").withColumn("kth", F.when(F.col("have") >= k, F.col("least")).otherwise(F.col("kth")))
        asked = asked.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(F.col("to") != F.col("shard"))
        found = home.unionAll(both(asked.select("id", F.col("to").alias("shard"), "v", "block", "kth")))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("id") % 50 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
