"""Nearest neighbours by inner product with vantage-point trees, one per shard of rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.llm.rows import ship
from snaptrend.session import checkpointed

ship(__name__)

SHARD_ROWS = 16_384
GROUP_QUERIES = 2_048
LEAF = 256

INDEX = "_dim int, _shard int, ids binary, vectors binary, nodes binary, top double"
FOUND = "query_id bigint, _twin bigint, vec_id bigint, score double"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows that take part: an id, and a vector that is not zero and has only finite numbers."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & finite & F.exists("_v", lambda x: x != 0))
    return rows.withColumn("_dim", F.size("_v"))


# --- one shard ------------------------------------------------------------------------------


def build_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and one row per node: from, to, inner child, outer child, vantage point,
    least and largest distance of the inner and of the outer points to it. Leaves have no children."""
    order = np.arange(len(points))
    nodes: list[list[float]] = []

    def grow(lo: int, hi: int) -> int:
        at = len(nodes)
        nodes.append([lo, hi, -1, -1, -1, 0, 0, 0, 0])
        if hi - lo > leaf:
            own = order[lo:hi]
            # The point farthest from the middle tells the others apart best.
            middle = points[own].mean(axis=0)
            vantage = own[np.argmax(((points[own] - middle) ** 2).sum(axis=1))]
            far = np.sqrt(((points[own] - points[vantage]) ** 2).sum(axis=1))
            rank = np.argsort(far, kind="stable")
            order[lo:hi], far = own[rank], far[rank]
            half = (hi - lo) // 2
            nodes[at][4:] = [vantage, far[0], far[half - 1], far[half], far[-1]]
            nodes[at][2] = grow(lo, lo + half)
            nodes[at][3] = grow(lo + half, hi)
        return at

    if len(points):
        grow(0, len(points))
    table = np.array(nodes, dtype=np.float64).reshape(-1, 9)
    place = np.argsort(order)
    inner = table[:, 4] >= 0
    table[inner, 4] = place[table[inner, 4].astype(int)]
    return order, table


def index_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Tree of a shard over vectors made equally long by one more number, so that the nearest point has
    the largest inner product. Equal rows count once."""
    dim, shard = key
    vectors = np.stack(rows["_v"].to_numpy()).astype(np.float64)
    ids = rows["vec_id"].to_numpy(np.int64)
    full = np.column_stack([ids.view(np.float64), vectors])
    _, first = np.unique(np.ascontiguousarray(full).view(f"V{8 * (dim + 1)}").ravel(), return_index=True)
    first = first[np.argsort(ids[first], kind="stable")]
    ids, vectors = ids[first], vectors[first]
    squares = (vectors**2).sum(axis=1)
    top = float(squares.max())
    lifted = np.column_stack([vectors, np.sqrt(np.maximum(top - squares, 0))])
    order, nodes = build_tree(lifted)
    return pd.DataFrame({
        "_dim": [dim], "_shard": [shard], "ids": [ids[order].tobytes()], "vectors": [vectors[order].tobytes()],
        "nodes": [nodes.tobytes()], "top": [top],
    })


class Search:
    """Best ``k`` points of one tree for many queries at a time."""

    def __init__(self, ids, vectors, nodes, top, k: int, factor: float):
        self.ids, self.vectors, self.nodes, self.top, self.k, self.factor = ids, vectors, nodes, top, k, factor
        squares = (vectors**2).sum(axis=1)
        self.lift = np.sqrt(np.maximum(top - squares, 0))

    def run(self, query_ids: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(queries)
        self.q, self.qid = queries, query_ids
        self.square = (queries**2).sum(axis=1) + self.top
        self.slack = 1e-9 * (self.square + 1e-300)
        self.score = np.full((n, self.k), -np.inf)
        self.found = np.full((n, self.k), np.iinfo(np.int64).max)
        self.visit(0, np.arange(n))
        return self.found, self.score

    def visit(self, at: int, active: np.ndarray) -> None:
        lo, hi, inner, outer, vantage = self.nodes[at, :5].astype(int)
        if inner < 0:
            self.leaf(lo, hi, active)
            return
        far = np.sqrt(np.maximum(self.square[active] - 2 * (self.q[active] @ self.vectors[vantage]), 0))
        in_lo, in_hi, out_lo, out_hi = self.nodes[at, 5:]
        near = far <= (in_hi + out_lo) / 2
        # Every query goes to its nearer side first, so that its bound is good when the other is weighed.
        for child, side, low, high in (
            (inner, near, in_lo, in_hi), (outer, ~near, out_lo, out_hi),
            (inner, ~near, in_lo, in_hi), (outer, near, out_lo, out_hi),
        ):
            if side.any():
                some = active[side]
                gap = np.maximum(np.maximum(far[side] - high, low - far[side]), 0) * self.factor
                reach = self.square[some] - 2 * self.score[some, -1]
                go = gap**2 <= reach + self.slack[some]
                if go.any():
                    self.visit(child, some[go])

    def leaf(self, lo: int, hi: int, active: np.ndarray) -> None:
        own = self.ids[lo:hi]
        rough = self.q[active] @ self.vectors[lo:hi].T
        rough[self.qid[active][:, None] == own[None, :]] = -np.inf
        least = self.score[active, -1]
        if hi - lo > self.k:
            least = np.maximum(least, np.partition(rough, -self.k, axis=1)[:, -self.k])
        rows, cols = np.nonzero((rough >= (least - self.slack[active])[:, None]) & (rough > -np.inf))
        if not len(rows):
            return
        exact = np.full(rough.shape, -np.inf)
        exact[rows, cols] = np.concatenate([
            inner_product(self.q[active[rows[i : i + 65536]]], self.vectors[lo + cols[i : i + 65536]])
            for i in range(0, len(rows), 65536)
        ])
        hit = np.unique(rows)
        who = active[hit]
        scores = np.concatenate([self.score[who], exact[hit]], axis=1)
        names = np.concatenate([self.found[who], np.broadcast_to(own, (len(hit), hi - lo))], axis=1)
        best = np.lexsort((names, -scores), axis=1)[:, : self.k]
        self.score[who] = np.take_along_axis(scores, best, axis=1)
        self.found[who] = np.take_along_axis(names, best, axis=1)


def inner_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, added from the first component to the last, so that any plain loop agrees to the bit."""
    return np.cumsum(a * b, axis=1)[:, -1]


# --- all shards -----------------------------------------------------------------------------


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """Trees of all shards, stored once; every usable row is in exactly one."""
    shards = max(1, math.ceil(rows.count() / shard_rows))
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return checkpointed(dealt.groupBy("_dim", "_shard").applyInPandas(index_shard, INDEX)), shards


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, factor: float = 1.0,
    id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` rows with the largest inner product of every query: query_id, rank, vec_id, score.

    A side of a tree is left out when the triangle inequality, its gap times ``factor``, puts all of it beyond
    the ``k``-th best: 1 is exact, larger is faster and may miss some. Rows without id, and vectors that are
    null, empty, zero or hold null or non-finite numbers take no part. Only vectors of one length are compared.
    A query never finds rows of its own id; equal rows count once. Ties go to the smaller id. Queries
    meet every shard in groups, so a task holds one shard and one group. Other columns are ignored.
    """
    rows = usable(vectors, id_col, vector_col)
    index, shards = build_index(rows, shard_rows)
    asked = usable(queries, id_col, vector_col).withColumn("_twin", F.xxhash64("_v")).dropDuplicates(["vec_id", "_twin"])
    groups = max(1, math.ceil(asked.count() / GROUP_QUERIES))
    asked = asked.withColumn("_group", F.pmod(F.xxhash64("vec_id", "_twin"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    trees = index.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    keys = ["_dim", "_shard", "_group"]

    def search(tree: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "_twin", "vec_id", "score"]
        if tree.empty or batch.empty:
            return pd.DataFrame({n: [] for n in names})
        row = tree.iloc[0]
        ids = np.frombuffer(row["ids"], np.int64)
        points = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
        nodes = np.frombuffer(row["nodes"], np.float64).reshape(-1, 9)
        ask = batch["vec_id"].to_numpy(np.int64)
        found, score = Search(ids, points, nodes, row["top"], k, factor).run(ask, np.stack(batch["_v"].to_numpy()))
        real = score > -np.inf
        at = np.nonzero(real)[0]
        return pd.DataFrame({
            "query_id": ask[at], "_twin": batch["_twin"].to_numpy()[at], "vec_id": found[real], "score": score[real],
        })

    found = trees.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, FOUND)
    best = Window.partitionBy("query_id", "_twin").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


QUERY = "op10_vp_neighbours"


def query(spark, folder) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    return nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
