"""Exact top-k inner-product search by dual-tree cover trees.

Vectors and queries are packed into blocks of fixed size; every pair of a query block and a data block is one row of
an equi-join, so no task ever holds more than two blocks, no vector is broadcast, and the queries meet all rows. In a
pair both blocks are indexed by cover trees and traversed together: a pair of nodes is pruned when

    <q, x> <= <cq, cx> + rq |cx| + rx |cq| + rq rx

stays below the worst k-th score of the query group. The k best of each query and block are then merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch

QUERY_BLOCK = 4096
DATA_BLOCK = 16384
LEAF = 64


class CoverTree:
    """A cover tree over integer vectors, by levels.

    The root covers all points. Each node is split by greedy centres that lie more than half its radius apart and
    cover its points within that distance; a node that is small, or whose split would not gather points any more, is
    a leaf. Radii are the true largest distances, so bounds hold whatever the split.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.leaf = leaf
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, list[int]]] = []
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        if len(points):
            self._build(0, len(points))
        self.centre = np.array(self.centres, np.float64).reshape(len(self.nodes), points.shape[1])
        self.radius = np.array(self.radii, np.float64)
        self.norm = np.sqrt((self.centre ** 2).sum(1))

    def _node(self, lo: int, hi: int) -> int:
        p = self.points[self.order[lo:hi]]
        c = p.mean(0)
        self.centres.append(c)
        self.radii.append(float(np.sqrt(((p - c) ** 2).sum(1).max())) + 1e-6)
        self.nodes.append((lo, hi, []))
        return len(self.nodes) - 1

    def _build(self, lo: int, hi: int) -> int:
        root = self._node(lo, hi)
        todo = [root]
        while todo:
            me = todo.pop()
            lo, hi, children = self.nodes[me]
            if hi - lo <= self.leaf or self.radii[me] <= 1e-5:
                continue
            parts = self._cover(lo, hi, self.radii[me] / 2)
            at = lo
            for part in parts:
                self.order[at:at + len(part)] = part
                children.append(self._node(at, at + len(part)))
                at += len(part)
            todo += children
        return root

    def _cover(self, lo: int, hi: int, reach: float) -> list[np.ndarray]:
        """Greedy centres farther than ``reach`` from each other; then pieces of leaf size for what no centre gathers."""
        own = self.order[lo:hi].copy()
        p = self.points[own]
        near, who = np.full(len(own), np.inf), np.zeros(len(own), np.int64)
        most = max(2, min(16, len(own) // self.leaf + 1))
        pick = int(((p - p.mean(0)) ** 2).sum(1).argmax())
        for k in range(most):
            d = ((p - p[pick]) ** 2).sum(1)
            closer = d < near
            near[closer], who[closer] = d[closer], k
            pick = int(near.argmax())
            if near[pick] <= reach * reach:
                break
        parts = [own[who == k] for k in range(most) if (who == k).any()]
        if len(parts) == 1:  # equal points: cut by number
            half = len(own) // 2
            return [own[:half], own[half:]]
        return parts


def dual_search(queries: np.ndarray, q_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (ids, scores) of each query, its own id left out; ties go to the smaller id. Missing places: -1.

    Also returns the number of node pairs compared point by point.
    """
    n = len(queries)
    best_s = np.full((n, k), -np.inf)
    best_i = np.full((n, k), np.iinfo(np.int64).max)
    scored = 0
    if n and len(points):
        q, x = queries.astype(np.float64), points.astype(np.float64)
        qt, xt = CoverTree(q), CoverTree(x)

        def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Largest inner product any pair below nodes a and b can have (rows: b)."""
            return (xt.centre[b] @ qt.centre[a] + qt.radius[a] * xt.norm[b] + xt.radius[b] * qt.norm[a]
                    + qt.radius[a] * xt.radius[b] + 1e-3)

        # each query group descends with the list of data nodes that are still open, best bound first
        stack = [(0, np.zeros(1, np.int64))]
        while stack:
            a, front = stack.pop()
            lo, hi, children = qt.nodes[a]
            rows = qt.order[lo:hi]
            if children:
                opened = [c for b in front for c in (xt.nodes[b][2] or [b])]
                opened = np.array(opened, np.int64)
                worst = best_s[rows].min()
                opened = opened[bound(a, opened) >= worst]
                stack += [(c, opened) for c in children]
                continue
            heap = front
            while len(heap):
                b_all = bound(a, heap)
                worst = best_s[rows, k - 1].min()
                keep = b_all >= worst
                heap, b_all = heap[keep], b_all[keep]
                if not len(heap):
                    break
                order = np.argsort(-b_all)
                take = heap[order[:8]]
                heap = heap[order[8:]]
                opened = [c for b in take for c in xt.nodes[b][2]]
                leaves = [b for b in take if not xt.nodes[b][2]]
                if leaves:
                    cols = np.concatenate([xt.order[xt.nodes[b][0]:xt.nodes[b][1]] for b in leaves])
                    scored += len(leaves)
                    s = q[rows] @ x[cols].T
                    s[q_ids[rows][:, None] == ids[cols][None, :]] = -np.inf
                    _merge(best_s, best_i, rows, s, np.broadcast_to(ids[cols], s.shape), k)
                if opened:
                    heap = np.concatenate([heap, np.array(opened, np.int64)])
    best_i[~np.isfinite(best_s)] = -1
    return best_i, best_s, scored


def _merge(best_s, best_i, rows, s, ids, k) -> None:
    s_all = np.concatenate([best_s[rows], s], 1)
    i_all = np.concatenate([best_i[rows], ids], 1)
    o = np.lexsort((i_all, -s_all), axis=1)[:, :k]
    best_s[rows] = np.take_along_axis(s_all, o, 1)
    best_i[rows] = np.take_along_axis(i_all, o, 1)


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 1024) -> DataFrame:
    """(vec_id, v) with v the integers floor(scale * component as double).

    Rows whose id or vector is null, whose vector is empty, or that hold a null or non-finite component are left out.
    """
    v = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    whole = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & F.coalesce(whole, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(dim, n, ids, body): packed rows of one dimension, at most ``size`` in a block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            col = batch.column("v")
            off = col.offsets.to_numpy()
            flat = col.values.to_numpy(zero_copy_only=False)
            dims = np.diff(off)
            for d in np.unique(dims):
                pick = np.flatnonzero(dims == d)
                body = flat[(off[:-1][pick][:, None] + np.arange(d)[None, :])].reshape(len(pick), d)
                got = held.setdefault(int(d), [])
                got.append((ids[pick], body))
                while sum(len(i) for i, _ in got) >= size:
                    all_ids, all_body = (np.concatenate(x) for x in zip(*got, strict=True))
                    yield row(d, all_ids[:size], all_body[:size])
                    got[:] = [(all_ids[size:], all_body[size:])] if len(all_ids) > size else []
        for d, got in held.items():
            if got:
                yield row(d, *(np.concatenate(x) for x in zip(*got, strict=True)))

    def row(d, ids, body) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "dim": pa.array([int(d)], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "body": pa.array([body.astype(np.int64).tobytes()], pa.binary())})

    return rows.mapInArrow(pack, "dim int, n int, ids binary, body binary")


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
               query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query among all other vectors.

    Queries and vectors are compared within equal dimensions. A query with fewer than k others returns all of them.
    Repeated ids count as the same row when a query's own row is left out; extra columns are ignored; an empty side
    gives an empty result. Scores are exact while squared components times the dimension stay below 2^53.
    """
    spark = vectors.sparkSession
    data = quantised(vectors, id_col, vec_col)
    asked = quantised(queries, id_col, vec_col)
    where = scratch(spark, "topk")
    # vectors are packed where they are read; the queries, a stated subset, are gathered into few full blocks
    d = _blocks(data, data_block).withColumn("block", F.monotonically_increasing_id())
    q = _blocks(asked.repartition(max(1, -(-asked.count() // query_block))), query_block)
    d.write.parquet(f"{where}/data")
    q.write.parquet(f"{where}/queries")
    d, q = spark.read.parquet(f"{where}/data"), spark.read.parquet(f"{where}/queries")
    deals = d.select("dim", "block").join(q.withColumnsRenamed({"ids": "q_ids", "body": "q_body", "n": "q_n"}), "dim")
    pairs = deals.join(d.select("block", "n", "ids", "body"), "block")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                qi, xi = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.ids, np.int64)
                qv = np.frombuffer(r.q_body, np.int64).reshape(len(qi), r.dim)
                xv = np.frombuffer(r.body, np.int64).reshape(len(xi), r.dim)
                got, score, _ = dual_search(qv, qi, xv, xi, k)
                ok = np.isfinite(score)
                yield pd.DataFrame({"query_id": np.repeat(qi, k)[ok.ravel()], "vec_id": got[ok],
                                    "score": score[ok].astype(np.int64)})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    best = pairs.mapInPandas(search, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
