"""Exact centroid clustering with Shallot search.

Every vector remembers its centroid, the second-nearest one, an upper bound on its distance to the first and a lower
bound on that to all others. Centroids move between rounds, and the bounds move with them. While the upper bound lies
strictly below the lower one, or below half the way to the next centroid, nothing is computed. Otherwise both remembered
centroids are measured, the scan starts from the closer one and goes through its neighbours in order of their distance
to it. A neighbour can only matter within the sum of the distances to the start and to the second-best so far, so the
ball shrinks as the scan goes on. Bounds are floating point and widened by more than their rounding; whatever survives
them is compared by exact integer squares, ties going to the smaller number.

Vectors travel from round to round with their bounds, on the disks of the executors and without a shuffle; a lost
executor's part is computed again from the source. Centroid sums are kept as exact integers and only corrected by the
vectors that changed their centroid: one row per centroid and task reaches the aggregation, k x dimension numbers the driver.

Vectors take part if they have the wanted number of components, none null or non-finite, and none whose integer
exceeds 2^27 in size (their squared distances need not fit a long). Repeated rows and ids all count. A null id never
starts a centroid but is clustered; equal ids start in order of their components. Fewer vectors than centroids give
fewer centroids, an empty table no rows. Other columns have no influence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import kept

#: Largest size of an integer component.
LARGEST = 1 << 27
#: Relative allowance for the rounding of bounds, far above that of a sum or root of doubles.
SLACK = 1e-9
STATE = "vec_id long, v array<int>, was int, near int, second int, upper double, lower double"


def integers(vectors: DataFrame, dim: int, scale: int, column: str = "embedding") -> DataFrame:
    """(vec_id, v array<int>) of the vectors that take part: floor(scale * component)."""
    x = F.transform(F.col(column), lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    # compared before they become integers; NaN is larger than all numbers
    usable = F.forall(F.col(column), lambda c: c.isNotNull() & (c.cast("double") * F.lit(float(scale))).between(
        F.lit(-float(LARGEST)), F.lit(float(LARGEST))))
    return vectors.where((F.size(column) == dim) & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<int>").alias("v"))


def first_centroids(points: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of smallest sha256 of salt and id, in that order."""
    h = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = points.where(F.col("vec_id").isNotNull()).select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


@dataclass
class Geometry:
    """Centroids of a round, what they moved by since the last one, and how they lie to each other."""

    c: np.ndarray
    moved: np.ndarray
    order: np.ndarray
    apart: np.ndarray
    half: np.ndarray

    @classmethod
    def of(cls, c: np.ndarray, old: np.ndarray | None = None) -> Geometry:
        k = len(c)
        d = np.array([[(int(((x - y) ** 2).sum())) for y in c] for x in c], np.float64).reshape(k, k)
        apart = np.sqrt(d) * (1 - SLACK)
        order = np.array([[j for j in np.lexsort((np.arange(k), row)) if j != i] for i, row in enumerate(d)], np.int64).reshape(k, k - 1)
        half = np.array([row[order[i]].min() / 2 if k > 1 else np.inf for i, row in enumerate(apart)])
        moved = np.zeros(k) if old is None else np.sqrt(((c - old) ** 2).sum(1).astype(np.float64)) * (1 + SLACK)
        return cls(c, moved, order, apart, half)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x - c) ** 2).sum(1)


def assign(x: np.ndarray, g: Geometry, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """near, second, upper and lower for the centroids of g, and how many distances were measured.

    near is -1 where nothing is known yet; the scan then starts from centroid 0.
    """
    n, k = len(x), len(g.c)
    near, second, upper, lower = near.copy(), second.copy(), upper.copy(), lower.copy()
    if k == 1:
        return np.zeros(n, np.int64), np.full(n, -1), np.full(n, np.inf), np.full(n, np.inf), 0
    fresh = near < 0
    near[fresh], second[fresh], upper[fresh], lower[fresh] = 0, g.order[0, 0], np.inf, 0
    most = np.full(k, g.moved.max())  # the others of a centroid moved by at most this
    top = int(g.moved.argmax())
    most[top] = np.delete(g.moved, top).max()
    upper = (upper + g.moved[near]) * (1 + SLACK)
    lower = np.maximum(lower - most[near], 0) * (1 - SLACK)
    rows = np.flatnonzero(upper >= np.maximum(lower, g.half[near]))
    if not len(rows):
        return near, second, upper, lower, 0
    own = squared(x[rows], g.c[near[rows]])
    measured = len(rows)
    upper[rows] = np.sqrt(own.astype(np.float64)) * (1 + SLACK)
    still = upper[rows] >= np.maximum(lower[rows], g.half[near[rows]])
    rows, own = rows[still], own[still]
    other = squared(x[rows], g.c[second[rows]])
    measured += len(rows)
    # the closer of the two leads; of equal ones the smaller number
    swap = (other < own) | ((other == own) & (second[rows] < near[rows]))
    a = np.where(swap, second[rows], near[rows])
    b = np.where(swap, near[rows], second[rows])
    da, db = np.where(swap, other, own), np.where(swap, own, other)
    start, begin = a.copy(), np.sqrt(da.astype(np.float64)) * (1 + SLACK)
    seen = b.copy()
    for s in range(k):
        mine = np.flatnonzero(start == s)
        for j in g.order[s]:
            if not len(mine):
                break
            reach = begin[mine] + np.sqrt(db[mine].astype(np.float64)) * (1 + SLACK)
            mine = mine[g.apart[s, j] <= reach]  # neighbours only get farther and the ball smaller: these rows are done
            ask = mine[seen[mine] != j]
            if not len(ask):
                continue
            d = squared(x[rows[ask]], g.c[j])
            measured += len(ask)
            first = (d < da[ask]) | ((d == da[ask]) & (j < a[ask]))
            then = ~first & ((d < db[ask]) | ((d == db[ask]) & (j < b[ask])))
            up, to = ask[first], ask[then]
            a[up], b[up], da[up], db[up] = j, a[up], d[first], da[up]
            b[to], db[to] = j, d[then]
    near[rows], second[rows] = a, b
    upper[rows] = np.sqrt(da.astype(np.float64)) * (1 + SLACK)
    lower[rows] = np.sqrt(db.astype(np.float64)) * (1 - SLACK)
    return near, second, upper, lower, measured


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(col), dim)


def _round(state: DataFrame, g: Geometry, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            was, second, upper, lower = (b.column(c).to_numpy() for c in ("near", "second", "upper", "lower"))
            near, second, upper, lower, _ = assign(_matrix(b.column("v"), dim), g, was.astype(np.int64), second.astype(np.int64), upper, lower)
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id"), b.column("v"), pa.array(was), pa.array(near.astype(np.int32)),
                pa.array(second.astype(np.int32)), pa.array(upper), pa.array(lower)], names=b.schema.names)

    return state.mapInArrow(run, STATE)


def _moves(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed add to every centroid's count and sums (negative where they left), as Python integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            x = _matrix(b.column("v"), dim)
            for column, sign in (("near", 1), ("was", -1)):
                to = b.column(column).to_numpy()
                for j in np.unique(to[to >= 0]):
                    count[j] += sign * int((to == j).sum())
                    total[j] += sign * x[to == j].sum(0)
        some = np.flatnonzero(count.astype(bool) | total.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["c", "n", "total"])

    parts = state.where(F.col("near") != F.col("was")).select("v", "was", "near").mapInArrow(run, "c int, n long, total array<long>")
    # position 0 is the count; sums of exact integers of any size
    sums = parts.select("c", F.posexplode(F.concat(F.array("n"), "total")).alias("at", "x")).groupBy("c", "at").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out = np.zeros((k, dim + 1), object)
    for r in sums:
        out[r.c, r.at] = int(r.x)
    return out[:, 0], out[:, 1:]


def _measured(state: DataFrame, c: np.ndarray, dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = b.column("near")
            d = squared(_matrix(b.column("v"), dim), c[near.to_numpy()])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), near, pa.array(d)], ["vec_id", "cluster", "distance"])

    return state.select("vec_id", "v", "near").mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, salt: str = "3:",
              column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster int, distance long) of every vector that takes part, and the final centroids.

    A round in which no centroid moves ends the work early: all later ones would be the same.
    """
    spark = vectors.sparkSession
    points = integers(vectors, dim, scale, column)
    c = first_centroids(points, k, salt)
    if not len(c):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dim), np.int64)
    k = len(c)
    state = points.select("vec_id", "v", *[F.lit(-1).alias(n) for n in ("was", "near", "second")],
                          F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    count, total = np.zeros(k, object), np.zeros((k, dim), object)
    old = before = None
    for _ in range(rounds):
        state = _round(state, Geometry.of(c, old), dim).persist(StorageLevel.DISK_ONLY)
        n, x = _moves(state, k, dim)  # fills the stored state too
        if before is not None:
            before.unpersist()
        before = state
        count, total = count + n, total + x
        old, c = c, np.array([[t // n for t in row] if n else was for n, row, was in zip(count, total, c, strict=True)], np.int64)
        if (old == c).all():
            break
    # kept as a table: nothing stays in the executors' storage
    out = kept(_measured(_round(state, Geometry.of(c, old), dim), c, dim), "clusters")
    if before is not None:
        before.unpersist()
    return out, c


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """assigned with cluster_inertia, inertia (sums of distance over its cluster and over all) and centroid_sha256.

    The sums, a row per cluster, pass through the driver and are broadcast.
    """
    sums = dict(assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    total = int(sum(sums.values()))
    rows = [(i, int(sums[i]), total, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
            for i, c in enumerate(centroids) if i in sums]
    each = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
