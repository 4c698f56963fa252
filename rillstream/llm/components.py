"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import kept


def _large_star(e: DataFrame, n: int) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = kept(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least", 2 * n)
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame, n: int) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = kept(down.groupBy("a").agg(F.min("b").alias("m")), "least", 2 * n)
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of edges (a, b): component is the smallest id that can be reached.

    Each round is two joins on ids; edges only shrink towards stars around the smallest ids, in a logarithmic number of
    rounds. Loops and repeated edges are harmless; no edges give no rows.
    """
    clean = lambda e: e.where(F.col("a") != F.col("b")).distinct()
    e, before = kept(clean(edges.select("a", "b")), "edges"), None
    n = e.count()
    while n:
        e = kept(clean(_small_star(kept(clean(_large_star(e, n)), "edges", 2 * n), 2 * n)), "edges", 2 * n)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
