"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics of whole texts are computed with numpy in Arrow batches. Class means and covariances come from sums that
Spark aggregates over all labelled training rows (p + p^2 numbers per class reach the driver). Covariances are shrunk
towards their diagonal and the pooled covariance; a score is the logistic of the Mahalanobis and log-determinant
difference plus the log prior ratio, with Cholesky factors computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import Flat, chunks, flat, map_arrow, sums_by, words

STATS = [
    "log_bytes", "log_words", "mean_word", "sd_word", "letters", "upper", "digits", "symbols", "bangs", "bars",
    "spaces", "high", "long_words", "distinct", "top_word", "line_length", "repeated_pairs", "caps_words",
]
#: Weight of the pooled covariance, and of the diagonal, in each class covariance.
POOLED, DIAGONAL, RIDGE = 0.1, 0.1, 1e-3
THRESHOLD = 0.3
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[ord(c) for c in "#$%&*@^~<>{}[]\\=_+/"]] = 4
_CLASS[ord("!")] = 5
_CLASS[ord("|")] = 6
_CLASS[[0x20, *range(9, 14)]] = 7
_CLASS[128:] = 8


def statistics(f: Flat) -> np.ndarray:
    """A row of STATS for each document; an empty document has zeros throughout."""
    n = f.n
    size = f.lengths.astype(np.float64)
    kinds = _CLASS[f.data]
    share = {k: sums_by((kinds == k).astype(np.int64), f.off) / np.maximum(size, 1) for k in range(1, 9)}
    w = words(f, lower=True)
    count = w.counts.astype(np.float64)
    safe = np.maximum(count, 1)
    length = (w.end - w.start).astype(np.float64)
    mean = sums_by(length, w.first) / safe
    sd = np.sqrt(np.maximum(sums_by(length ** 2, w.first) / safe - mean ** 2, 0))
    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(h)))
    run_doc = d[new]
    distinct = np.bincount(run_doc, minlength=n)[:n]
    top = np.zeros(n)
    np.maximum.at(top, run_doc, runs)
    pair = w.hash[:-1] * np.uint64(3) + w.hash[1:]
    same = w.doc[:-1] == w.doc[1:]
    pair, pd_ = pair[same], w.doc[:-1][same]
    order = np.lexsort((pair, pd_))
    pair, pd_ = pair[order], pd_[order]
    rep = np.zeros(len(pair), bool)
    rep[1:] = (pair[1:] == pair[:-1]) & (pd_[1:] == pd_[:-1])
    repeated = np.bincount(pd_[rep], minlength=n)[:n]
    lines = sums_by((f.data == 10).astype(np.int64), f.off) + 1
    prefix = np.zeros(len(f.data) + 1, np.int64)
    np.cumsum(kinds == 2, out=prefix[1:])
    caps = sums_by(((prefix[w.end] - prefix[w.start]) * 2 > length).astype(np.int64) * (length > 1), w.first)
    return np.column_stack([
        np.log1p(size), np.log1p(count), np.log1p(mean), np.log1p(sd), share[1], np.sqrt(share[2]), np.sqrt(share[3]),
        np.sqrt(share[4]), np.sqrt(share[5]), np.sqrt(share[6]), share[7], share[8],
        np.sqrt(sums_by((length > 14).astype(np.int64), w.first) / safe), np.log1p(distinct) - np.log1p(count),
        np.sqrt(top / safe), np.log1p(size / lines), np.sqrt(repeated / safe), np.sqrt(caps / safe),
    ]) * (size > 0)[:, None]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) with x the statistics of text; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            x = statistics(flat(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.FixedSizeListArray.from_arrays(x.ravel(), x.shape[1]).cast(pa.list_(pa.float64()))],
                ["doc_id", "x"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     run, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Two Gaussian classes with cached Cholesky factors; without both classes, the score is the known share of 1."""

    prior: float
    centre: np.ndarray | None = None
    factor: np.ndarray | None = None  # inverse Cholesky factors
    logdet: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.centre is None:
            return np.full(len(x), self.prior)
        z = [((x - self.centre[k]) @ self.factor[k].T) for k in (0, 1)]
        dist = [(v ** 2).sum(1) + self.logdet[k] for k, v in enumerate(z)]
        margin = 0.5 * (dist[0] - dist[1]) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit(x: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """From all rows of x (doc_id, x) that have a label 0 or 1. A doc_id labelled more than once has its mean label,
    1 from one half on; null ids and labels are left out."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(
        (F.avg(label) >= 0.5).cast("int").alias("y"))
    p = len(STATS)
    rows = x.join(marks, "doc_id")
    one = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(p)]
    two = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"q{i}_{j}") for i in range(p) for j in range(i, p)]
    got = {r["y"]: r for r in rows.groupBy("y").agg(F.count("*").alias("n"), *one, *two).collect()}
    total = sum(r["n"] for r in got.values())
    if len(got) < 2:
        return Discriminant(prior=(got[1]["n"] / total if 1 in got else 0.0) if total else 0.5)
    means, covs, ns = [], [], []
    for y in (0, 1):
        r = got[y]
        n, s = r["n"], np.array([r[f"s{i}"] for i in range(p)])
        q = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        m = s / n
        means.append(m)
        covs.append(q / n - np.outer(m, m))
        ns.append(n)
    pooled = (covs[0] * ns[0] + covs[1] * ns[1]) / total
    factors, dets = [], []
    for c in covs:
        c = (1 - POOLED - DIAGONAL) * c + POOLED * pooled + DIAGONAL * np.diag(np.diag(c)) + RIDGE * np.eye(p)
        lower = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(lower))
        dets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(ns[1] / total, np.array(means), np.array(factors), np.array(dets))


def accepted(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose text scores at least ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            yield b.filter(pa.array(model.score(statistics(flat(b.column("text")))) >= threshold))

    return map_arrow(docs, run, docs.schema)


def scored_statistics(x: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) from statistics that were computed before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("x")
            values = col.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(STATS))
            s = model.score(values)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return x.mapInArrow(run, "doc_id long, score double, predicted int")
