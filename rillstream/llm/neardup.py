"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is the set of hashes of its five-word shingles. Coordinate k of the signature is the smallest value of
pi(sigma(s) + k * STEP) over the set: sigma scatters the shingles once, and the one permutation pi of the 64-bit ring
is used circularly shifted, k steps for coordinate k. Documents with equal sets form one class; only class
representatives are banded. In each bucket the members are compared with the smallest one first. Of buckets that still
hold several components, members drop out of which too few shingles occur in any other such member: a link needs three
quarters of them, so none is lost. Those left are compared with the most typical member of their bucket, and only then
are pairs compared that are still in different components; a group of copies costs its size, not its square.
Candidates are confirmed on whole sets.

With 40 bands of 5 a pair at similarity 0.75 escapes with probability (1 - 0.75^5)^40 = 2e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .flat import Words, chunks, flat, map_arrow, mix, segments, signed, words
from .tables import kept

SHINGLE, BANDS, ROWS = 5, 40, 5
SIMILARITY_PERCENT = 75
STEP = np.uint64(0xD1342543DE82EF95)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def shingles(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all documents, ordered by document, and the places where documents begin.

    A document with fewer words has its whole sequence as its one shingle, without words it has none.
    """
    def chain(h: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
        x = np.full(len(start), length, np.uint64)
        for k in range(length):
            x = mix(x * _MULTIPLY + h[start + k])
        return x

    n = len(w.first) - 1
    counts = w.counts
    at = np.arange(len(w.hash))
    full = at[at + size <= w.first[1:][w.doc]]
    parts, docs = [chain(w.hash, full, size)], [w.doc[full]]
    for length in range(1, size):
        short = np.flatnonzero(counts == length)
        if len(short):
            parts.append(chain(w.hash, w.first[short], length))
            docs.append(short)
    h, d = np.concatenate(parts), np.concatenate(docs)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.searchsorted(d[new], np.arange(n + 1))


def signatures(s: np.ndarray, first: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Band hashes (documents with a shingle x bands)."""
    _, start = segments(first)
    out = np.empty((len(start), bands), np.uint64)
    if not len(start):
        return out
    sigma = mix(s ^ _MULTIPLY)
    for b in range(bands):
        x = np.full(len(start), b + 1, np.uint64)
        for r in range(rows):
            shifted = sigma + np.uint64((b * rows + r) * int(STEP) & (1 << 64) - 1)
            x = mix(x + np.minimum.reduceat(mix(shifted), start))
        out[:, b] = x
    return out


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(signed(values)))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): the size and a 128-bit name of the set, and its band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            s, first = shingles(words(flat(b.column("text"))))
            full, start = segments(first)
            names = np.zeros((2, b.num_rows), np.uint64)
            if len(full):
                names[0, full] = np.add.reduceat(mix(s ^ np.uint64(0xA5A5)), start)
                names[1, full] = np.add.reduceat(mix(s + np.uint64(0x5A5A5A5A5A)), start)
            bands = signatures(s, first)
            ends = np.zeros(b.num_rows + 1, np.int64)
            ends[1:] = np.cumsum(np.diff(first) > 0) * BANDS
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(first)), pa.array(signed(names[0])), pa.array(signed(names[1])),
                 _lists(bands.ravel(), ends)], ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return map_arrow(_plain(docs), run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, s): the distinct shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            s, first = shingles(words(flat(b.column("text"))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), _lists(s, first)], ["doc_id", "s"])

    return map_arrow(_plain(docs), run, "doc_id long, s array<long>")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _common(pairs: DataFrame, have: DataFrame) -> DataFrame:
    """(a, b, common, united) of pairs (a, b): sizes of the intersection and the union of their sets."""
    left = have.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    right = have.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("common"), (
        F.size("sa") + F.size("sb") - both).alias("united"))


def _linked(pairs: DataFrame, have: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    return _common(pairs, have).where(100 * F.col("common") >= percent * F.col("united")).select("a", "b")


def _open(members: DataFrame, united: DataFrame, size: int) -> DataFrame:
    """(band, rep, component) of buckets that hold more than one component."""
    placed = kept(members.select("band", "rep").join(united.withColumnRenamed("id", "rep"), "rep", "left").select(
        "band", "rep", F.coalesce("component", "rep").alias("component")), "placed", size)
    several = kept(placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .where(F.col("lo") != F.col("hi")).select("band"), "several", size)
    return placed.join(several, "band")


def _shares(ids: DataFrame, have: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, shared, typical) of documents of which enough shingles occur in another one of ids.

    A link says shared >= percent of united >= percent of the document's own n. typical sums how often they occur.
    """
    own = have.join(ids, "doc_id", "left_semi").select("doc_id", F.size("s").alias("n"), F.explode("s").alias("shingle"))
    often = kept(own.groupBy("shingle").agg(F.count("*").alias("times")).where(F.col("times") > 1), "often")
    return own.join(often, "shingle").groupBy("doc_id", "n").agg(
        F.count("*").alias("shared"), F.sum("times").alias("typical")).where(
        100 * F.col("shared") >= percent * F.col("n")).select("doc_id", "n", "shared", "typical")


def near_duplicates(docs: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per document.

    Documents with 100 * shared >= percent * united distinct shingles are linked; component_id is the smallest doc_id
    that links reach, and kept says whether it is the document's own. Null and empty texts have no shingle and no link.
    A row with null doc_id has no component and is kept. Rows that repeat a doc_id each follow their own text. Extra
    columns are ignored.
    """
    found = kept(features(docs), "features")
    known = found.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    key = ["set_a", "set_b", "n_shingles"]
    classes = kept(known.groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    reps = known.select(F.col("doc_id").alias("rep"), "bands").join(classes.select("rep"), "rep", "left_semi")
    banded = reps.select("rep", F.explode("bands").alias("band"))
    shared = kept(banded.groupBy("band").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
                  .where(F.col("leader") != F.col("last")).select("band", "leader"), "buckets")
    members = kept(banded.join(shared, "band").select("band", "rep", "leader"), "members")
    asked = members.select(F.col("rep").alias("doc_id")).distinct()
    have = kept(sets(docs.join(asked, "doc_id", "left_semi")), "sets")

    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    first = members.where(F.col("rep") != F.col("leader")).select(*pair("rep", "leader")).distinct()
    edges = kept(_linked(first, have, percent), "links")
    size = members.count()
    # the smallest leader that a member is linked with stands for its component here: finer, so no pair is missed
    led = kept(edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component")), "led", size)
    open_ = kept(_open(members, led, size), "open", size)
    share = kept(_shares(open_.select(F.col("rep").alias("doc_id")).distinct(), have, percent), "shares")
    open_ = kept(open_.join(share.withColumnRenamed("doc_id", "rep"), "rep"), "open", size)
    typical = kept(open_.groupBy("band").agg(F.max(F.struct("typical", "rep"))["rep"].alias("pivot")), "pivots", size)
    near = kept(_common(open_.join(typical, "band").where(F.col("rep") != F.col("pivot")).select(
        F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct(), have), "near")
    edges = kept(edges.unionByName(near.where(100 * F.col("common") >= percent * F.col("united")).select("a", "b")), "links")
    united = kept(components(edges), "united")
    left = _open(open_.select("band", "rep"), united, size).join(typical, "band").join(
        near.select(F.col("a").alias("rep"), F.col("b").alias("pivot"), "common"), ["rep", "pivot"], "left").join(
        share.select(F.col("doc_id").alias("rep"), "n", "shared"), "rep").join(
        known.select(F.col("doc_id").alias("rep"), "bands"), "rep").select(
        "band", "rep", "component", "n", "shared", F.coalesce("common", "n").alias("common"), "bands")
    left = kept(left, "left")
    x, y = (left.select("band", *(F.col(c).alias(c + k) for c in left.columns if c != "band")) for k in "xy")
    # What two documents have in common lies in the typical one, at most as much as either has of it, or outside, at
    # most as much as either has of shingles that occur elsewhere. A pair is looked at in one of its buckets.
    most = F.least("commonx", "commony") + F.least(F.col("sharedx") - F.col("commonx"), F.col("sharedy") - F.col("commony"))
    rest = x.join(y, "band").where(
        (F.col("componentx") < F.col("componenty")) & ((100 + percent) * most >= percent * (F.col("nx") + F.col("ny")))
        & (F.array_min(F.array_intersect("bandsx", "bandsy")) == F.col("band"))).select(*pair("repx", "repy")).distinct()
    joined = kept(components(edges.unionByName(_linked(rest, have, percent))), "united")

    by_class = kept(classes.join(joined.withColumnRenamed("id", "rep"), "rep", "left").select(
        *key, F.coalesce("component", "rep").alias("class_component")), "by-class")
    named = found.select("doc_id", *key).join(by_class, key, "left")
    component = F.when((F.col("n_shingles") > 0), F.col("class_component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
