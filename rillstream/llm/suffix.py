"""Removing repeated byte strings with a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller doc_id. Three steps:

1. Every string of LENGTH bytes holds one anchor, the k-gram of smallest hash in it (the leftmost of equals), so equal
   strings have equal anchors at equal places. Anchors and names of their contexts (all strings they stand for) are
   dealt into buckets by hash. Where the same context occurs in a smaller document, all its strings are repeats.
2. Contexts that differ although they share an anchor are sorted as suffixes: a merge sort whose comparisons find the
   common extension of two suffixes by binary search over prefix polynomial hashes. Neighbours that agree on LENGTH
   bytes are compared byte by byte; if a hash ever lied, the list is sorted again by its bytes.
3. The ranges found return to their documents.

Texts move once, keyed by row, and that exchange serves steps 2 and 3. Between steps only anchors and contexts move.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import Flat, Prefixes, chunks, flat, map_arrow, mix, signed

LENGTH, GRAM = 50, 24
#: Bytes of text whose anchors make up one bucket, anchors held before a task deals them out, and anchors in a row.
BUCKET_BYTES, HELD, BLOB = 2 << 20, 2_000_000, 4096
#: Suffixes that are sorted at once, and contexts of one anchor that are sorted together.
BLOCK = 400_000
#: An anchor with more different contexts is resolved string by string.
CROWD = 1000
SORT, REPEAT, CROWDED = (np.uint64(k) for k in (0, 1, 2))
_BLOCK_WINDOWS = 1 << 20


def anchors(f: Flat) -> tuple[np.ndarray, ...]:
    """(document, place, first and last string, anchor hash, context name) of every anchor; names have 48 bits."""
    n = len(f.data)
    empty = tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if n < LENGTH:
        return empty
    pre = Prefixes(f.data)
    grams = mix((pre.sums[GRAM:] - pre.sums[:-GRAM]) * pre.down[:n - GRAM + 1])
    width = LENGTH - GRAM + 1
    valid = np.zeros(n + 1, np.int32)
    long = f.lengths >= LENGTH
    np.add.at(valid, f.off[:-1][long], 1)
    np.add.at(valid, f.off[1:][long] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[:n]))
    if not len(starts):
        return empty
    places = np.empty(n - LENGTH + 1, np.int64)
    low = np.uint64((1 << 21) - 1)
    for at in range(0, len(places), _BLOCK_WINDOWS):
        g = grams[at:at + _BLOCK_WINDOWS + width - 1]
        v = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            v = np.minimum(v[:-span], v[span:])
            span *= 2
        rest = width - span
        if rest:
            v = np.minimum(v[:-rest], v[rest:])
        places[at:at + len(v)] = (v & low).astype(np.int64) + at
    own = places[starts]
    new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    last = np.append(new[1:], len(starts)) - 1
    place, lo, hi = own[new], starts[new], starts[last]
    name = mix(pre.sub(lo, hi + LENGTH) + (place - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return f.doc_of(place), place, lo, hi, grams[place] >> np.uint64(16), name >> np.uint64(16)


def _key(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One 64-bit name of an anchor with its context, the two lowest bits free for SORT, REPEAT or CROWDED."""
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + mix(c)) & ~np.uint64(3)


def _dealt(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Anchors by bucket, packed: five bytes of hash (the bucket holds the rest), six of context; ids by runs."""
    held: list[tuple] = []
    n = 0

    def deal() -> Iterator[pa.RecordBatch]:
        h, c, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        bucket = (h % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        h, c, ids, bucket = h[order] // np.uint64(buckets), c[order], ids[order], bucket[order]
        edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        out: list[tuple] = []
        for a, b in zip(edge, np.append(edge[1:], len(h)), strict=True):
            for at in range(a, b, BLOB):
                part = slice(at, min(at + BLOB, b))
                own = ids[part]
                run = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                steps = np.diff(own[run], prepend=0)
                out.append((int(bucket[at]), _bytes_of(h[part], 5), _bytes_of(c[part], 6), zlib.compress(steps.tobytes(), 1),
                            zlib.compress(np.diff(np.append(run, len(own))).astype(np.uint16).tobytes(), 1)))
                if len(out) == 128:
                    yield _blobs(out)
                    out = []
        if out:
            yield _blobs(out)

    for b in chunks(batches):
        f = flat(b.column("text"))
        doc, _, _, _, h, c = anchors(f)
        if len(h):
            new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (doc[1:] != doc[:-1]))  # periodic texts
            held.append((h[new], c[new], b.column("doc_id").to_numpy()[doc[new]]))
            n += len(held[-1][0])
        if n >= HELD:
            yield from deal()
            held, n = [], 0
    if n:
        yield from deal()


def _bytes_of(x: np.ndarray, size: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _numbers(raw: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] + [pa.binary()] * 4, strict=True)],
        ["bucket", "h", "c", "steps", "runs"])


def _answered(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, key) of anchors whose context is repeated or has to be compared with others."""
    held: list[tuple] = []
    bucket = None

    def answer() -> Iterator[pa.RecordBatch]:
        h, c, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((ids, c, h))
        h, c, ids = h[order], c[order], ids[order]
        new_h = np.append(True, h[1:] != h[:-1])
        new_c = new_h | np.append(True, c[1:] != c[:-1])
        group = np.cumsum(new_h) - 1
        first = np.flatnonzero(new_h)
        shared = (np.maximum.reduceat(ids, first) != np.minimum.reduceat(ids, first))[group]
        different = np.add.reduceat(new_c.astype(np.int64), first)[group]
        several = different > 1
        least = ids[np.flatnonzero(new_c)][np.cumsum(new_c) - 1]
        repeat = shared & (ids > least)
        to_sort = shared & several & (ids == least)
        pick = (repeat | to_sort) & (new_c | np.append(True, ids[1:] != ids[:-1]))
        key = _key(h[pick], c[pick]) | np.where(repeat, REPEAT, np.where(different > CROWD, CROWDED, SORT))[pick]
        for at in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[pick][at:at + 100_000]), pa.array(signed(key[at:at + 100_000]))], ["doc_id", "key"])

    for b in batches:
        for r in b.to_pylist():
            if r["bucket"] != bucket and held:
                yield from answer()
                held = []
            bucket = r["bucket"]
            ids = np.repeat(np.cumsum(np.frombuffer(zlib.decompress(r["steps"]), np.int64)),
                            np.frombuffer(zlib.decompress(r["runs"]), np.uint16))
            held.append((_numbers(r["h"], 5) * np.uint64(buckets) + np.uint64(bucket), _numbers(r["c"], 6), ids))
    if held:
        yield from answer()


FOUND = "rid long, lo long, hi long, h long, doc_id long, rel int, context binary"
_FOUND = pa.schema([("rid", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("h", pa.int64()),
                    ("doc_id", pa.int64()), ("rel", pa.int32()), ("context", pa.binary())])


def _runs(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges, ordered by row and start, united where they touch."""
    if not len(row):
        return row, lo, hi
    top = hi + row * (1 << 40)
    np.maximum.accumulate(top, out=top)
    new = np.append(True, (lo + row * (1 << 40))[1:] > top[:-1])
    at = np.flatnonzero(new)
    return row[at], lo[at], np.maximum.reduceat(hi, at)


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with keys: ranges that are repeats, and contexts to sort."""
    for b in chunks(b.filter(pa.compute.is_valid(b.column("keys"))) for b in batches):
        f = flat(b.column("text"))
        keys = b.column("keys")
        off = keys.offsets.to_numpy()
        own = keys.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].view(np.uint64)
        own_doc = np.repeat(np.arange(b.num_rows), np.diff(off)).astype(np.uint64)
        salt = np.uint64(0xD1342543DE82EF95)
        named = mix((own & ~np.uint64(3)) + own_doc * salt)
        order = np.argsort(named)
        named, kind = named[order], (own & np.uint64(3))[order]
        doc, place, lo, hi, h, c = anchors(f)
        if not len(h) or not len(named):
            continue
        want = mix(_key(h, c) + doc.astype(np.uint64) * salt)
        i = np.minimum(np.searchsorted(named, want), len(named) - 1)
        hit = named[i] == want
        rids, ids = b.column("rid").to_numpy(), b.column("doc_id").to_numpy()
        full = np.flatnonzero(hit & (kind[i] == REPEAT))
        many = np.flatnonzero(hit & (kind[i] == CROWDED))
        gone, rest, names = _crowded(f, ids, doc[many], lo[many], hi[many])
        row, a = np.concatenate([doc[full], doc[many][gone[0]]]), np.concatenate([lo[full], gone[1]])
        z = np.concatenate([hi[full], gone[1]]) + LENGTH
        order = np.lexsort((a, row))
        row, a, z = _runs(row[order], a[order], z[order])
        none = pa.nulls(len(row), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rids[row]), pa.array(a - f.off[row]), pa.array(z - f.off[row]),
             pa.array(signed(mix(rids[row].view(np.uint64)))), pa.array(ids[row]), pa.nulls(len(row), pa.int32()), none],
            schema=_FOUND)
        part = np.flatnonzero(hit & (kind[i] == SORT))
        if len(part) or len(names):
            a, z = np.concatenate([lo[part], rest[1]]), np.concatenate([hi[part], rest[1]]) + LENGTH
            row = np.concatenate([doc[part], doc[many][rest[0]]])
            rel = np.concatenate([place[part] - lo[part], np.zeros(len(names), np.int64)])
            ends = np.cumsum(z - a)
            body = f.data[np.arange(ends[-1]) + np.repeat(a - (ends - (z - a)), z - a)]
            context = pa.Array.from_buffers(pa.binary(), len(row), [
                None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(body)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids[row]), pa.array(a - f.off[row]), pa.nulls(len(row), pa.int64()),
                 pa.array(signed(np.concatenate([h[part], names]))), pa.array(ids[row]),
                 pa.array(rel.astype(np.int32)), context], schema=_FOUND)


def _crowded(f: Flat, ids: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Strings of crowded anchors one by one, each its own group: (anchor, start) of those that a smaller document of
    this batch has too, (anchor, start) of the others, and the groups of the others. So a string that very many
    documents share reaches its group once per batch."""
    n = hi - lo + 1
    owner = np.repeat(np.arange(len(n)), n)
    start = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(len(owner))
    name = mix(Prefixes(f.data).sub(start, start + LENGTH)) if len(owner) else np.zeros(0, np.uint64)
    order = np.lexsort((ids[doc[owner]], name))
    owner, start, name = owner[order], start[order], name[order]
    new = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
    first = np.repeat(new, np.diff(np.append(new, len(name))))
    gone = ids[doc[owner]] > ids[doc[owner[first]]]
    at = np.flatnonzero(gone)
    for k in range(LENGTH):  # a collision of hashes is no repeat
        gone[at] &= f.data[start[at] + k] == f.data[start[first[at]] + k]
    return (owner[gone], start[gone]), (owner[~gone], start[~gone]), name[~gone]


class Suffixes:
    """Suffixes of a byte array, compared on LENGTH bytes by prefix hashes."""

    def __init__(self, data: np.ndarray, length: int = LENGTH):
        self.data, self.length = data, length
        self.hashes = Prefixes(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension, at most ``length``, by binary search."""
        got = np.zeros(len(a), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            x, y = a + got, b + got
            fits = got + step <= self.length
            x, y = np.where(fits, x, 0), np.where(fits, y, 0)
            same = fits & (self.hashes.sub(x, x + step * fits) == self.hashes.sub(y, y + step * fits))
            got += step * same
            step >>= 1
        return got

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        k = self.common(a, b)
        equal = k >= self.length
        k = np.minimum(k, self.length - 1)
        return np.where(equal, or_equal, self.data[a + k] < self.data[b + k])

    def sort(self, start: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """A stable merge sort of every list (equal, adjacent values of ``lists``) at once; returns the order."""
        n = len(start)
        order = np.arange(n)
        if not n:
            return order
        head = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
        size = np.diff(np.append(head, n))
        begin, end = np.repeat(head, size), np.repeat(head + size, size)
        width = 1
        while width < size.max():
            place = np.flatnonzero(end - begin > width)
            mine = (place - begin[place]) // width
            run = begin[place] + mine * width
            right = (mine & 1).astype(bool)
            other = np.where(right, run - width, run + width)
            stop = np.minimum(other + width, end[place])
            lo, hi = np.minimum(other, end[place]), np.maximum(stop, np.minimum(other, end[place]))
            base = lo.copy()
            own = start[order[place]]
            live = np.flatnonzero(lo < hi)
            while len(live):
                mid = (lo[live] + hi[live]) >> 1
                # an element of the right run goes behind its equals in the left one
                before = self.less(start[order[mid]], own[live], right[live])
                lo[live] = np.where(before, mid + 1, lo[live])
                hi[live] = np.where(before, hi[live], mid)
                live = live[lo[live] < hi[live]]
            to = np.where(right, run - width, run) + (place - run) + (lo - base)
            merged = order.copy()
            merged[to] = order[place]
            order = merged
            width *= 2
        return order

    def equal_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for k in range(self.length):
            out &= self.data[a + k] == self.data[b + k]
        return out


def repeated(data: np.ndarray, start: np.ndarray, lists: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a suffix agrees on LENGTH bytes with one of the same list and a smaller id."""
    out = np.zeros(len(start), bool)
    by_list = np.lexsort((ids, lists))
    s = Suffixes(data)
    order = by_list[s.sort(start[by_list], lists[by_list])]
    a, b = order[:-1], order[1:]
    beside = lists[a] == lists[b]
    same = np.zeros(len(a), bool)
    at = np.flatnonzero(beside)
    same[at] = s.common(start[a[at]], start[b[at]]) >= LENGTH
    claimed = np.flatnonzero(same)
    if not s.equal_bytes(start[a[claimed]], start[b[claimed]]).all():  # a collision: sort by the bytes themselves
        body = data[start[:, None] + np.arange(LENGTH)]
        order = np.lexsort((ids, *body.T[::-1], lists))
        a, b = order[:-1], order[1:]
        same = (lists[a] == lists[b]) & (body[a] == body[b]).all(1)
    group = np.cumsum(np.append(True, ~same)) - 1
    least = np.minimum.reduceat(ids[order], np.flatnonzero(np.append(True, ~same))) if len(order) else ids[order]
    out[order] = ids[order] > least[group] if len(order) else False
    return out


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges pass through; contexts, ordered by anchor, are sorted block by block and become ranges."""
    held: list[pa.RecordBatch] = []
    size = 0

    def ranges(doc_id, rid, lo, hi) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc_id, rid, lo, hi)], ["doc_id", "rid", "lo", "hi"])

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        f = flat(t["context"])
        h = t["h"].to_numpy()
        rel = t["rel"].to_numpy().astype(np.int64)
        n = f.lengths - LENGTH + 1
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        anchor = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
        lists = anchor[owner] * (4 * LENGTH) + (step - rel[owner] + 2 * LENGTH)
        _, which, count = np.unique(lists, return_inverse=True, return_counts=True)
        pick = np.flatnonzero(count[which] > 1)
        gone = np.zeros(len(owner), bool)
        gone[pick] = repeated(f.data, f.off[owner[pick]] + step[pick], lists[pick], t["doc_id"].to_numpy()[owner[pick]])
        at = np.flatnonzero(gone)
        o, a, z = _runs(owner[at], step[at], step[at] + LENGTH)
        lo = t["lo"].to_numpy()
        if len(o):
            yield ranges(t["doc_id"].to_numpy()[o], t["rid"].to_numpy()[o], lo[o] + a, lo[o] + z)

    for b in batches:
        plain = b.filter(pa.compute.is_null(b.column("context")))
        if plain.num_rows:
            yield ranges(plain.column("doc_id"), plain.column("rid"), plain.column("lo"), plain.column("hi"))
        b = b.filter(pa.compute.is_valid(b.column("context")))
        if not b.num_rows:
            continue
        held.append(b)
        size += b.num_rows * GRAM
        if size < BLOCK:
            continue
        t = pa.Table.from_batches(held)
        h = t["h"].to_numpy()
        cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if (h != h[-1]).any() else 0
        if cut:
            yield from solve(t.slice(0, cut).combine_chunks())
            held = t.slice(cut).combine_chunks().to_batches()
            size = (t.num_rows - cut) * GRAM
    if held:
        yield from solve(pa.Table.from_batches(held).combine_chunks())


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        f = flat(b.column("text"))
        gone_ = b.column("gone")
        off = gone_.offsets.to_numpy()
        count = np.where(gone_.is_valid().to_numpy(zero_copy_only=False), np.diff(off), 0)
        whose, all_lo, all_hi = (x.to_numpy(zero_copy_only=False) for x in gone_.values.flatten())
        rids = b.column("rid").to_numpy()
        removed, spans, digests, texts = [], [], [], []
        for i in range(b.num_rows):
            body = f.data[f.off[i]:f.off[i + 1]]
            k = np.arange(off[i], off[i] + count[i])
            k = k[whose[k] == rids[i]]
            gone = n = 0
            if len(k):
                k = k[np.argsort(all_lo[k], kind="stable")]
                _, a, z = _runs(np.zeros(len(k), np.int64), all_lo[k], all_hi[k])
                n, gone = len(a), int((z - a).sum())
                body = np.concatenate([body[x:y] for x, y in zip(np.append(0, z), np.append(a, len(body)), strict=True)])
            removed.append(gone)
            spans.append(n)
            digests.append(hashlib.sha256(body).hexdigest())
            if with_text:
                texts.append(body.tobytes().decode("utf-8", "replace"))
        cols = [b.column("doc_id"), pa.array(f.lengths), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                pa.array(digests, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            cols.append(pa.array(texts, pa.string()))
            names.append("kept_text")
        yield pa.RecordBatch.from_arrays(cols, names)


def deduplicate(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and, on demand, kept_text; a row per row of docs.

    Each byte covered by a LENGTH-byte string that also starts in a row with a smaller doc_id is removed, judged on the
    whole input. Null texts count as empty. Rows with null doc_id lose nothing and take nothing from others; rows that
    repeat a doc_id do not affect each other. kept_text shows bytes that are no UTF-8 any more as U+FFFD.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(256, -(-int(total) // BUCKET_BYTES))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # both joins below are left joins of this very exchange, so that texts move only once
    by_row = rows.withColumn("rid", F.xxhash64("doc_id", "text")).repartition(parts, "doc_id")
    blobs = map_arrow(rows.where(F.col("doc_id").isNotNull()), lambda b: _dealt(b, buckets),
                      "bucket long, h binary, c binary, steps binary, runs binary")
    answers = blobs.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda b: _answered(b, buckets), "doc_id long, key long")
    keys = answers.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    found = by_row.join(keys, "doc_id", "left").select("rid", "doc_id", "text", "keys").mapInArrow(_located, FOUND)
    ranges = found.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(
        _resolved, "doc_id long, rid long, lo long, hi long")
    gone = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("rid", "lo", "hi")).alias("gone"))
    out = by_row.join(gone, "doc_id", "left").select("rid", "doc_id", "text", "gone")
    return out.mapInArrow(lambda b: _cut(b, with_text), OUT + (", kept_text string" if with_text else ""))
