"""Alignment of two tokenizers over the same texts: groups between shared cuts, and links of overlapping tokens.

Tokenizer A is a byte-level model read from a .json file and sees a space and the text; tokenizer B is a SentencePiece
model, which adds the space itself. Both cut the same bytes. The search for shared cuts divides and conquers: near the middle
of an interval of A's ends it looks for one that is marked among B's ends too; the interval is divided there
and both halves go on, and an interval without a shared cut becomes a group. All intervals of all texts of a batch
advance together, and the stretch of ends looked at around a middle doubles, so a text without shared cuts costs its length.

Inside a group A's and B's tokens overlap like the steps of two stairs: a + b - 1 links, in order. How many rows of
the table hold an id pair linked is summed over the table: tasks count their own rows, Spark adds the counts up, and each
pair is compared with the highest count of its A id. Ids are kept as a table in the shared folder and links are
built from them again, so links are never stored; only links of pairs beyond the bounded broadcast are joined.

A null or empty text, or one whose bytes A or B does not give back, has no tokens: zeros, and '' for the digest. Rows are
independent of each other; repeated rows and ids stay and count each, null ids and extra columns have no influence, an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import LONGEST_REMEMBERED, REMEMBERED, Counter, Merges, byte_letters
from .flat import Flat, chunks, flat, sums_by
from .tables import kept

#: Pairs of the broadcast table: 16 bytes each, so 16 MB at most whatever the corpus. All others are joined.
FREQUENT = 1_000_000
#: A task adds up counts of at most about this many pairs before it hands them on.
PAIRS_AT_ONCE = 1_000_000
#: Bits of an id in a pair number.
PAIR_BITS = 20
#: The split pattern where a text is ASCII: the same classes, written out for the faster library of the two.
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
#: Bytes of text aligned at once; one longer text is still taken whole.
CHUNK = 1 << 20


@dataclass
class Tokenizers:
    """The two model files' contents, how A splits texts, and the bytes of every id."""

    a_spec: str
    b_model: bytes
    merges: Merges
    a_bytes: list[bytes]
    b_bytes: list[bytes]

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Tokenizers:
        """From the model files (their paths are parameters; they are read on the driver only)."""
        with open(a_path, encoding="utf-8") as f:
            a_spec = f.read()
        with open(b_path, "rb") as f:
            b_model = f.read()
        spec = json.loads(a_spec)
        byte = {c: i for i, c in enumerate(byte_letters())}
        a = {i: bytes(byte[c] for c in entry) for entry, i in spec["model"]["vocab"].items()}
        a.update({t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])})
        processor = _b(b_model)
        b = []
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            b.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode())
        return cls(a_spec, b_model, Merges.parse(a_spec), [a.get(i, b"") for i in range(max(a) + 1)], b)


def _a(spec: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


def _b(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


class PieceIds(Counter):
    """Ids of A by piece of its split pattern: each distinct piece of a task goes through the model once.

    A piece stands for its number; the ids of all numbered pieces lie one after another in ``pool``.
    """

    def __init__(self, spec: str, merges: Merges):
        super().__init__(merges)
        self.model, self.letters = _a(spec).model, byte_letters()
        # no text below this character needs the exact pattern
        self.first_newer = chr(int(merges.newer[2:10], 16)) if merges.newer else "\U0010FFFF"
        self.newer = self.newer or regex.compile("(?!)")
        self.pool, self.ends = array("q"), array("q", [0])

    def __missing__(self, piece: str) -> int:
        letters = self.letters
        self.pool.extend([t.id for t in self.model.tokenize("".join([letters[b] for b in piece.encode()]))])
        number = len(self.ends) - 1
        self.ends.append(len(self.pool))
        if len(piece) <= LONGEST_REMEMBERED:
            self[piece] = number
        return number

    def pieces(self, text: str) -> list[str]:
        """Special strings are plain text here."""
        if text.isascii():
            return ASCII.findall(text)
        odd = max(text) >= self.first_newer and self.newer.search(text)
        return (self.exact if odd else self.usual).findall(text)

    def laid(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin."""
        if len(self.ends) > REMEMBERED or len(self.pool) > 4 * REMEMBERED:
            self.clear()
            self.pool, self.ends = array("q"), array("q", [0])
        parts = [self.pieces(t) for t in texts]
        first = _offsets([len(p) for p in parts])
        number = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(parts)), np.int64, first[-1])
        pool, ends = np.array(self.pool), np.array(self.ends)
        n = ends[number + 1] - ends[number]
        off = _offsets(n)
        return pool[np.arange(off[-1]) + np.repeat(ends[number] - off[:-1], n)], off[first]


class Bytes:
    """Byte strings by number, side by side."""

    def __init__(self, parts: list[bytes]):
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.size = np.array([len(p) for p in parts], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def joined(self, which: np.ndarray) -> np.ndarray:
        """The strings of the given numbers, one after another."""
        n = self.size[which]
        ends = np.cumsum(n)
        return self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[which] - (ends - n), n)]


def _offsets(counts) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))]).astype(np.int64)


def _restored(f: Flat, ids: np.ndarray, first: np.ndarray, table: Bytes) -> np.ndarray:
    """For each text, whether its ids give back a space and its bytes."""
    sizes = _offsets(table.size[ids])[first]
    ok = (np.diff(sizes) == f.lengths + 1) & (f.lengths > 0)
    got = table.joined(ids)
    for i in np.flatnonzero(ok):
        mine = got[sizes[i]:sizes[i + 1]]
        ok[i] = mine[0] == 0x20 and np.array_equal(mine[1:], f.data[f.off[i]:f.off[i + 1]])
    return ok


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray) -> np.ndarray:
    """Indices of A's ends that are ends of B too, by divide and conquer from the last end of each text.

    Both are increasing over all texts of the batch; text i has A's ends first_a[i] to first_a[i + 1], and the last end
    of every text that has any is shared.
    """
    n = np.diff(first_a)
    found = [first_a[1:][n > 0] - 1]
    of_b = np.zeros(max(ends_a[-1:].sum(), ends_b[-1:].sum()) + 1, bool)
    of_b[ends_b] = True
    lo, hi = first_a[:-1][n > 1], first_a[1:][n > 1] - 1  # open intervals: inner ends of A from lo up to hi
    while len(lo):
        middle, cut = (lo + hi) // 2, np.full(len(lo), -1, np.int64)
        near, live = np.zeros(len(lo), np.int64), np.arange(len(lo))
        width = 1
        while len(live):
            # ends within [near, near + width) of the middle, the closest first
            steps = np.arange(width)
            for side in (1, -1):
                m, still = middle[live], cut[live] < 0
                rows = live[still]
                if not len(rows):
                    break
                at = m[still][:, None] + side * (near[rows][:, None] + steps)
                inside = (at >= lo[rows][:, None]) & (at < hi[rows][:, None])
                probe = at[inside]
                hit = np.zeros(at.shape, bool)
                hit[inside] = of_b[ends_a[probe]]
                any_hit = hit.any(1)
                cut[rows[any_hit]] = at[any_hit, hit[any_hit].argmax(1)]
            near[live] += width
            width *= 2
            open_still = (cut[live] < 0) & ((middle[live] + near[live] < hi[live]) | (middle[live] - near[live] >= lo[live]))
            live = live[open_still]
        some = cut >= 0
        found.append(cut[some])
        lo, hi, cut = lo[some], hi[some], cut[some]
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut, hi])
        full = lo < hi
        lo, hi = lo[full], hi[full]
    return np.sort(np.concatenate(found))


@dataclass
class Aligned:
    """Tokens of a batch of texts: ids and, per text, where they begin; the same for groups and links.

    group_a and group_b say where each group's tokens begin (with the end of the last), group_first where each text's
    groups do.
    """

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    group_first: np.ndarray
    sizes_a: np.ndarray
    sizes_b: np.ndarray
    decimals: Bytes

    @classmethod
    def of(cls, a, first_a, b, first_b, sizes_a: np.ndarray, sizes_b: np.ndarray, decimals: Bytes) -> Aligned:
        """Texts that have no tokens of A must have none of B."""
        ends_a, ends_b = np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b])
        cuts = shared_cuts(ends_a, ends_b, first_a)
        other = np.searchsorted(ends_b, ends_a[cuts])
        return cls(a, b, first_a, first_b, np.concatenate([[0], cuts + 1]), np.concatenate([[0], other + 1]),
                   np.searchsorted(cuts + 1, first_a, "right"), sizes_a, sizes_b, decimals)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(A's token, B's token) of every link in order, and where each text's links begin."""
        ends_a, ends_b = np.cumsum(self.sizes_a[self.a]), np.cumsum(self.sizes_b[self.b])
        return (*_overlaps(ends_a, ends_b), _link_first(self.first_a, self.first_b, self.group_first))

    def written(self) -> list[str]:
        """Each text's groups as text: ids with commas, A's and B's parted by a bar, groups by semicolons."""
        na, nb = np.diff(self.group_a), np.diff(self.group_b)
        group_of_a, group_of_b = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
        at_a = np.arange(len(self.a)) + self.group_b[group_of_a]
        at_b = np.arange(len(self.b)) + self.group_a[group_of_b + 1]
        ids = np.zeros(len(self.a) + len(self.b), np.int64)
        ids[at_a], ids[at_b] = self.a, self.b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[at_a[self.group_a[1:] - 1]] = ord("|")
        mark[at_b[self.group_b[1:] - 1]] = ord(";")
        n = self.decimals.size[ids] + 1
        ends = np.cumsum(n)
        out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
        digits = np.ones(len(out), bool)
        digits[ends - 1] = False
        out[digits] = self.decimals.joined(ids)
        out[ends - 1] = mark
        first = _offsets(n)[self.first_a + self.first_b]
        return [out[x:y - 1].tobytes().decode() if y > x else "" for x, y in zip(first[:-1], first[1:], strict=True)]


def _overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all overlapping pairs: each stretch between neighbouring ends of either side is one."""
    size = int(ends_a[-1]) + 1 if len(ends_a) else 0
    in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
    in_a[ends_a], in_b[ends_b] = True, True
    ends = np.flatnonzero(in_a | in_b)
    return tuple(np.cumsum(own[ends]) - own[ends] for own in (in_a, in_b))


def _link_first(first_a, first_b, group_first) -> np.ndarray:
    """Where each text's links begin: a group of a and b tokens has a + b - 1."""
    return first_a + first_b - group_first


class Worker:
    """What a task needs to encode and align texts."""

    def __init__(self, toks: Tokenizers):
        self.a, self.b = PieceIds(toks.a_spec, toks.merges), _b(toks.b_model)
        self.a_bytes, self.b_bytes = Bytes(toks.a_bytes), Bytes(toks.b_bytes)
        self.decimals = Bytes([str(i).encode() for i in range(max(len(toks.a_bytes), len(toks.b_bytes)))])

    def align(self, texts: pa.Array) -> Aligned:
        """Texts that are null, empty or not given back have no tokens."""
        f, plain = flat(texts), [t or "" for t in texts.to_pylist()]
        a, first_a = self.a.laid([" " + t for t in plain])
        b, first_b = _laid(self.b.encode(plain, num_threads=1))
        ok = _restored(f, a, first_a, self.a_bytes) & _restored(f, b, first_b, self.b_bytes)
        a, first_a = _only(a, first_a, ok)
        b, first_b = _only(b, first_b, ok)
        return Aligned.of(a, first_a, b, first_b, self.a_bytes.size, self.b_bytes.size, self.decimals)


def _laid(lists) -> tuple[np.ndarray, np.ndarray]:
    first = _offsets([len(x) for x in lists])
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, first[-1]), first


def _only(ids, first, ok) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(first)
    return ids[np.repeat(ok, n)], _offsets(np.where(ok, n, 0))


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))


def _packed(ids: np.ndarray, first: np.ndarray, dtype) -> pa.Array:
    """Lists of ids as binary values."""
    data = np.ascontiguousarray(ids.astype(dtype))
    off = (first * data.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first) - 1, [None, pa.py_buffer(off), pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    f = flat(col)
    return np.frombuffer(f.data.tobytes(), dtype).astype(np.int64), f.off // np.dtype(dtype).itemsize


def _narrow(n: int):
    return np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")


def groups(docs: DataFrame, toks: Tokenizers, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The alignments themselves: ``keep`` of docs with a_ids and b_ids, and a_ends and b_ends, the number of tokens up to
    the end of each group. One pass, nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(toks)
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([*[docs.schema[c] for c in keep], *[T.StructField(c, ints) for c in ("a_ids", "b_ids", "a_ends", "b_ends")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Worker(shared.value)
        for batch in chunks(batches, "__text", CHUNK):
            x = worker.align(batch.column("__text"))
            own = np.repeat(np.arange(batch.num_rows), np.diff(x.group_first))
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], _lists(x.a, x.first_a), _lists(x.b, x.first_b),
                _lists(x.group_a[1:] - x.first_a[own], x.group_first), _lists(x.group_b[1:] - x.first_b[own], x.group_first)],
                schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


def _encoded(docs: DataFrame, shared, keep: Sequence[str], kinds) -> DataFrame:
    """keep, ids of both sides as binary, number of groups and digest of the groups."""
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("__a", T.BinaryType()), T.StructField("__b", T.BinaryType()),
                           T.StructField("n_groups", T.LongType()), T.StructField("groups_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Worker(shared.value)
        for batch in chunks(batches, "__text", CHUNK):
            x = worker.align(batch.column("__text"))
            digest = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in x.written()]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], _packed(x.a, x.first_a, kinds[0]), _packed(x.b, x.first_b, kinds[1]),
                pa.array(np.diff(x.group_first)), pa.array(digest, pa.string())], schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


class Linked:
    """Links of stored ids, as pair numbers."""

    def __init__(self, toks: Tokenizers, kinds):
        self.sizes = [np.array([len(x) for x in part], np.int64) for part in (toks.a_bytes, toks.b_bytes)]
        self.kinds = kinds

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pair number of each link, where each row's links begin, and where its ids of A and of B do."""
        a, first_a = _unpacked(batch.column("__a"), self.kinds[0])
        b, first_b = _unpacked(batch.column("__b"), self.kinds[1])
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        of_a, of_b = _overlaps(ends_a, ends_b)
        return a[of_a] << PAIR_BITS | b[of_b], np.searchsorted(of_a, first_a), first_a, first_b


def _pair_counts(ids: DataFrame, shared, kinds) -> DataFrame:
    """(pair, n): how many rows hold the pair linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked = Linked(shared.value, kinds)
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merged(some: list[tuple[np.ndarray, np.ndarray]]):
            p, n = (np.concatenate(x) for x in zip(*some, strict=True))
            order = np.argsort(p, kind="stable")
            p, n = p[order], n[order]
            start = np.flatnonzero(np.append(True, p[1:] != p[:-1])) if len(p) else np.zeros(0, np.int64)
            return p[start], np.add.reduceat(n, start) if len(p) else n

        new: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in chunks(batches, "__a", CHUNK // 2):
            pair, first, _, _ = linked.of(batch)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            held = np.unique(row << 2 * PAIR_BITS | pair) & ((1 << 2 * PAIR_BITS) - 1)
            new.append(np.unique(held, return_counts=True))
            if sum(len(p) for p, _ in new) > PAIRS_AT_ONCE:
                pairs, counts = merged([(pairs, counts), *new])
                new = []
                if len(pairs) > PAIRS_AT_ONCE:
                    yield from _slices(pairs, counts)
                    pairs, counts = pairs[:0], counts[:0]
        yield from _slices(*merged([(pairs, counts), *new]))

    return ids.select("__a", "__b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _slices(pairs, counts, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(pairs), rows):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[at:at + rows]), pa.array(counts[at:at + rows])], ["pair", "n"])


def _frequent(pairs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of the highest counts, in whole size classes of at most ``most`` together, sorted, with 2 * count + best;
    and whether that is all of them."""
    size = F.floor(F.log2(F.col("n").cast("double")))
    classes = sorted(pairs.groupBy(size.alias("c")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True)
    total, least = 0, None
    for c, k in classes:
        if total + k > most:
            break
        total, least = total + k, c
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), not classes
    rows = pairs.where(size >= least).select("pair", (F.col("n") * 2 + F.col("best").cast("long")).alias("v")).toArrow()
    p, v = (rows.column(c).to_numpy() for c in ("pair", "v"))
    order = np.argsort(p)
    return p[order], v[order], total == sum(k for _, k in classes)


def _summed(ids: DataFrame, shared, keep: Sequence[str], kinds, known) -> DataFrame:
    """Counts of every row; ``__rest`` has the pairs of its links that the broadcast table does not hold."""
    longs = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType([*[ids.schema[c] for c in keep], *[T.StructField(c, T.LongType()) for c in longs],
                           T.StructField("groups_sha256", T.StringType()), T.StructField("__rest", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked = Linked(shared.value, kinds)
        keys, values = known.value
        for batch in chunks(batches, "__a", CHUNK // 2):
            pair, first, first_a, first_b = linked.of(batch)
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            value = np.where(hit, values[at], 0) if len(keys) else np.zeros(len(pair), np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            rest = pa.ListArray.from_arrays(
                pa.array(_offsets(np.bincount(row[~hit], minlength=batch.num_rows)).astype(np.int32)), pa.array(pair[~hit]))
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([
                *columns, pa.array(np.diff(first_a)), pa.array(np.diff(first_b)), batch.column("n_groups"), pa.array(np.diff(first)),
                pa.array(sums_by(value & 1, first)), pa.array(sums_by(value >> 1, first)), batch.column("groups_sha256"), rest],
                schema.names)

    return ids.mapInArrow(run, schema)


def aligned(docs: DataFrame, toks: Tokenizers, keep: Sequence[str] = ("doc_id",), frequent: int = FREQUENT) -> DataFrame:
    """``keep`` of docs with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256; a row per row of docs.

    Texts are encoded once. What moves between tasks are counts of pairs, and links of pairs outside the broadcast
    table of ``frequent`` pairs, which a join gives their counts.
    """
    if max(len(toks.a_bytes), len(toks.b_bytes)) > 1 << PAIR_BITS:
        raise ValueError(f"vocabularies above {1 << PAIR_BITS} ids")
    sc = docs.sparkSession.sparkContext
    shared, kinds = sc.broadcast(toks), (_narrow(len(toks.a_bytes)), _narrow(len(toks.b_bytes)))
    names = [f"__k{i}" for i in range(len(keep))]  # names of keep may clash with those used here
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], "text")
    ids = kept(_encoded(rows, shared, names, kinds).withColumn("__rid", F.monotonically_increasing_id()), "ids")
    counts = kept(_pair_counts(ids, shared, kinds), "pairs")
    top = counts.groupBy(_a_of("pair").alias("a")).agg(F.max("n").alias("top"))
    pairs = kept(counts.join(top, _a_of("pair") == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "best")
    keys, values, complete = _frequent(pairs, frequent)
    out = _summed(ids, shared, ["__rid", *names], kinds, sc.broadcast((keys, values)))
    if not complete:
        out = kept(out, "sums")
        links = out.select("__rid", F.explode("__rest").alias("pair")).groupBy("__rid", "pair").agg(F.count(F.lit(1)).alias("m"))
        more = links.join(pairs, "pair").groupBy("__rid").agg(
            F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("__best"), F.sum(F.col("m") * F.col("n")).alias("__sum"))
        out = out.join(more, "__rid", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("__best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("__sum", F.lit(0))})
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "n_a", "n_b", "n_groups", "n_links", "n_best",
                      "count_sum", "groups_sha256")


def _a_of(pair: str):
    return F.shiftright(pair, PAIR_BITS)


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
