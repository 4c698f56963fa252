"""SentencePiece encoding and decoding by a batched Viterbi search.

Texts become words: a run of spaces (as U+2581) and what follows it, cut further where no piece can reach across. Words of equal length form one matrix and advance
together, one end position at a time: hashes of all substrings that end there, from prefix hashes, probe the sorted
hashes of the pieces, and row-wise maxima keep score and back pointer. Each distinct word of a batch is searched once.
Characters without a piece fall back to byte pieces, so decoding restores every text exactly.

Models differ in what a path is worth. In a unigram model it is the sum of its pieces' scores. In a merge (BPE) model
scores only order the merges, and the right path is the one whose neighbours stay apart when their characters are
merged in that order; each prefix of a word has just one such last piece, so the same search applies with a path worth
0 or nothing. Neighbours are tested for all words at once by undoing the later of their last merges until a crossing
merge would have come first (not right) or none is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .flat import BASE, Flat, chunks, flat, map_arrow, mix, powers

#: Piece kinds of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE_MARK = 0x2581
FILL = np.uint32(1 << 25)
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message: integers, or bytes for the other wire types."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size = varint()
            yield key >> 3, data[at:at + size]
            at += size


@dataclass
class Pieces:
    """A vocabulary as arrays.

    keys: sorted hashes of the pieces a search may use; ids and scores in their order. longest: characters of the
    longest. byte_ids: ids of the 256 byte pieces (-1: none). bodies and body_off: bytes of every id as decoded, spaces
    for marks. prefix: whether a space goes before a text.
    """

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    byte_ids: np.ndarray
    unknown: int
    bodies: np.ndarray
    body_off: np.ndarray
    prefix: bool
    cut: np.ndarray | None = None  # merge models: characters of the left part of each piece's last merge, 0 for one character
    pairs: np.ndarray | None = None  # by the leading bits of a hash: whether a piece may hold two characters side by side
    sieve: np.ndarray | None = None  # by the leading bits of a hash: whether any key has them

    def __post_init__(self):
        if self.sieve is None:
            self.sieve = np.zeros(1 << 20, bool)
            self.sieve[self.keys >> np.uint64(44)] = True

    @classmethod
    def load(cls, path: str) -> Pieces:
        """From a model file (its path is a parameter; the file is read on the driver only)."""
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> Pieces:
        pieces, prefix, merges = [], True, False
        for number, value in _fields(data):
            if number == 1:
                text, score, kind = b"", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        text = v
                    elif n == 2:
                        score = float(np.frombuffer(v, "<f4")[0])
                    elif n == 3:
                        kind = v
                pieces.append((text, score, kind))
            elif number == 2:
                merges = any(n == 3 and v == 2 for n, v in _fields(value))
            elif number == 3:
                for n, v in _fields(value):
                    if n == 3:
                        prefix = bool(v)
        return cls.build(pieces, prefix, merges)

    @classmethod
    def build(cls, pieces: list[tuple[bytes, float, int]], prefix: bool = True, merges: bool = False) -> Pieces:
        byte_ids = np.full(256, -1, np.int32)
        texts, ids, scores, bodies, unknown = [], [], [], [], 0
        for i, (text, score, kind) in enumerate(pieces):
            body = text.replace("▁".encode(), b" ")
            if kind == BYTE:
                byte_ids[int(text[3:5], 16)] = i
                body = bytes([int(text[3:5], 16)])
            elif kind == UNKNOWN:
                unknown, body = i, " ⁇ ".encode()
            elif kind == CONTROL:
                body = b""
            elif kind in (NORMAL, USER):
                texts.append(text.decode())
                ids.append(i)
                scores.append(score)
            bodies.append(body)
        cut = None
        if merges:
            worth = dict(zip(texts, scores, strict=True))
            last = [_last_merge(t, worth) for t in texts]
            reached = [k for k, c in enumerate(last) if c is not None]  # a piece that merging cannot make is never used
            texts, ids, scores = ([x[k] for k in reached] for x in (texts, ids, scores))
            cut = np.array([last[k] for k in reached], np.int64)
        sides = np.array(sorted({(ord(x) << 32) | ord(y) for t in texts for x, y in zip(t, t[1:], strict=False)}), np.uint64)
        pairs = np.zeros(1 << 20, bool)
        pairs[mix(sides) >> np.uint64(44)] = True
        keys = np.array([_hash(np.frombuffer(t.encode("utf-32-le"), np.uint32)) for t in texts], np.uint64)
        order = np.argsort(keys)
        return cls(keys[order], np.array(ids, np.int32)[order], np.array(scores, np.float64)[order],
                   max(map(len, texts), default=1), byte_ids, unknown, np.frombuffer(b"".join(bodies), np.uint8),
                   np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64), prefix, None if cut is None else cut[order], pairs)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash among keys, -1 where there is none."""
        out = np.full(len(h), -1, np.int64)
        may = np.flatnonzero(self.sieve[h >> np.uint64(44)])
        i = np.minimum(np.searchsorted(self.keys, h[may]), len(self.keys) - 1)
        hit = self.keys[i] == h[may]
        out[may[hit]] = i[hit]
        return out

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best segmentation of words of one length (rows of code points; marks are spaces): for each row and end
        position, start of the last piece and its place among keys (-1: unknown character)."""
        rows, n = words.shape
        prefix = np.zeros((n + 1, rows), np.uint64)
        power = np.cumprod(np.full(self.longest + 1, BASE, np.uint64))
        for k in range(n):
            prefix[k + 1] = prefix[k] * BASE + words[:, k].astype(np.uint64) + np.uint64(1)
        best = np.full((n + 1, rows), -np.inf)
        best[0] = 0
        start = np.zeros((n + 1, rows), np.int32)
        place = np.full((n + 1, rows), -1, np.int32)
        if self.cut is not None:
            return self._search_merges(prefix, power)
        penalty = (self.scores.min() if len(self.scores) else 0.0) - UNKNOWN_PENALTY
        for end in range(1, n + 1):
            for size in range(min(end, self.longest), 0, -1):  # of equal scores the longest piece stays
                got = self._find(mix(prefix[end] - prefix[end - size] * power[size - 1] + np.uint64(size)))
                value = np.where(got >= 0, best[end - size] + self.scores[got], -np.inf)
                if size == 1:
                    value = np.where(got >= 0, value, best[end - 1] + penalty)
                better = value > best[end]
                best[end] = np.where(better, value, best[end])
                start[end] = np.where(better, end - size, start[end])
                place[end] = np.where(better, got, place[end])
        return start, place

    def _search_merges(self, prefix: np.ndarray, power: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``search``, for a merge model."""
        n, rows = len(prefix) - 1, prefix.shape[1]
        start = np.zeros((n + 1, rows), np.int32)
        place = np.full((n + 1, rows), -1, np.int32)
        for end in range(1, n + 1):
            start[end] = end - 1  # a character without a piece stands alone
            todo = np.arange(rows)
            for size in range(min(end, self.longest), 0, -1):
                if not len(todo):
                    break
                got = self._find(mix(prefix[end, todo] - prefix[end - size, todo] * power[size - 1] + np.uint64(size)))
                row, got = todo[got >= 0], got[got >= 0]
                if end > size and len(row):
                    before = end - size
                    left = place[before, row]
                    fits = left < 0
                    some = np.flatnonzero(~fits)
                    fits[some] = self._apart(prefix, power, row[some], start[before, row[some]], before, end, left[some], got[some])
                    row, got = row[fits], got[fits]
                start[end, row], place[end, row] = end - size, got
                todo = todo[place[end, todo] < 0]
        return start, place

    def _apart(self, prefix, power, row, a, m, z, left, right) -> np.ndarray:
        """Whether the pieces from a to m and m to z, places left and right, stay apart when merged by score."""
        out = np.ones(len(row), bool)
        live = np.arange(len(row))
        a, z = a.astype(np.int64), np.full(len(row), z, np.int64)
        left, right = left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(row), np.inf)  # cost below which a crossing merge comes first; costs are negated scores
        tie = np.zeros(len(row), bool)  # whether one of equal cost comes first too
        while len(live):
            size = z - a
            over = size > self.longest
            width = np.where(over, 1, size)
            h = mix(prefix[np.where(over, a + 1, z), row] - prefix[a, row] * power[width - 1] + width.astype(np.uint64))
            got = np.where(over, -1, self._find(h))
            cost = np.where(got >= 0, -self.scores[got], np.inf)
            crossed = (got >= 0) & ((cost < limit) | ((cost == limit) & tie))
            out[live[crossed]] = False
            ok = ~crossed
            live, row, a, z, left, right, limit, tie = (v[ok] for v in (live, row, a, z, left, right, limit, tie))
            if not len(live):
                break
            cl = np.where(self.cut[left] > 0, -self.scores[left], -np.inf)
            cr = np.where(self.cut[right] > 0, -self.scores[right], -np.inf)
            go = (cl > -np.inf) | (cr > -np.inf)
            live, row, a, z, left, right, limit, tie, cl, cr = (
                v[go] for v in (live, row, a, z, left, right, limit, tie, cl, cr))
            if not len(live):
                break
            # undo the later merge; of equal ones the right one came later
            undo_left = cl > cr
            limit = np.where(undo_left, cl, cr)
            tie = ~undo_left  # a crossing merge lies left of the right piece's own, so it wins ties with it
            a = np.where(undo_left, a + self.cut[left], a)
            z = np.where(undo_left, z, m + self.cut[right])
            w = np.where(undo_left, m - a, z - m)
            base = np.where(undo_left, a, m)
            part = self._find(mix(prefix[base + w, row] - prefix[base, row] * power[w - 1] + w.astype(np.uint64)))
            left, right = np.where(undo_left, part, left), np.where(undo_left, right, part)
        return out

    def words_of(self, cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts, with the mark for spaces and before each text, word starts (with the end), and the
        word at which each text begins. A mark that a text holds itself becomes a symbol without a piece."""
        n = np.diff(off)
        lead = (n > 0).astype(np.int64) if self.prefix else np.zeros(len(n), np.int64)
        new_off = np.concatenate([[0], np.cumsum(n + lead)])
        out = np.full(new_off[-1], SPACE_MARK, np.uint32)
        at = np.arange(len(cp)) + np.repeat(np.cumsum(lead), n)
        out[at] = np.where(cp == 0x20, SPACE_MARK, np.where(cp == SPACE_MARK, SPACE_MARK + (1 << 24), cp))
        mark = out == SPACE_MARK
        first = mark.copy()
        first[1:] &= ~mark[:-1]
        begins = new_off[:-1][np.diff(new_off) > 0]
        first[begins] = True
        # no piece reaches over two characters that no piece holds side by side: words may be cut there
        beside = (out[:-1].astype(np.uint64) << np.uint64(32)) | out[1:]
        first[1:] |= ~self.pairs[mix(beside) >> np.uint64(44)]
        starts = np.flatnonzero(first)
        return out, np.append(starts, len(out)), np.searchsorted(starts, new_off)

    def encode(self, f: Flat, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin. ``known`` remembers words from call to call."""
        text = f.data.tobytes().decode("utf-8", "surrogatepass")
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((f.data & 0xC0) != 0x80)])
        symbols, starts, first_word = self.words_of(cp, lead[f.off])
        if len(starts) < 2:
            return np.zeros(0, np.int32), np.zeros(f.n + 1, np.int64)
        sizes = np.diff(starts)
        # name words by hash and keep one of each
        up, down = powers(len(symbols) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[:len(symbols)])])
        name = mix((sums[starts[1:]] - sums[starts[:-1]]) * down[starts[:-1]] + sizes.astype(np.uint64))
        names, one, which = np.unique(name, return_index=True, return_inverse=True)
        known = Known() if known is None else known
        fresh = np.flatnonzero(~known.has(names))
        if len(fresh):
            known.add(names[fresh], *self._encode_words(symbols, starts[:-1][one[fresh]], sizes[one[fresh]]))
        lists, begins, counts = known.get(names)
        # lay the ids of the words one after another
        n = counts[which]
        ends = np.cumsum(n)
        word_at = np.concatenate([[0], ends])
        begin = begins[which]
        ids = lists[np.arange(ends[-1]) + np.repeat(begin - (ends - n), n)]
        return ids, word_at[first_word]

    def _encode_words(self, symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given words, one after another in their order, and how many each has."""
        counts = np.zeros(len(start), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, end position, id
        # rare long words are filled up with a symbol that no piece has, so that enough of them have equal length
        up = np.where(size <= 12, size, np.where(size <= 64, -(-size // 8) * 8, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)))
        for n in np.unique(up):
            for part in np.array_split(mine := np.flatnonzero(up == n), max(1, len(mine) * int(n) >> 18)):
                at = start[part][:, None] + np.minimum(np.arange(n), size[part][:, None] - 1)
                words = np.where(np.arange(n) < size[part][:, None], symbols[at], FILL)
                begin, place = self.search(words)
                row, end = np.arange(len(part)), size[part].copy()
                while len(row):
                    p = place[end, row]
                    known = p >= 0
                    found.append((part[row[known]], end[known] * 4, self.ids[p[known]]))
                    if not known.all():
                        found += self._bytes(part, row[~known], end[~known], words)
                    end = begin[end, row].astype(np.int64)
                    row, end = row[end > 0], end[end > 0]
        word, end, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((end, word))
        np.add.at(counts, word, 1)
        return ids[order].astype(np.int32), counts

    def _bytes(self, part, row, end, words):
        """Byte pieces of characters that have none of their own, or the unknown piece without byte pieces."""
        out = []
        for r, e in zip(row.tolist(), end.tolist(), strict=True):
            c = int(words[r, e - 1]) & 0xFFFFFF
            raw = chr(c).encode("utf-8", "surrogatepass")
            ids = [int(self.byte_ids[b]) for b in raw]
            ids = ids if min(ids) >= 0 else [self.unknown]
            # up to four bytes end at one character: they keep their order below its place
            out.append((np.full(len(ids), part[r]), e * 4 - len(ids) + 1 + np.arange(len(ids)), np.array(ids, np.int32)))
        return out

    def decode(self, ids: np.ndarray, first: np.ndarray) -> Flat:
        """Texts of id lists (ids first[i] to first[i + 1])."""
        n = np.diff(self.body_off)[ids]
        ends = np.cumsum(n)
        data = self.bodies[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.body_off[ids] - (ends - n), n)]
        off = np.concatenate([[0], ends])[first].astype(np.int64)
        if self.prefix:  # the space before each text goes
            keep = np.ones(len(data), bool)
            full = off[:-1][np.diff(off) > 0]
            keep[full] = data[full] != 0x20
            off = np.concatenate([[0], np.cumsum(keep)])[off]
            data = data[keep]
        return Flat(data, off)


class Known:
    """Ids of words by name, at most about ``most`` words: beyond that it starts anew."""

    def __init__(self, most: int = 400_000):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.begin = self.count = np.zeros(0, np.int64)
        self.lists = np.zeros(0, np.int32)

    def _at(self, names: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.names, names), max(len(self.names) - 1, 0))

    def has(self, names: np.ndarray) -> np.ndarray:
        if len(self.names) > self.most:
            self._clear()
        return self.names[self._at(names)] == names if len(self.names) else np.zeros(len(names), bool)

    def add(self, names: np.ndarray, lists: np.ndarray, counts: np.ndarray) -> None:
        begin = np.cumsum(counts) - counts + len(self.lists)
        merged = np.concatenate([self.names, names])
        order = np.argsort(merged, kind="stable")
        self.names = merged[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, counts])[order]
        self.lists = np.concatenate([self.lists, lists])

    def get(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i = self._at(names)
        return self.lists, self.begin[i], self.count[i]


def _last_merge(text: str, worth: dict[str, float]) -> int | None:
    """Characters of the left part of the last merge that makes text, 0 for one character, None if merging stops
    before. Pairs of best score merge first, the leftmost of equals."""
    parts = list(text)
    while len(parts) > 1:
        pairs = [(-worth[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in worth]
        if not pairs:
            return None
        if len(parts) == 2:
            return len(parts[0])
        k = min(pairs)[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return 0


def _hash(cp: np.ndarray) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for c in cp:
        h = h * BASE + np.uint64(int(c) + 1)
    return mix(h + np.uint64(len(cp)))[0]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _shared(docs: DataFrame, pieces: Pieces):
    return docs.sparkSession.sparkContext.broadcast(tuple(vars(pieces).values()))


#: Bytes of text encoded at once where other columns travel along.
ENCODE_BYTES = 1 << 19


def encoded(docs: DataFrame, pieces: Pieces, decoded: str | None = None) -> DataFrame:
    """docs with ids array<int>: the pieces of text; none for an empty or null text. Other columns stay; one that is
    called ids already is replaced. With ``decoded``, the text of the ids is added under that name as the function
    ``decoded`` would, by the same Python worker: two in a row would double their number and memory."""
    docs = docs.drop("ids", *([decoded] if decoded else []))
    shared, names = _shared(docs, pieces), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = Pieces(*shared.value), Known()
        for b in chunks(batches, limit=ENCODE_BYTES):
            ids, first = model.encode(flat(b.column("text")), known)
            back = [pa.array(_texts(model.decode(ids, first)), pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)), *back],
                [*names, "ids", *([decoded] if decoded else [])])

    more = [T.StructField(decoded, T.StringType())] if decoded else []
    return map_arrow(docs, run, T.StructType([
        *docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), *more]))


def _texts(f: Flat) -> list[str]:
    return [f.text(i).decode("utf-8", "replace") for i in range(f.n)]


def decoded(rows: DataFrame, pieces: Pieces, column: str = "decoded") -> DataFrame:
    """rows with the text of ids in ``column``; null ids give an empty text. Other columns stay, but for one of that name."""
    rows = rows.drop(column)
    shared, names = _shared(rows, pieces), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces(*shared.value)
        for b in batches:
            lists = b.column("ids")
            n = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            f = model.decode(lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(n)]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_texts(f), pa.string())], [*names, column])

    return map_arrow(rows, run, T.StructType([*rows.schema.fields, T.StructField(column, T.StringType())]))


def digests(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, n_chars, n_tokens, ids_sha256, text_sha256, same): a row per row of docs.

    ids_sha256 is of the ids as little-endian 32-bit integers, text_sha256 of the decoded text; same says whether that
    is the text (an empty one for null). Encoding and decoding are done in one pass, ids are not shuffled or stored.
    """
    shared = _shared(docs, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = Pieces(*shared.value), Known()
        for b in chunks(batches):
            f = flat(b.column("text"))
            ids, first = model.encode(f, known)
            back = model.decode(ids, first)
            texts = [back.text(i) for i in range(f.n)]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.diff(np.concatenate([[0], np.cumsum((f.data & 0xC0) != 0x80)])[f.off])),
                pa.array(np.diff(first)),
                pa.array([hashlib.sha256(ids[x:y].astype("<i4").tobytes()).hexdigest() for x, y in zip(first[:-1], first[1:], strict=True)]),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                pa.array([t == f.text(i) for i, t in enumerate(texts)])],
                ["doc_id", "n_chars", "n_tokens", "ids_sha256", "text_sha256", "same"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(plain, run, "doc_id long, n_chars long, n_tokens long, ids_sha256 string, text_sha256 string, same boolean")
