"""Token counts of byte-level byte-pair encoding, without the tokens themselves.

A text is cut at the tokenizer's special strings (a token each) and then into the pieces of its split pattern. The bytes
of a piece form a doubly linked list; a heap holds the ranks of adjacent pairs. The pair of lowest rank, of equal ones
the leftmost, is merged until none is left; pairs whose sides changed since they were pushed are passed over. A piece has
as many tokens as it had bytes, less the merges. Pieces repeat, so each distinct one of a task is merged once.

Null texts count as empty and have no tokens. Rows are independent of each other: repeated rows, repeated or null
ids and extra columns have no influence, an empty table gives no rows.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .flat import chunks

#: Fixed value: the split pattern of byte-level tokenizers; {S}, {L} and {N} are white space, letters and numbers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Distinct pieces whose counts a task remembers; beyond that it starts anew.
REMEMBERED = 500_000
#: Longer pieces are merged each time they occur, so that what is remembered stays small.
LONGEST_REMEMBERED = 200


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable in Latin-1, else
    the next free one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b) if b in shown else chr(free))
        free += b not in shown
    return out


@dataclass
class Merges:
    """ranks: left symbol << 32 | right symbol -> rank << 32 | merged symbol. symbols: that of each byte. special: strings that
    are tokens by themselves. newer: character class text of letters and numbers that the tokenizer's own tables do not
    know yet, as the pattern library does."""

    ranks: dict[int, int]
    symbols: list[int]
    special: list[str] = field(default_factory=list)
    newer: str = ""

    @classmethod
    def load(cls, path: str) -> Merges:
        """From a tokenizer file (a parameter; it is read on the driver only)."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        return cls.parse(text)

    @classmethod
    def parse(cls, text: str) -> Merges:
        spec = json.loads(text)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                 and not split.get("add_prefix_space") and spec.get("normalizer") is None
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
        if not plain:
            raise ValueError("only byte-level BPE without normaliser, prefix space or dropout is counted")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that reach beyond their own string are not counted")
        ids, ranks = model["vocab"], {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ranks.setdefault(ids[a] << 32 | ids[b], rank << 32 | ids[a + b])
        return cls(ranks, [ids[c] for c in byte_letters()], [t["content"] for t in spec.get("added_tokens", [])], _newer(text))

    def count(self, piece: bytes) -> int:
        """Tokens of one piece."""
        symbols, ranks = self.symbols, self.ranks
        here = [symbols[b] for b in piece]
        n = alive = len(here)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = ranks.get(here[i] << 32 | here[i + 1])
            if found is not None:
                heap.append((found >> 32, i, found & 0xFFFFFFFF, here[i], here[i + 1]))
        heapify(heap)
        while heap:
            _, i, merged, left, right = heappop(heap)
            j = after[i]
            if here[i] != left or j >= n or here[j] != right:
                continue
            here[i], here[j] = merged, -1
            k = after[i] = after[j]
            alive -= 1
            if k < n:
                before[k] = i
                found = ranks.get(merged << 32 | here[k])
                if found is not None:
                    heappush(heap, (found >> 32, i, found & 0xFFFFFFFF, merged, here[k]))
            h = before[i]
            if h >= 0:
                found = ranks.get(here[h] << 32 | merged)
                if found is not None:
                    heappush(heap, (found >> 32, h, found & 0xFFFFFFFF, here[h], merged))
        return alive


def _newer(spec: str) -> str:
    """Letters and numbers of the pattern library that the tokenizer splits from letters, as a character class.

    Both follow Unicode, in different versions. Only characters that Python's own, oldest tables do not know are tried.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_str(spec).pre_tokenizer
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    out = []
    for c in map(chr, range(0x80, 0x110000)):
        if unicodedata.category(c) == "Cn" and (letter.match(c) or number.match(c)):
            beside = "a" if letter.match(c) else "1"
            if len(split.pre_tokenize_str(beside + c)) > 1:
                out.append(ord(c))
    text, k = "", 0
    while k < len(out):
        e = k
        while e + 1 < len(out) and out[e + 1] == out[e] + 1:
            e += 1
        text += f"\\U{out[k]:08x}-\\U{out[e]:08x}"
        k = e + 1
    return text


class Counter(dict):
    """Tokens by piece, computed when first asked for; ``of`` counts whole texts."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.usual = regex.compile(PATTERN.format(S=r"\s", L=r"\p{L}", N=r"\p{N}"))
        self.newer = regex.compile(f"[{merges.newer}]") if merges.newer else None
        self.exact = self.usual if self.newer is None else regex.compile(regex.sub(
            r"\[(\^?)([^\]]*)\]", lambda m: _without(m[1], m[2], merges.newer), PATTERN), regex.V1)
        longest_first = sorted(merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None

    def __missing__(self, piece: str) -> int:
        n = self.merges.count(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= LONGEST_REMEMBERED:
            self[piece] = n
        return n

    def of(self, text: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        parts, n = [text], 0
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            n = len(parts) - 1
        for part in parts:
            odd = self.newer is not None and not part.isascii() and self.newer.search(part)
            n += sum(map(self.__getitem__, (self.exact if odd else self.usual).findall(part)))
        return n


def _without(negated: str, classes: str, newer: str) -> str:
    """A class of the pattern, written as a set without the letters and numbers in ``newer``."""
    sets = {"{S}": r"\s", "{L}": r"\p{L}", "{N}": r"\p{N}"}
    names = [classes[i:i + 3] for i in range(0, len(classes), 3)]
    body = "".join(sets[n] for n in names)
    if names == ["{S}"]:
        return f"[{negated}{body}]"
    return f"[[{negated}{body}]||[{newer}]]" if negated else f"[[{body}]--[{newer}]]"


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def counted(docs: DataFrame, merges: Merges, limit: int = 1024, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of docs with n_bytes long, n_tokens long and over_limit boolean (n_tokens > limit).

    Nothing is shuffled; each text goes through Python once and only numbers come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(merges)
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType([*kept, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for b in chunks(batches, "__text"):
            texts = b.column("__text")
            n = pa.array([counter.of(t or "") for t in texts.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], size, n, pc.greater(n, limit)], [f.name for f in schema])

    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    return rows.mapInArrow(run, schema)
