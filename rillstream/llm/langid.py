"""Language identification by cross-parsing entropy.

For each language one suffix automaton of a bounded sample of its labelled text knows every substring of the sample. A
text is parsed greedily into the longest phrases that the automaton knows; the language that needs the fewest bits for
them (phrases times the logarithm of the sample's length, per character) wins. Parsing runs over many pieces of text
side by side: all pieces advance by one character per step through one packed transition table.

Every letter of the samples, of whatever script, is a symbol of its own (upper and lower case share one), and so is every
combining mark, which many scripts need within words. Only letters that no sample holds share one symbol.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .flat import chunks, map_arrow

#: Bounds of the sample: documents and characters per language, and characters of one document.
SAMPLE_DOCS, SAMPLE_CHARS, DOC_CHARS = 60, 24_000, 1_000
#: Places tried for a row of the packed table before it goes to the end.
TRIES = 32
#: Characters of a piece; a phrase ends with its piece.
PIECE = 2_000
UNKNOWN = "und"
LOW = (1 << 32) - 1


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Code points of all letters, and of their lower case where that is one character."""
    code = [c for c in range(0x110000) if chr(c).isalpha()]
    return np.array(code), np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in code])


def _mark(c: str) -> bool:
    """A combining mark; selectors of a glyph's variant are none."""
    return category(c)[0] == "M" and not (0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF)


def symbol_table(samples: Iterable[str] = ()) -> np.ndarray:
    """Symbol of every code point: 0 is the break between words, then come the letters below 0x100 in order of code,
    then the other letters and marks of the samples; all further letters share the last one."""
    code, low = _letters()
    basic = sorted({int(x) for c, x in zip(code[code < 0x250], low[code < 0x250], strict=True) if x < 0x100})
    seen = {c for t in samples for c in set(t)}
    small = dict(zip(code.tolist(), low.tolist(), strict=True)) if seen else {}
    more = {small[ord(c)] if ord(c) in small else ord(c) for c in seen if ord(c) in small or _mark(c)}
    own = [*basic, *sorted(more - set(basic))]
    number = np.zeros(0x110000, np.uint8 if len(own) < 255 else np.uint32)
    number[own] = np.arange(1, len(own) + 1)
    table = number.copy()
    table[code] = np.where(number[low] > 0, number[low], len(own) + 1)
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a text with runs of breaks as one, none at the ends."""
    s = table[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s = s[keep]
    return s[(1 if len(s) and s[0] == 0 else 0):(len(s) - 1 if len(s) > 1 and s[-1] == 0 else None)]


def suffix_automaton(s: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state of the automaton of all substrings of s; 0 is the start."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in s.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def packed(rows: list[dict[int, int]], width: int) -> tuple[np.ndarray, int]:
    """(slots, place of state 0): rows of transitions laid into each other's gaps, large ones first.

    Every state has a place of its own, and its move by symbol c lies in slot place + c, which holds the place of the
    state it belongs to (low 32 bits, -1 in a free slot) and that of the next state (high 32 bits).
    """
    place = [0] * len(rows)
    used, taken, first = bytearray(width), bytearray(width), 0
    end = 0  # no slot from here on is used, no place taken
    for state in sorted(range(len(rows)), key=lambda k: -len(rows[k])):
        row = sorted(rows[state])
        at = end
        if row:
            while used[first]:
                first += 1
            slot = first
            for _ in range(TRIES):
                slot = used.find(0, slot, end)
                if slot < 0:
                    break
                b = slot - row[0]
                if b >= 0 and not taken[b] and not any(used[b + c] for c in row):
                    at = b
                    break
                slot += 1
        place[state] = at
        if len(used) < at + 2 * width + 1:
            used.extend(bytes(len(used) + 2 * width))
            taken.extend(bytes(len(taken) + 2 * width))
        taken[at] = 1
        for c in row:
            used[at + c] = 1
        end = max(end, at + 1, at + row[-1] + 1 if row else 0)
    owner, to = np.full(end + width, -1, np.int64), np.full(end + width, -1, np.int64)
    for b, row in zip(place, rows, strict=True):
        for c, target in row.items():
            owner[b + c], to[b + c] = b, place[target]
    return np.stack([owner, to]), place[0]


@dataclass
class Languages:
    """Automata of all languages in one packed table: language k starts at place start[k]."""

    names: list[str]
    moves: np.ndarray
    start: np.ndarray
    bits: np.ndarray
    table: np.ndarray

    @classmethod
    def learn(cls, texts: dict[str, str]) -> Languages:
        table = symbol_table(texts.values())
        width = int(table.max()) + 1
        names, parts, start, bits = sorted(texts), [], [], []
        at = 0
        for name in names:
            s = symbols(texts[name], table)
            pair, root = packed(suffix_automaton(s), width)
            pair[pair >= 0] += at
            parts.append(pair[0] & LOW | pair[1] << 32)
            start.append(at + root)
            bits.append(np.log2(len(s) + 2))
            at += pair.shape[1]
        moves = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return cls(names, moves, np.array(start, np.int64), np.array(bits), table)

    def phrases(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Phrases of each piece in each language (pieces x languages)."""
        k = len(self.names)
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        sizes = np.array([len(pieces[i]) for i in order])
        count = np.zeros((len(pieces), k), np.int64)
        if not len(pieces) or not sizes[0]:
            return count
        body = np.zeros((sizes[0], len(pieces)), self.table.dtype)
        for col, i in enumerate(order):
            body[:sizes[col], col] = pieces[i]

        def step(state: np.ndarray, c: np.ndarray) -> np.ndarray:
            found = self.moves[state + c]
            return np.where(found & LOW == state, found >> 32, -1)

        state = np.repeat(self.start[None], len(pieces), 0)
        state_start = np.repeat(self.start[None], len(pieces), 0)
        count[sizes > 0] = 1
        alive = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        for t in range(sizes[0]):
            n = alive[t]
            c = body[t, :n, None].astype(np.int64)
            to = step(state[:n], c)
            stuck = to < 0
            if stuck.any():
                again = step(state_start[:n][stuck], np.broadcast_to(c, stuck.shape)[stuck])
                to[stuck] = np.where(again < 0, state_start[:n][stuck], again)
                if t:
                    count[:n] += stuck & (state[:n] != state_start[:n])
                # a symbol that the language does not know is a phrase of its own
                lost = np.zeros(stuck.shape, bool)
                lost[stuck] = again < 0
                count[:n] += lost
            state[:n] = to
        out = np.zeros_like(count)
        out[order] = count
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; und and 0 for a text without a letter, or when nothing was learnt."""
        pieces, owner, length = [], [], np.zeros(len(texts))
        for i, t in enumerate(texts):
            if t and any(map(str.isalpha, t)):
                s = symbols(t, self.table)
                length[i] = len(s)
                for at in range(0, len(s), PIECE):
                    pieces.append(s[at:at + PIECE])
                    owner.append(i)
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not pieces or not self.names:
            return names, score
        total = np.zeros((len(texts), len(self.names)))
        np.add.at(total, np.array(owner), self.phrases(pieces))
        seen = np.flatnonzero(length)
        cost = total[seen] * self.bits / length[seen, None]
        best = cost.argmin(1)
        odds = np.exp2(np.minimum(0, (cost.min(1)[:, None] - cost) * np.minimum(length[seen, None], 100)))
        for i, b in zip(seen, best, strict=True):
            names[i] = self.names[b]
        score[seen] = 1 / odds.sum(1)
        return names, score


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Languages:
    """From rows (doc_id, text, lang) with text and non-null lang: of each language the documents whose hashed ids are
    smallest, DOC_CHARS characters of each, up to the bounds of the sample."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", F.col("doc_id"), F.substring("text", 1, DOC_CHARS).alias("text"))
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    texts: dict[str, list[str]] = {}
    for r in rows.withColumn("k", F.row_number().over(w)).where(F.col("k") <= sample_docs).orderBy("lang", "k").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    return Languages.learn({k: "\n".join(v)[:sample_chars] for k, v in texts.items()})


def identified(docs: DataFrame, model: Languages) -> DataFrame:
    """(doc_id, lang_pred, score), a row per row of docs.

    A null text and a text without a letter are und with score 0. Equal costs go to the first language by name.
    Letters that no sample holds count as one unknown letter. Repeated rows and null ids are like any others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.names, model.moves, model.start, model.bits, model.table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = Languages(*shared.value)
        for b in chunks(batches):
            names, score = languages.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(plain, run, "doc_id long, lang_pred string, score double")
