"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans.

The field segments windows of tokens around digits, @ and "at" in brackets that no base span explains; a bare word "at"
opens no window. A window goes on as long as such places follow each other, however long that is. A segment is one
ordinary token or an entity of at most ``LONGEST`` tokens; its score sums weights of features of the whole span, so
digit counts, checksums and shapes across tokens decide boundaries and type jointly, by dynamic programming over
segment ends, in time and memory linear in the window. It is trained here by conditional likelihood on a bounded sample of the documents, whose base matches
(also rewritten the way people disguise them) are the entities and everything else is not.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import chunks, map_arrow

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits that fails from its start fails from inside too, so matches are tried at run starts only
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in _DOMAIN.finditer(text):
        a = m.start()
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            end = m.end()
            yield a, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and not overlapping within a kind, in order."""
    out = []
    if "@" in text:
        out += [(a, 0, z) for a, z in emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = only_digits(m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(only_digits(m[0])) <= 15]
    return sorted(out)


_DIGIT = re.compile("[0-9]")
_TRIGGER = re.compile(r"[0-9@]|(?i:[\[({]\s?at\s?[\])}])")
_TOKEN = re.compile(r"\S+")
_TRIM_LEFT, _TRIM_RIGHT = ".,;:!?\"'#$%&*<>|=", ".,;:!?\"'#$%&*<>|=(["
LONGEST, AROUND = 6, 4
#: Bounds of the training sample: documents with a trigger, windows, and tokens of one.
TRAIN_DOCS, TRAIN_WINDOWS, TRAIN_TOKENS, EPOCHS = 600, 300, 64, 15
_AT, _DOT = re.compile(r"(?i)\s?[\[({]\s?at\s?[\])}]\s?"), re.compile(r"(?i)\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?")
_CUES = (("mail", "contact"), ("ip", "host", "server", "address"), ("card", "visa", "credit", "pan"),
         ("phone", "tel", "call", "mobile", "fax"))


@dataclass
class Window:
    """Tokens (start, end) of a piece of text."""

    text: str
    tokens: list[tuple[int, int]]

    def span(self, i: int, j: int) -> tuple[int, int]:
        """Characters of tokens i..j-1 without punctuation around them."""
        a, z = self.tokens[i][0], self.tokens[j - 1][1]
        while a < z and self.text[a] in _TRIM_LEFT:
            a += 1
        while z > a and self.text[z - 1] in _TRIM_RIGHT:
            z -= 1
        return a, z


FEATURES = 34


def span_features(w: Window, i: int, j: int) -> np.ndarray:
    """What a whole segment looks like."""
    a, z = w.span(i, j)
    s = w.text[a:z]
    x = np.zeros(FEATURES)
    x[0] = 1
    if not s:
        x[1] = 1
        return x
    d = only_digits(s)
    n = len(d)
    x[2 + (n > 0) + (n > 3) + (n > 6) + (n > 9) + (n > 12) + (n > 15) + (n > 19)] = 1  # 2..9
    plain = _DOT.sub(".", _AT.sub("@", s))
    x[10] = sum(1 for _ in emails(plain)) == 1 and next(emails(plain)) == (0, len(plain))
    parts = re.split(r"[.,·]|\s?[\[({]\.[\])}]\s?", s)
    x[11] = len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in parts)
    phone = bool(re.fullmatch(r"(?:\+|00)?[0-9().\x20/-]+", s))
    x[12] = phone and 10 <= n <= 15
    x[13] = s.startswith(("+", "00"))
    x[14] = bool(re.fullmatch(r"[0-9](?:[\x20./-]?[0-9])+", s)) and 14 <= n <= 19
    x[15] = 14 <= n <= 19 and luhn(d)
    x[16] = sum(c.isalpha() for c in s) > 0.5 * len(s)
    x[17] = phone and "(" in s and ")" in s
    groups = len(re.findall(r"[0-9]+", s))
    x[18 + min(groups, 5)] = 1  # 18..23
    x[24] = j - i
    x[25] = x[14] * x[15]
    x[26] = x[12] * x[13]
    x[27] = bool(re.search(r"[\[({]", s)) and x[10]
    before = w.text[max(0, w.tokens[i][0] - 24):w.tokens[i][0]].lower()
    for k, cues in enumerate(_CUES):
        x[28 + k] = any(c in before for c in cues)
    x[32] = any(not (c.isalnum() or c in " +-.()[]@/_%") for c in s)
    x[33] = x[12] * (2 <= groups <= 4)
    return x


@dataclass
class Field:
    """weights[label, feature] and moves[label before, label]; label 0 is ordinary text, then KINDS."""

    weights: np.ndarray
    moves: np.ndarray

    @classmethod
    def empty(cls) -> Field:
        return cls(np.zeros((5, FEATURES)), np.zeros((5, 5)))

    def segments(self, w: Window) -> dict[tuple[int, int], np.ndarray]:
        """Feature vectors of all segments; an entity must hold a digit, @ or "at" in brackets."""
        out = {}
        n = len(w.tokens)
        for i in range(n):
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                if j == i + 1 or _TRIGGER.search(w.text, w.tokens[i][0], w.tokens[j - 1][1]):
                    out[i, j] = span_features(w, i, j)
        return out

    def scores(self, w: Window, segs) -> dict[tuple[int, int], np.ndarray]:
        return {(i, j): self.score(x, i, j, self.triggered(w, i, j)) for (i, j), x in segs.items()}

    @staticmethod
    def triggered(w: Window, i: int, j: int) -> bool:
        return bool(_TRIGGER.search(w.text, w.tokens[i][0], w.tokens[j - 1][1]))

    def score(self, x: np.ndarray, i: int, j: int, triggered: bool) -> np.ndarray:
        s = self.weights @ x
        if j > i + 1:
            s[0] = -np.inf
        if not triggered:
            s[1:] = -np.inf
        return s

    def best(self, w: Window) -> list[tuple[int, int, int]]:
        """The segmentation of highest score, entities only: (first token, label, token after).

        Segments are scored as the search meets them, so a long window holds two small rows per token and no features.
        """
        n = len(w.tokens)
        value = np.full((n + 1, 5), -np.inf)
        value[0, 0] = 0
        back = np.zeros((n + 1, 5, 2), np.int32)
        for j in range(1, n + 1):
            for i in range(max(0, j - LONGEST), j):
                triggered = self.triggered(w, i, j)
                if j > i + 1 and not triggered:
                    continue
                reach = value[i][:, None] + self.moves
                prev = reach.argmax(0)
                total = reach[prev, np.arange(5)] + self.score(span_features(w, i, j), i, j, triggered)
                for y in np.flatnonzero(total > value[j]):
                    value[j, y] = total[y]
                    back[j, y] = i, prev[y]
        out, j, y = [], n, int(value[n].argmax())
        while j > 0:
            i, prev = map(int, back[j, y])
            if y:
                out.append((i, y, j))
            j, y = i, prev
        return out[::-1]

    def gradient(self, w: Window, segs, gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Observed minus expected features, by forward and backward sums over segmentations."""
        n = len(w.tokens)
        scores = self.scores(w, segs)
        fwd = np.full((n + 1, 5), -np.inf)
        fwd[0, 0] = 0
        for j in range(1, n + 1):
            for i in range(max(0, j - LONGEST), j):
                if (i, j) in scores:
                    fwd[j] = np.logaddexp(fwd[j], np.logaddexp.reduce(fwd[i][:, None] + self.moves, 0) + scores[i, j])
        bwd = np.full((n + 1, 5), -np.inf)
        bwd[n] = 0
        for i in range(n - 1, -1, -1):
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                if (i, j) in scores:
                    bwd[i] = np.logaddexp(bwd[i], np.logaddexp.reduce(self.moves + (scores[i, j] + bwd[j])[None], 1))
        z = np.logaddexp.reduce(fwd[n])
        gw, gm = np.zeros_like(self.weights), np.zeros_like(self.moves)
        for (i, j), s in scores.items():
            p = np.exp(fwd[i][:, None] + self.moves + (s + bwd[j])[None] - z)
            gm -= p
            gw -= p.sum(0)[:, None] * segs[i, j][None]
        at, prev, entity = 0, 0, {i: (y, j) for i, y, j in gold}
        while at < n:
            y, j = entity.get(at, (0, at + 1))
            gw[y] += segs[at, j]
            gm[prev, y] += 1
            at, prev = j, y
        return gw, gm


def windows(text: str, explained: list[tuple[int, int, int]]) -> list[Window]:
    """Token windows around triggers outside the spans ``explained``; each ends only where no trigger is near."""
    places, k = [], 0
    spans = sorted((a, z) for a, _, z in explained)
    reach = 0
    for m in _TRIGGER.finditer(text):
        while k < len(spans) and spans[k][0] <= m.start():
            reach = max(reach, spans[k][1])
            k += 1
        if m.start() >= reach:
            places.append(m.start())
    if not places:
        return []
    out, tokens, after, i = [], [], 0, 0
    recent: list[tuple[int, int]] = []
    for m in _TOKEN.finditer(text):
        a, z = m.span()
        hit = i < len(places) and places[i] < z
        while i < len(places) and places[i] < z:
            i += 1
        if hit:
            if not tokens:
                tokens = recent[-AROUND:]
            after = AROUND + 1
        if after:
            tokens.append((a, z))
            after -= 1
            if not after:
                out.append(Window(text, tokens))
                tokens, after, recent = [], 0, []
                continue
        recent = [*recent[-AROUND:], (a, z)]
        if i >= len(places) and not after:
            break
    if tokens:
        out.append(Window(text, tokens))
    return out


def _gold(w: Window, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]] | None:
    out, last = [], 0
    for a, kind, z in spans:
        hit = [k for k, (s, e) in enumerate(w.tokens) if s < z and e > a]
        if not hit:
            continue
        i, j = hit[0], hit[-1] + 1
        if i < last or j - i > LONGEST or w.tokens[i][0] < a - 3:
            return None
        out.append((i, kind + 1, j))
        last = j
    return out


def _disguised(s: str, kind: int, k: int) -> str:
    if kind == 0:
        return s.replace("@", (" [at] ", " (at) ", "(at)", "@")[k % 4]).replace(".", (" [dot] ", ".", " (dot) ")[k % 3])
    if kind == 1:
        return s.replace(".", ("[.]", ".", "(.)")[k % 3])
    if kind == 2:
        d = only_digits(s)
        sep = (".", "/", " ", "-")[k % 4]
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    return (s.lstrip("+"), s, "00" + s.lstrip("+"), s.replace("-", "/"))[k % 4]


def train(texts: list[str], most: int = TRAIN_WINDOWS, epochs: int = EPOCHS) -> Field:
    """From base matches in the given texts, plain and disguised; without any, a field that adds nothing."""
    examples: list[tuple[Window, list]] = []
    entities = 0
    for t in texts:
        if len(examples) >= most:
            break
        base = base_spans(t)
        parts = (Window(t, w.tokens[at:at + TRAIN_TOKENS]) for w in windows(t, base) for at in range(0, len(w.tokens), TRAIN_TOKENS))
        for w in itertools.islice(parts, 2):
            examples.append((w, []))
        for k, (a, kind, z) in enumerate(base[:3]):
            left, right = t[max(0, a - 30):a], t[z:z + 30]
            if _TRIGGER.search(left) or _TRIGGER.search(right):
                continue
            body = t[a:z] if (k + len(examples)) % 3 == 0 else _disguised(t[a:z], kind, k + len(examples))
            text = f"{left} {body} {right}" if left else f"{body} {right}"
            at = len(left) + 1 if left else 0
            w = Window(text, [m.span() for m in _TOKEN.finditer(text)])
            gold = _gold(w, [(at, kind, at + len(body))])
            if gold:
                examples.append((w, gold))
                entities += 1
    field = Field.empty()
    if not entities:
        field.weights[0, 0] = 1.0
        return field
    step_w, step_m = np.full_like(field.weights, 1e-8), np.full_like(field.moves, 1e-8)
    measured = [(w, field.segments(w), gold) for w, gold in examples]
    for _ in range(epochs):
        for w, segs, gold in measured:
            gw, gm = field.gradient(w, segs, gold)
            gw -= 1e-3 * field.weights
            step_w += gw ** 2
            step_m += gm ** 2
            field.weights += 0.3 * gw / np.sqrt(step_w)
            field.moves += 0.3 * gm / np.sqrt(step_m)
    return field


def all_spans(text: str, field: Field) -> tuple[list, list]:
    """(base spans, all spans); an added span overlaps no base span and starts and ends at a character of its own."""
    base = base_spans(text)
    extra = []
    for w in windows(text, base):
        for i, y, j in field.best(w):
            a, z = w.span(i, j)
            if z > a and not any(s < z and a < e for s, _, e in base):
                extra.append((a, y - 1, z))
    return base, sorted({*base, *extra})


def _named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def fit(docs: DataFrame, most: int = TRAIN_DOCS) -> Field:
    """A field trained on ``most`` documents at most: those with a digit or @ whose hashed ids are smallest."""
    able = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id").alias("h"), "text")
    picked = able.select("h").orderBy("h").limit(most).distinct()  # hashes first: texts of others never move
    rows = able.join(F.broadcast(picked), "h").orderBy("h", "text").limit(most).select("text")
    return train([r["text"] for r in rows.collect()])


def found(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), a row per row of docs.

    Counts and base_sha256 (of kind:start:end, comma-joined, by start and then kind) are those of the base patterns;
    spans also has the added ones. Offsets count code points, ends are exclusive. Null texts count as empty; rows that
    repeat or have a null doc_id are treated like others; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            rows = []
            for t in b.column("text").to_pylist():
                base, every = all_spans(t or "", field)
                n = [sum(k == x for _, k, _ in base) for x in range(4)]
                rows.append((*n, hashlib.sha256(_named(base).encode()).hexdigest(), _named(every)))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5])],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(plain, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, field: Field) -> str:
    """The text with every span, overlapping ones as one, replaced by its kind in angle brackets."""
    out, at = [], 0
    _, every = all_spans(text, field)
    k = 0
    while k < len(every):
        a, kind, z = every[k]
        while k + 1 < len(every) and every[k + 1][0] < z:
            k += 1
            z = max(z, every[k][2])
        out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = z
        k += 1
    return "".join([*out, text[at:]]) if out else text


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """docs with text redacted and n_chars, where there is one, counted anew; null texts stay null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            t = pa.array([None if x is None else redact(x, field) for x in b.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([t if c == "text" else b.column(c) for c in names], names)

    out = map_arrow(docs, run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
