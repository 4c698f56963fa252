"""Plain versions of the operators, for small inputs."""

import itertools
import re
from collections import Counter, defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def near_duplicates(rows):
    """doc_id -> (n_shingles, component_id); rows ordered by unique doc_id."""
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if sets[i] and sets[j]
             and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])]
    root = components(len(rows), links)
    return {rows[i][0]: (len(sets[i]), rows[root[i]][0]) for i in range(len(rows))}


def suffix_dedup(rows, length=50):
    """(doc_id, text) in any order -> list of (doc_id, bytes, removed, spans, kept)."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for p in range(len(b) - length + 1):
                k = b[p:p + length]
                first[k] = min(i, first.get(k, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if i is not None and first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def contaminated(docs, items, window=13, different=2, least=9):
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for d, text in docs:
        w = tok(text)
        for k, item in items:
            it = tok(item)
            if len(it) < least:
                continue
            win = min(window, len(it))
            for a in range(len(it) - win + 1):
                part = it[a:a + win]
                if any(sum(x == y for x, y in zip(w[p:p + win], part)) >= win - different
                       for p in range(-different, len(w)) if p >= 0):
                    out.add((d, k))
                    break
    return out


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def personal_data(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = []
    for k, (kind, pattern, ok) in enumerate([
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    ]):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if ok(m[0])]
    return ",".join(x for _, _, x in sorted(found)), Counter(k for _, k, _ in found)


def unigram(texts, train):
    import math
    c = Counter()
    for t in train:
        c.update(words(t))
        c[None] += 1
    n, v = sum(c.values()), sum(1 for x in c.values() if x)
    return [(len(words(t)) + 1, sum(c[x] > 0 for x in [*words(t), None]), n,
             sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in [*words(t), None])) for t in texts]


def first_of(groups):
    out = defaultdict(list)
    for k, x in groups:
        out[k].append(x)
    return {k: min(v) for k, v in out.items()}
