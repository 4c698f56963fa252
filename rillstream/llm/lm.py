"""Language-model scores: context-tree weighting over bytes, beside a smoothed unigram base score.

The byte to come is coded by eight binary decisions. Each decision has a tree of contexts: the six bytes before it, nearest
first, whatever they are (a caller may name bytes at which contexts end sooner). Before a text stand imagined spaces. The
Krichevsky-Trofimov estimates of all depths are mixed with the exact context-tree weights of the training counts. Contexts
are true bytes and none is left out, so the model grows with the corpus.

* (context, byte) pairs are counted from the texts, texts to score included (they count 0 times, so their contexts are in
  the tables too); a task sums its own pairs before Spark does.
* Pairs are partitioned by the three nearest bytes; a task folds its contexts from depth 6 up to 3, depths 2 to 0 are folded
  from at most 65,536 x 255 sums on the driver, and the way down gives each pair its log probability. A task holds the
  distinct pairs that end in its three bytes, never their occurrences.
* Texts look up frequent pairs and frequent words in bounded broadcast tables; the rest are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .flat import SPACE, Flat, chunks, flat, map_arrow, signed, sums_by, words
from .tables import kept

#: At most so many frequent words and frequent pairs are held by every task; the others are joined.
FREQUENT, FREQUENT_PAIRS = 200_000, 2_000_000
#: Pairs that are folded at once; those of equal three nearest bytes are folded whole.
SLICE = 1 << 16
#: Keys that a task gathers before it sums them.
GATHERED = 1 << 22
DEPTH = 6
#: Depth whose nodes the driver folds; deeper ones belong to the task of their NEAREST + 1 nearest bytes.
NEAREST = 2
#: Bytes at which contexts end: whitespace, or none, as the method has it.
WHOLE = np.zeros(256, bool)
#: Set in the keys of words, clear in those of pairs.
WORD = np.uint64(1 << 63)


def unit_counts(texts: DataFrame) -> DataFrame:
    """(unit, n): the bytes of each text of rows (text, train), and whether they count (1) or are only to be scored (0)."""
    return texts.select(F.coalesce("text", F.lit("")).cast("binary").alias("unit"), F.col("train").cast("long").alias("n"))


def pairs_of(f: Flat, ends: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(context << 8 | byte of every byte of the texts, where each text's begin); the nearest byte is lowest. A context
    goes back to the first byte of ``ends``, six at most."""
    before = DEPTH + 2
    data = np.full(len(f.data) + before * f.n, 0x20, np.uint8)
    given = np.ones(len(data), bool)
    given[(f.off[:-1] + before * np.arange(f.n))[:, None] + np.arange(before)] = False
    data[given] = f.data
    given = given[before - 1:]
    key = np.lib.stride_tricks.sliding_window_view(data, before).view(">u8")[:, 0][given].astype(np.int64)
    if not ends.any():
        return key & _mask(DEPTH + 1), f.off
    at = np.arange(len(data))
    last = np.maximum.accumulate(np.where(ends[data], at, -before))
    depth = np.minimum(at[before - 1:] - last[before - 2:-1], DEPTH)[given]
    return key & np.array([_mask(d + 1) for d in range(DEPTH + 1)])[depth], f.off


def _counts(counted: DataFrame, keys_of, name: str) -> DataFrame:
    """(name, n): distinct keys of the rows (unit, n) with the sum of n; keys_of gives (keys, where each row's begin)."""

    def batch(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, n = parts[0]
        for at in range(0, len(key), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at:at + 200_000]) for x in (key, n)], [name, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in chunks(batches, "unit"):
            key, first = keys_of(flat(b.column("unit")))
            n, each = b.column("n").to_numpy(), np.diff(first)
            for w in np.unique(n):
                names, times = np.unique(key[np.repeat(n == w, each)], return_counts=True)
                parts.append((names, times * w))
                size += len(names)
            if size > GATHERED:
                parts = [_summed(parts)]
                size = len(parts[0][0])
                if 2 * size > GATHERED:
                    yield from batch(parts)
                    parts, size = [], 0
        if parts:
            yield from batch([_summed(parts)])

    return map_arrow(counted, run, f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their sums; empties ``parts``, so that no array is held twice."""
    key, n = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(key)
    key = key[order]
    n = n[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    return key[new], np.add.reduceat(n, new) if len(n) else n


def pair_counts(counted: DataFrame, ends: np.ndarray = SPACE) -> DataFrame:
    return _counts(counted, lambda f: pairs_of(f, ends), "pair")


def _word_keys(f: Flat) -> tuple[np.ndarray, np.ndarray]:
    w = words(f)
    return signed(w.hash | WORD), w.first


def word_counts(counted: DataFrame) -> DataFrame:
    return _counts(counted, _word_keys, "word")


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1/2) - log Gamma(1/2) for counts: sums for small ones, Stirling's series beyond."""
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(64) + 0.5))])
    z = np.maximum(n, 64) + 0.5
    far = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) - 0.5 * np.log(np.pi)
    return np.where(n <= 64, small[np.minimum(n, 64).astype(int)], far)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    small = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 65)))])
    z = np.maximum(n, 64) + 1.0
    far = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z ** 3)
    return np.where(n <= 64, small[np.minimum(n, 64).astype(int)], far)


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - _log_factorial(zeros + ones)


def _mask(depth: int) -> int:
    return (1 << 8 * depth) - 1


def _depths(ctx: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of each context: six, or up to the nearest byte of ``ends``."""
    out = np.full(len(ctx), DEPTH)
    for d in range(DEPTH, 0, -1) if ends.any() else ():
        out[ends[ctx >> 8 * (d - 1) & 255]] = d
    return out


@dataclass
class Level:
    """Nodes of one depth: key = context << 8 | decision, counts, log of the weighted probability, share of the node's
    own estimate in the mixture (1 at a leaf)."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    logw: np.ndarray
    own: np.ndarray

    def down(self, begun: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a 1 mixed so far, and what is left for deeper contexts, with this depth added."""
        mine = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        return begun + left * self.own * mine, left * (1 - self.own)


def _level(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray, leaf: np.ndarray) -> Level:
    """Rows of equal key are one node; ``below`` are the log weighted probabilities of children, none for leaves."""
    names, inverse = np.unique(key, return_inverse=True)
    total = lambda x: np.bincount(inverse, weights=x, minlength=len(names))
    a, b, split = total(zeros), total(ones), total(below)
    ends = np.zeros(len(names), bool)
    ends[inverse] = leaf
    kt = _kt(a, b)
    whole = np.where(ends, kt, np.logaddexp(kt, split) + np.log(0.5))
    return Level(names, a, b, whole, np.where(ends, 1.0, np.exp(kt + np.log(0.5) - whole)))


def _nodes(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, zeros, ones) of the eight decisions of each pair, in its whole context."""
    ctx, byte = pair >> 8, pair & 255
    step = np.arange(8)
    key = ctx[:, None] << 8 | (1 << step) + (byte[:, None] >> 8 - step)
    ones = (byte[:, None] >> 7 - step & 1) * n[:, None]
    return key.ravel(), (n[:, None] - ones).ravel(), ones.ravel()


def fold(pair: np.ndarray, n: np.ndarray, lowest: int = NEAREST + 1, ends: np.ndarray = SPACE) -> dict[int, Level]:
    """Levels DEPTH to ``lowest`` of all pairs whose contexts are at least that long, every context being whole."""
    depth = _depths(pair >> 8, ends)
    levels: dict[int, Level] = {}
    for d in range(DEPTH, lowest - 1, -1):
        key, zeros, ones = _nodes(pair[depth == d], n[depth == d])  # contexts that end here are leaves
        parts = [(key, zeros, ones, np.zeros(len(key)), np.ones(len(key), bool))]
        if d < DEPTH:
            up = levels[d + 1]
            parts.append((_up(up.key, d), up.zeros, up.ones, up.logw, np.zeros(len(up.key), bool)))
        levels[d] = _level(*(np.concatenate(x) for x in zip(*parts)))
    return levels


def _up(key: np.ndarray, depth: int) -> np.ndarray:
    return (key >> 8 & _mask(depth)) << 8 | key & 255


def _of(level: Level, key: np.ndarray) -> np.ndarray:
    return np.searchsorted(level.key, key)


def _heads(pair: np.ndarray, n: np.ndarray, ends: np.ndarray = SPACE) -> tuple[np.ndarray, ...]:
    """Rows of depth NEAREST, and of contexts that end sooner, that these pairs bring: (key, zeros, ones, log weighted
    probability of the children)."""
    short = _depths(pair >> 8, ends) <= NEAREST
    low = fold(pair[~short], n[~short], NEAREST + 1, ends)[NEAREST + 1]
    key, zeros, ones = _nodes(pair[short], n[short])
    return tuple(np.concatenate(x) for x in (
        (_up(low.key, NEAREST), key), (low.zeros, zeros), (low.ones, ones), (low.logw, np.zeros(len(key)))))


def top_levels(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray,
               ends: np.ndarray = SPACE) -> tuple[np.ndarray, ...]:
    """(key of depth NEAREST or of a context that ends sooner, probability mixed so far, what is left for deeper contexts).

    A context that ends sooner has a byte of ``ends`` where the others have none, so their keys differ."""
    depth = np.minimum(_depths(key >> 8, ends), NEAREST)
    levels: dict[int, Level] = {}
    for d in range(NEAREST, -1, -1):
        here = depth == d
        parts = [(key[here], zeros[here], ones[here], below[here])]
        if d < NEAREST:
            up = levels[d + 1]
            parts.append((_up(up.key, d), up.zeros, up.ones, up.logw))
        row = [np.concatenate(x) for x in zip(*parts)]
        last = ends[row[0] >> 8 * d & 255] if d else np.zeros(len(row[0]), bool)
        levels[d] = _level(*row, last)
    begun, left = levels[0].down(np.zeros(len(levels[0].key)), np.ones(len(levels[0].key)))
    done = []
    for d in range(1, NEAREST + 1):
        at = _of(levels[d - 1], _up(levels[d].key, d - 1))
        begun, left = levels[d].down(begun[at], left[at])
        whole = ends[levels[d].key >> 8 * d & 255] if d < NEAREST else np.ones(len(begun), bool)
        done.append((levels[d].key[whole], begun[whole], left[whole]))
    names, begun, left = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(names)
    return names[order], begun[order], left[order]


def pair_logs(pair: np.ndarray, n: np.ndarray, top: tuple[np.ndarray, ...], ends: np.ndarray = SPACE) -> np.ndarray:
    """log10 probability of the byte of each pair in its context."""
    names, begun, left = top
    ctx, byte = pair >> 8, pair & 255
    depth = _depths(ctx, ends)
    deep = depth > NEAREST
    levels = fold(pair[deep], n[deep], NEAREST + 1, ends)
    mixed = {d: (names, begun) for d in range(1, NEAREST + 1)}
    upper = names
    for d in range(NEAREST + 1, DEPTH + 1):
        at = np.searchsorted(upper, _up(levels[d].key, d - 1))
        begun, left = levels[d].down(begun[at], left[at])
        upper = levels[d].key
        mixed[d] = upper, begun
    out = np.zeros(len(pair))
    for d, (names, ones) in mixed.items():
        here = depth == d
        for step in range(8):
            key = ctx[here] << 8 | (1 << step) + (byte[here] >> 8 - step)
            p = ones[np.searchsorted(names, key)] if len(key) else np.zeros(0)
            out[here] += np.log10(np.where(byte[here] >> 7 - step & 1, p, 1 - p))
    return out


def _whole(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    table = list(batches)
    column = lambda name: np.concatenate([b.column(name).to_numpy() for b in table] or [np.zeros(0, np.int64)])
    return column("pair"), column("n")


def _slices(pair: np.ndarray, n: np.ndarray, nearest: int = NEAREST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs in parts of about SLICE, those of equal nearest bytes together: below that depth they share
    no node, so a task holds the nodes of one part at a time."""
    group = pair & _mask(nearest) << 8
    order = np.argsort(group, kind="stable")
    begins = np.flatnonzero(np.diff(group[order], prepend=-1))
    ends = np.append(begins[1:], len(order))
    at = 0
    while at < len(order):
        last = max(int(np.searchsorted(ends, at + SLICE, "right")) - 1, int(np.searchsorted(ends, at, "right")))
        part = order[at:ends[last]]
        yield pair[part], n[part]
        at = int(ends[last])


def weighted_pairs(counted: DataFrame, ends: np.ndarray = SPACE) -> DataFrame:
    """(pair, n, logp): every pair with its log10 probability in the weighted tree."""
    spark = counted.sparkSession
    nearest = NEAREST + 1
    placed = kept(counted, "lm-pairs").repartition(F.col("pair").bitwiseAND(F.lit(_mask(nearest) << 8)))

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(*_whole(batches), nearest):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(
                _heads(*part, ends), (np.int64, float, float, float))], ["key", "zeros", "ones", "below"])

    sums = map_arrow(placed, up, "key long, zeros double, ones double, below double").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toArrow()  # at most 65,536 contexts x 255 decisions
    top = spark.sparkContext.broadcast(top_levels(*(sums[c].to_numpy() for c in ("key", "zeros", "ones", "below")), ends))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair, n in _slices(*_whole(batches), nearest):
            logp = pair_logs(pair, n, top.value, ends)
            for at in range(0, len(pair), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + 200_000]) for x in (pair, n, logp)], ["pair", "n", "logp"])

    return map_arrow(placed, down, "pair long, n long, logp double")


def _looked_up(names: np.ndarray, values: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(names):
        return np.zeros(len(key)), np.zeros(len(key), bool)
    i = np.minimum(np.searchsorted(names, key), len(names) - 1)
    hit = names[i] == key
    return np.where(hit, values[i], 0), hit


def _most(counted: DataFrame, at_most: int) -> tuple[DataFrame, DataFrame]:
    """(the rows of largest n, as many whole size classes (an eighth of a doubling) as hold ``at_most`` together; the rest).

    A histogram of some hundred classes sets the limit, so nothing is sorted or gathered beyond the keys themselves.
    """
    size = F.floor(F.log2(F.col("n") + 1) * 8).cast("int")
    limit, held = None, 0
    for r in sorted(counted.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"]):
        held += r["count"]
        if held > at_most:
            break
        limit = r["size"]
    frequent = F.lit(False) if limit is None else size >= limit
    return counted.where(frequent), counted.where(~frequent)


def _held(frequent: DataFrame, *columns: str):
    """The rows as broadcast arrays in the order of the first column."""
    table = frequent.select(*columns).toArrow()
    order = np.argsort(table[columns[0]].to_numpy())
    return frequent.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in columns))


def _sums_and_rest(key: np.ndarray, first: np.ndarray, names: np.ndarray, columns: list[np.ndarray]):
    """(per text the sums of each column over its keys, (text, key, times) of the keys that are not among the names)."""
    of, place = np.unique(key, return_inverse=True)
    found = [_looked_up(names, c, of) for c in columns]
    rest = np.flatnonzero(~found[0][1][place])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[rest]
    code, times = np.unique(text * len(of) + place[rest], return_counts=True)
    return [sums_by(v[place], first) for v, _ in found], (code // max(len(of), 1), of[code % max(len(of), 1)], times)


def scores(docs: DataFrame, training: DataFrame | Column, frequent: int = FREQUENT,
           frequent_pairs: int = FREQUENT_PAIRS, ends: np.ndarray = SPACE) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score), a row per row of docs.

    ``training``: a table of its own, or a condition on docs, which saves a pass over the texts. Tokens are words
    [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, then one end. base_score sums log10((c + 0.1) / (N + 0.1 (V + 1)))
    over the tokens; n_known counts those with c > 0. score is the context tree's log10 probability of the text's bytes
    (0 for an empty text); there is no symbol for its end. ``ends``: bytes at which contexts end; with WHOLE each is six
    bytes long. Null texts count as empty. Without training rows c, N and V are 0 and every byte costs log10 256. Extra
    columns are ignored; repeated rows are each scored.
    """
    text = F.col("text").cast("string").alias("text")
    if isinstance(training, Column):
        seen = docs.select(text, F.coalesce(training, F.lit(False)).cast("int").alias("train"))
    else:
        seen = docs.select(text, F.lit(0).alias("train")).unionByName(training.select(text, F.lit(1).alias("train")))
    counted = unit_counts(seen)
    pairs = kept(weighted_pairs(pair_counts(counted, ends), ends), "lm-logs")
    by_word = kept(word_counts(counted), "lm-words")
    end = int(counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    total = by_word.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_all, distinct = int(total[0]) + end, int(total[1]) + (end > 0)
    log = lambda c: F.log10((c + 0.1) / F.lit(n_all + 0.1 * (distinct + 1)))
    by_word = by_word.select("word", "n", log(F.col("n")).alias("base"), (F.col("n") > 0).cast("long").alias("known"))

    few_words, other_words = _most(by_word, frequent)
    few_pairs, other_pairs = _most(pairs, frequent_pairs)
    held_words, held_pairs = _held(few_words, "word", "base", "known"), _held(few_pairs, "pair", "logp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            f = flat(b.column("text"))
            word, first = _word_keys(f)
            names, *columns = held_words.value
            (base, known), rare_words = _sums_and_rest(word, first, names, columns)
            names, *columns = held_pairs.value
            (logp,), rare_pairs = _sums_and_rest(*pairs_of(f, ends), names, columns)
            of, key, times = (np.concatenate(x) for x in zip(rare_words, rare_pairs))
            o = np.argsort(of, kind="stable")
            at = pa.array(np.searchsorted(of[o], np.arange(f.n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.diff(first).astype(np.int64) + 1), pa.array(known.astype(np.int64)),
                pa.array(base.astype(float)), pa.array(logp.astype(float)), pa.ListArray.from_arrays(at, pa.array(key[o])),
                pa.ListArray.from_arrays(at, pa.array(times[o].astype(np.int32)))],
                ["doc_id", "n_tokens", "n_known", "base", "score", "rare", "times"])

    part = map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), run,
                     "doc_id long, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>")
    part = kept(part.withColumn("row", F.monotonically_increasing_id()), "lm-part")
    rare = part.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("key"), F.col("r.times").alias("times"))
    table = other_words.select(F.col("word").alias("key"), "base", "known", F.lit(0.0).alias("logp")).unionByName(
        other_pairs.select(F.col("pair").alias("key"), F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("known"), "logp"))
    more = rare.join(table, "key").groupBy("row").agg(
        *[F.sum(F.col("times") * F.col(c)).alias(f"more_{c}") for c in ("base", "known", "logp")])
    with_more = lambda name, more, zero: F.col(name) + F.coalesce(more, F.lit(zero))
    return part.drop("rare", "times").join(more, "row", "left").select(
        "doc_id", "n_tokens", (with_more("n_known", "more_known", 0) + int(end > 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (with_more("base", "more_base", 0.0) + log(F.lit(end))).alias("base_score"),
        with_more("score", "more_logp", 0.0).alias("score"))
