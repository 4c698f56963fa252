"""Centroid clustering, token counts and alignment against plain versions."""

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import awkward_rows
from pyspark.sql import functions as F

from rillstream.llm import align, bpe, kmeans
from rillstream.llm.queries import CATALOG

# ---------------------------------------------------------------- clustering


def plain_kmeans(rows, k, rounds, dim, scale, salt):
    """rows: (vec_id, components). Lloyd's rounds with Python integers."""
    pts = [(i, [math.floor(scale * float(x)) for x in e]) for i, e in rows
           if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    starts = sorted((hashlib.sha256(f"{salt}{i}".encode()).hexdigest(), v) for i, v in pts if i is not None)
    c = [v for _, v in starts[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m, strict=True)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in pts:
            groups[nearest(v)[1]].append(v)
        for j, g in groups.items():
            c[j] = [sum(col) // len(g) for col in zip(*g, strict=True)]
    if not c:
        return []
    out = [(i, *nearest(v)[::-1]) for i, v in pts]
    per = Counter()
    for _, j, d in out:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return [(i, j, d, per[j], sum(per.values()), sha[j]) for i, j, d in out]


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_clustering_query_equals_plain_rounds(spark, data_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data_dir}/embeddings.parquet").collect()]
    got = CATALOG["op11_clustering"].run(spark, data_dir).collect()
    assert by_text(got) == by_text(plain_kmeans(rows, 8, 10, 64, 1024, "3:"))


def test_clustering_awkward(spark):
    rows = [(i % 23, [float(x) for x in np.random.default_rng(i).integers(-3, 4, 4)]) for i in range(60)]  # many ties
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (70, None), (71, [1.0, None, 1.0, 1.0]), (72, [float("nan")] * 4), (73, [1.0] * 3),
             (74, [float("-inf")] * 4), (75, [-0.0005, 0.00049, -1e-9, 0.0]), (76, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {"cluster": F.lit("x"), "distance": F.lit("y"), "v": F.lit(1)})
    for k, rounds in ((3, 4), (1, 2), (8, 0), (200, 3)):
        got = kmeans.report(*kmeans.clustered(df, k, rounds, 4, 1024, "3:")).collect()
        assert by_text(got) == by_text(plain_kmeans(rows, k, rounds, 4, 1024, "3:"))
    too_large = spark.createDataFrame([(1, [1e30] * 4), (2, [0.5] * 4)], df.select("vec_id", "embedding").schema)
    assert [r.vec_id for r in kmeans.clustered(too_large, 2, 2, 4)[0].collect()] == [2]
    assert kmeans.report(*kmeans.clustered(df.limit(0), 3, 2, 4)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_bounds_never_lose_the_nearest_and_save_distances(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-4000, 4000, (12, 5))
    x = (centres[rng.integers(0, 12, 3000)] + rng.integers(-300, 300, (3000, 5))).astype(np.int64)
    c, old = x[:12].copy(), None
    near, second = np.full(3000, -1), np.full(3000, -1)
    upper = lower = np.zeros(3000)
    measured = 0
    for _ in range(8):
        near, second, upper, lower, m = kmeans.assign(x, kmeans.Geometry.of(c, old), near, second, upper, lower)
        measured += m
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (near == d.argmin(1)).all()  # argmin takes the smallest number of equal ones
        assert (upper ** 2 >= d[np.arange(3000), near]).all()
        rest = d.astype(float)
        rest[np.arange(3000), near] = np.inf
        assert (lower ** 2 <= rest.min(1)).all() and (second != near).all()
        old, c = c, np.array([x[near == j].sum(0) // max(1, (near == j).sum()) if (near == j).any() else c[j] for j in range(12)])
    assert measured < 8 * 3000 * 12 / 2


def test_clusters_move_exactly_with_their_vectors(spark):
    """Sums are only corrected by the vectors that changed: after many rounds they are still those of all vectors."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got, c = kmeans.clustered(df, 5, 30, 3)
    assert by_text(kmeans.report(got, c).collect()) == by_text(plain_kmeans(rows, 5, 30, 3, 1024, "3:"))


# ---------------------------------------------------------------- token counts


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges.load(bpe.default_file())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_file())


ODD = ["", " ", "a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "'s 'LL don't", "\r\n\t x", " " * 3000, "ab" * 4000,
       "a" * 9000, "ᲉᲉ x՘y \U00033500a 1\U00010d40", "中文 \U0001F600é ½² ٣", "\x00\x85  　"]


def slow_count(merges, piece):
    """The merge rule itself: of all adjacent pairs the one of lowest rank, leftmost of equals, until none is left."""
    parts = [merges.symbols[b] for b in piece.encode()]
    while True:
        found = [(merges.ranks[a << 32 | b], k) for k, (a, b) in enumerate(itertools.pairwise(parts)) if a << 32 | b in merges.ranks]
        if not found:
            return len(parts)
        value, k = min(found)
        parts[k:k + 2] = [value & 0xFFFFFFFF]


def test_merging_equals_the_plain_rule(merges):
    rnd = random.Random(0)
    for _ in range(300):
        piece = "".join(rnd.choice("aeiotnsrhld éü中 ") for _ in range(rnd.randrange(1, 30)))
        assert merges.count(piece.encode()) == slow_count(merges, piece)


def test_counts_equal_the_library(merges, library):
    rnd = random.Random(1)
    some = [chr(rnd.randrange(0x21, 0x110000)) for _ in range(4000)]
    texts = ODD + ["".join(rnd.choices(["the", " ", "  ", "\n", "'re", "1", "É", *some[k:k + 5]], k=rnd.randrange(40))) for k in range(3000)]
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    counter = bpe.Counter(merges)
    assert [counter.of(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_token_query_equals_the_library(spark, data_dir, library):
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, len(r.text.encode()), n := len(library.encode(r.text, add_special_tokens=False).ids), n > 1024) for r in rows]
    assert by_text(CATALOG["op12_token_counts"].run(spark, data_dir).collect()) == by_text(want)


def test_token_counts_awkward(awkward, nothing, merges, library):
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100)
            for i, t, *_ in awkward_rows()]
    got = bpe.counted(awkward.withColumn("n_tokens", F.lit("x")), merges, 100)
    assert by_text(got.collect()) == by_text(want)
    assert bpe.counted(nothing, merges).collect() == []


def test_remembered_pieces_stay_bounded(merges, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    counter = bpe.Counter(merges)
    for k in range(40):
        counter.of(" ".join(f"w{k}x{j}" for j in range(20)))
    assert len(counter) < 200
    long = "a" * (bpe.LONGEST_REMEMBERED + 1)
    counter.of(long)
    assert long not in counter


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        bpe.Merges.load(public_tokenizers.path("word_bpe_49k.json"))


# ---------------------------------------------------------------- alignment


@pytest.fixture(scope="module")
def toks():
    return align.Tokenizers.load(*align.default_files())


@pytest.fixture(scope="module")
def worker(toks):
    return align.Worker(toks)


def library_a(toks, text, made={}):  # noqa: B006
    from tokenizers import Tokenizer

    if not made:
        made[0] = Tokenizer.from_str(toks.a_spec)
        made[0].encode_special_tokens = True
    return made[0].encode(text, add_special_tokens=False).ids


def plain_alignment(worker, toks, t):
    """(A ids, B ids, groups as text, links) of one text, token by token."""
    t = t or ""
    want = (" " + t).encode()
    a, b = library_a(toks, " " + t), worker.b.encode(t)
    ab, bb = [toks.a_bytes[i] for i in a], [toks.b_bytes[i] for i in b]
    if not t or b"".join(ab) != want or b"".join(bb) != want:
        return [], [], "", []
    ea, eb = ([0, *itertools.accumulate(map(len, x))] for x in (ab, bb))
    both, groups, x, y = sorted(set(ea[1:]) & set(eb[1:])), [], 0, 0
    for end in both:
        i, j = ea.index(end), eb.index(end)
        groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        x, y = i, j
    links, j0 = [], 0
    for i in range(len(a)):
        while eb[j0 + 1] <= ea[i]:
            j0 += 1
        j = j0
        while j < len(b) and eb[j] < ea[i + 1]:
            links.append((a[i], b[j]))
            j += 1
    return a, b, ";".join(groups), links


def plain_rows(worker, toks, rows):
    each = [(i, *plain_alignment(worker, toks, t)) for i, t in rows]
    held, top = Counter(), Counter()
    for *_, links in each:
        held.update(set(links))
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return [(i, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), sum(held[x] == top[x[0]] for x in links),
             sum(held[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
            for i, a, b, groups, links in each]


STRANGE = [None, "", "▁x", "a", "中文字 ab", "<s> hi </s> <|endoftext|>", "ab\0c", "  lead", "\n\nx", "\U0001F600\U0001F600 é", "a" * 900,
           "12345678901234567890", "<unk> x", "<0x41>", "   "]


def test_alignment_of_single_texts(worker, toks):
    rnd = random.Random(3)
    pool = ["a", "the", " ", "  ", "é", "中", "\n", "1", "<unk>", "\U0001F600", "ing", "▁", "Ünter"]
    texts = STRANGE + ["".join(rnd.choices(pool, k=rnd.randrange(25))) for _ in range(300)]
    x = worker.align(pa.array(texts, pa.string()))
    want = [plain_alignment(worker, toks, t) for t in texts]
    assert x.written() == [w[2] for w in want]
    link_a, link_b, first = x.links()
    for k, (_, _, _, links) in enumerate(want):
        mine = slice(first[k], first[k + 1])
        assert list(zip(x.a[link_a[mine]].tolist(), x.b[link_b[mine]].tolist(), strict=True)) == links


@pytest.mark.parametrize("seed", range(5))
def test_divide_and_conquer_finds_every_shared_cut(seed):
    rng = np.random.default_rng(seed)
    share = (0.0, 0.02, 0.5, 0.95, 1.0)[seed]  # of A's ends that B has too
    ends_a, ends_b, first, base = [], [], [0], 0
    for n in (0, 1, 2, 3, 700, 0, 1, 50):
        ends = base + np.cumsum(rng.integers(1, 6, n)) if n else np.zeros(0, np.int64)
        inner = ends[:-1][rng.random(max(n - 1, 0)) < share]
        extra = np.setdiff1d(rng.integers(base + 1, ends[-1], n // 2), ends) if n > 1 else np.zeros(0, np.int64)
        ends_a.append(ends)
        ends_b.append(np.union1d(np.append(inner, ends[-1:]), extra))
        base = int(ends[-1]) if n else base
        first.append(first[-1] + n)
    a, b = np.concatenate(ends_a).astype(np.int64), np.concatenate(ends_b).astype(np.int64)
    assert a[align.shared_cuts(a, b, np.array(first))].tolist() == np.intersect1d(a, b).tolist()


def test_alignment_query_equals_the_plain_version(spark, data_dir, worker, toks):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert by_text(CATALOG["op13_alignment"].run(spark, data_dir).collect()) == by_text(plain_rows(worker, toks, rows))


@pytest.mark.parametrize("frequent", [0, 40, 10 ** 6])
def test_alignment_awkward_whether_pairs_are_broadcast_or_joined(spark, awkward, nothing, worker, toks, frequent):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(STRANGE)], "doc_id long, text string")
    rows = [(i, t) for i, t, *_ in awkward_rows()] + [(100 + i, t) for i, t in enumerate(STRANGE)]
    both = awkward.unionByName(extra, allowMissingColumns=True).withColumns({"n_a": F.lit("x"), "__rid": F.lit(1), "pair": F.lit(2)})
    got = align.aligned(both.repartition(3), toks, frequent=frequent)
    assert by_text(got.collect()) == by_text(plain_rows(worker, toks, rows))
    assert align.aligned(nothing, toks, frequent=frequent).collect() == []


def test_alignment_keeps_columns_of_its_own_names(awkward, toks):
    out = align.aligned(awkward, toks, keep=("rid", "words", "doc_id"))
    assert out.columns[:3] == ["rid", "words", "doc_id"] and out.count() == awkward.count()


def test_groups_are_the_alignments_themselves(spark, toks, worker):
    texts = ["The ferry left.", None, "zwölf Boxkämpfer \U0001F600"]
    rows = align.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), toks).collect()
    for r in rows:
        a, b, text, _ = plain_alignment(worker, toks, texts[r.doc_id])
        assert (r.a_ids, r.b_ids) == (a, b)
        ends = list(zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends, strict=False))
        assert ";".join(",".join(map(str, a[w:x])) + "|" + ",".join(map(str, b[y:z])) for w, x, y, z in ends) == text


def test_encoding_and_decoding_share_a_worker(spark):
    """The pipeline's last stage encodes and decodes in one pass, with the columns of two."""
    import corpus_pipeline
    from rillstream.llm import pieces

    docs = spark.createDataFrame(
        [(1, "Café au  lait", "old"), (2, None, "x"), (3, "", None), (4, "word " * 300, "y")],
        "doc_id long, text string, decoded string")
    model = pieces.Pieces.load(pieces.default_model())
    one = pieces.encoded(docs, model, decoded="decoded")
    two = pieces.decoded(pieces.encoded(docs, model), model)
    assert one.columns == two.columns and sorted(one.collect()) == sorted(two.collect())
    plan = corpus_pipeline.sentencepiece(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_language_model_folds_bounded_slices(monkeypatch):
    """Pairs of a task are folded some at a time, those of equal two nearest bytes together; results are the same."""
    import numpy as np
    from rillstream.llm import lm

    rnd = np.random.default_rng(1)
    pair = np.unique(rnd.integers(97, 105, (5000, 7)).dot(1 << (8 * np.arange(7))))
    n = rnd.integers(0, 9, len(pair))
    monkeypatch.setattr(lm, "SLICE", 100)
    parts = list(lm._slices(pair, n))
    assert max(len(p) for p, _ in parts) <= 100 and sorted(np.concatenate([p for p, _ in parts])) == sorted(pair)
    groups = [set(p & 0xFFFF00) for p, _ in parts]
    assert sum(map(len, groups)) == len(set.union(*groups))
    top = lm.top_levels(*lm._heads(pair, n))
    whole = dict(zip(pair, lm.pair_logs(pair, n, top)))
    assert all(abs(whole[k] - x) < 1e-12 for p, m in parts for k, x in zip(p, lm.pair_logs(p, m, top)))
    assert not list(lm._slices(pair[:0], n[:0]))


def test_alignment_splits_ascii_texts_alike_and_starts_anew(worker, monkeypatch):
    """The written-out pattern gives the pieces of the general one; ids do not depend on what a task remembers."""
    import random

    rnd = random.Random(4)
    texts = [chr(i) + chr(j) for i in range(128) for j in (*range(34), 39, 65, 97, 127)]
    texts += ["".join(rnd.choices(" \t\n\x0b\x1c\x1f'sdltrevm09aZ!_", k=20)) for _ in range(2000)]
    assert all(align.ASCII.findall(t) == worker.a.usual.findall(t) for t in texts)
    ids, first = worker.a.laid(texts)
    monkeypatch.setattr(align, "REMEMBERED", 0)
    again, first_again = worker.a.laid(texts + ["é x", ""])
    assert again[:len(ids)].tolist() == ids.tolist() and first_again[:len(first)].tolist() == first.tolist()
    assert first_again[-1] == first_again[-2] and len(worker.a.ends) > 1


def test_language_model_contexts_are_always_six_bytes(spark, tmp_path):
    """op9_lm against the definition: what one more bit adds to the weighted probability of the training bits."""
    import zlib

    texts = ["new york new york", "new jersey", "a york", "new  york\nnew", "\0a b", "naïve york", "new york", "new jork", "", None]
    rows = [(i, t) for i, t in enumerate(texts * 2)]
    learned = [t or "" for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    assert 0 < len(learned) < len(rows)

    def steps(text):
        data = b" " * 6 + text.encode()
        for at in range(6, len(data)):
            for bit in range(8):
                yield (1 << bit) + (data[at] >> 8 - bit), data[at - 6:at], data[at] >> 7 - bit & 1

    seen = {}
    for text in learned:
        for decision, context, bit in steps(text):
            seen.setdefault(decision, {}).setdefault(context, [0, 0])[bit] += 1

    def weighted(counts, depth):
        a, b = map(sum, zip(*counts.values()))
        own = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
        if depth == 6:
            return own
        parts = {}
        for context, n in counts.items():
            parts.setdefault(context[5 - depth], {})[context] = n
        return np.logaddexp(own, sum(weighted(p, depth + 1) for p in parts.values())) - math.log(2)

    def score(text):
        total = 0.0
        for decision, context, bit in steps(text):
            was = seen.get(decision, {})
            now = was | {context: [n + (k == bit) for k, n in enumerate(was.get(context, (0, 0)))]}
            total += weighted(now, 0) - (weighted(was, 0) if was else 0.0)
        return total / math.log(10)

    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in CATALOG["op9_lm"].run(spark, str(tmp_path)).collect()}
    assert got == pytest.approx({i: score(t or "") for i, t in rows}, rel=1e-9)


def test_language_model_counts_in_parts(spark, monkeypatch):
    """A task that hands over its pairs several times counts what a plain loop counts."""
    from rillstream.llm import lm

    texts = [f"{i % 7} some words {i}" for i in range(60)] + ["", "é"]
    want, words = Counter(), Counter()
    for i, t in enumerate(texts):
        data = b" " * 6 + t.encode()
        for at in range(6, len(data)):
            want[int.from_bytes(data[at - 6:at + 1], "big")] += i % 2
        for w in t.encode().split():
            words[w] += i % 2
    docs = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, train int")
    for gathered in (10, 10_000):
        monkeypatch.setattr(lm, "GATHERED", gathered)
        counted = lm.unit_counts(docs)
        assert {r.pair: r.n for r in lm.pair_counts(counted, lm.WHOLE).collect()} == want
        assert Counter(r.n for r in lm.word_counts(counted).collect()) == Counter(words.values())
    assert lm.pair_counts(counted.where(F.lit(False)), lm.WHOLE).count() == 0
