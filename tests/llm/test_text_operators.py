"""Text operators against plain versions, on the smallest table and on awkward rows."""

import functools
import hashlib
import itertools
import math
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import llm_brute as brute  # noqa: E402
from llm_rows import OTHER, PROSE, awkward_rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rillstream.llm import decontam, langid, lm, neardup, pieces, pii, quality, suffix  # noqa: E402
from rillstream.llm.flat import flat, words  # noqa: E402
from rillstream.llm.folds import fold  # noqa: E402


def plain(text_rows):
    return [(r[0], r[1]) for r in text_rows]


@pytest.fixture(scope="module")
def docs(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/documents.parquet").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())


def test_words_are_those_of_the_pattern():
    texts = ["The  cat\n", "", None, "é a\x0bB\x1c c", "end", " lead"]
    w = words(flat(pa.array(texts)))
    assert w.counts.tolist() == [len(brute.words(t)) for t in texts]
    same = [x for t in texts for x in brute.words(t)]
    assert len(set(w.hash.tolist())) == len(set(same))


def test_near_duplicates(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates(rows)


def test_near_duplicates_awkward(awkward, nothing):
    got = neardup.near_duplicates(awkward).collect()
    assert len(got) == len(awkward_rows())
    unique = sorted(dict((r[0], r[1]) for r in awkward_rows() if r[0] is not None).items())
    want = brute.near_duplicates(unique)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert neardup.near_duplicates(nothing).collect() == []


def test_chains_through_dissimilar_ends_are_one_component(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 160)]
    made = []
    for k in range(40):  # each differs a little from the one before, so far ones share little
        made.append((k, " ".join(base)))
        base[4 * k % 150:4 * k % 150 + 3] = [f"x{k}a", f"x{k}b", f"x{k}c"]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(
        spark.createDataFrame(made[::-1], "doc_id long, text string")).collect()}
    assert got == {k: v[1] for k, v in brute.near_duplicates(made).items()}


def test_suffix_dedup(docs, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.deduplicate(docs).collect()}
    assert got == {i: (n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in brute.suffix_dedup(rows)}


def test_suffix_dedup_awkward(awkward, nothing):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.deduplicate(awkward).collect())
    want = brute.suffix_dedup(plain(awkward_rows()))
    assert got == sorted((i or 0, n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in want)
    assert suffix.deduplicate(nothing).collect() == []


def test_suffix_dedup_of_crowded_anchors(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix, "CROWD", 1)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix.deduplicate(docs).collect()}
    assert got == {i: (g, s) for i, _, g, s, _ in brute.suffix_dedup(rows)}


def test_suffix_sort_is_a_sort_and_survives_hash_collisions(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[1000:1200] = data[100:300]
    start = np.arange(0, 3900, 7)
    order = suffix.Suffixes(data).sort(start, np.zeros(len(start), np.int64))
    texts = [data[s:s + 50].tobytes() for s in start[order]]
    assert texts == sorted(texts)
    ids = rng.integers(0, 5, len(start))
    lists = np.sort(rng.integers(0, 3, len(start)))

    def slow():
        least = brute.first_of(((lists[k], data[s:s + 50].tobytes()), ids[k]) for k, s in enumerate(start))
        return [ids[k] > least[lists[k], data[s:s + 50].tobytes()] for k, s in enumerate(start)]

    assert suffix.repeated(data, start, lists, ids).tolist() == slow()
    monkeypatch.setattr(suffix.Prefixes, "sub", lambda self, a, b: (b - a).astype(np.uint64))  # all strings collide
    assert suffix.repeated(data, start, lists, ids).tolist() == slow()


def test_masks_hit_every_window_with_two_differences():
    for bad in itertools.combinations(range(decontam.WINDOW), decontam.DIFFERENT):
        assert any(all(s + o not in bad for o, bit in enumerate(m) if bit == "1")
                   for m in decontam.MASKS for s in range(decontam.WINDOW - len(m) + 1)), bad


def test_masks_hit_every_short_item_with_two_differences():
    for size in range(decontam.MIN_TOKENS, decontam.WINDOW + 1):
        masks = decontam.MASKS if size == decontam.WINDOW else decontam.SHORT_MASKS
        for bad in itertools.combinations(range(size), decontam.DIFFERENT):
            assert any(all(s + o not in bad for o, bit in enumerate(m) if bit == "1")
                       for m in masks for s in range(size - len(m) + 1)), (size, bad)


def test_decontamination_of_short_items_with_every_two_differences(spark):
    items = [(n, " ".join(f"q{n}x{k}" for k in range(n))) for n in range(8, 14)]
    made = []
    for n, text in items:
        for bad in [(), *itertools.combinations(range(n), 1), *itertools.combinations(range(n), 2),
                    *itertools.combinations(range(n), 3)]:
            w = ["zz" if k in bad else x for k, x in enumerate(text.split())]
            made.append((len(made), "so it says " + " ".join(w) + " and ends", n if n > 8 and len(bad) < 3 else None))
    probe = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_tokens in (15, decontam.BLOCK_TOKENS):
        got = {(r.doc_id, r.item_id) for r in decontam.contaminated(probe, bench, block_tokens).collect()}
        assert got == {(i, n) for i, _, n in made if n is not None}


def test_decontamination(spark, data_dir, docs, rows):
    bench = spark.read.parquet(f"{data_dir}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    some = [r for r in rows if len(r[1]) < 2500]
    ids = {i for i, _ in some}
    assert {x for x in got if x[0] in ids} == brute.contaminated(some, items)


def test_decontamination_tolerates_substitutions_and_awkward_rows(spark, awkward, nothing):
    w = PROSE.split()
    swapped = " ".join("zzz" if k in (3, 9) else x for k, x in enumerate(w[:13]))
    bench = spark.createDataFrame([(1, " ".join(w[:13])), (2, None), (3, ""), (4, "short item"), (None, OTHER), (5, OTHER)],
                                  "item_id long, text string")
    probe = spark.createDataFrame([(100, "so " + swapped + " it ends"), (101, " ".join(w[:10])), (None, PROSE)],
                                  "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(probe, bench).collect()} == {(100, 1)}
    got = decontam.marked(awkward, bench).collect()
    assert len(got) == len(awkward_rows())
    assert {(r.doc_id, r["items"]) for r in got if r.contaminated} == {
        (1, "1"), (2, "1"), (3, "1"), (9, "1,5"), (13, "5"), (14, "5")}
    assert decontam.marked(nothing, bench).collect() == []
    assert not any(r.contaminated for r in decontam.marked(awkward, bench.limit(0)).collect())
    blocks = {(r.doc_id, r.item_id) for r in decontam.contaminated(awkward, bench, block_tokens=20).collect()}
    assert blocks == {(r.doc_id, r.item_id) for r in decontam.contaminated(awkward, bench).collect()}


def test_personal_data_base_spans(docs, rows):
    extra = ["a@b.c.d@e.f x.@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4", "4111 1111-1111 1111x 4111111111111112",
             "+1 (23) 456-789 0 +44 20 7946 0958.", "@@ 12 +", "", None, "é 12345678901234 ü a@b-c.de"]
    for t in extra + [t for _, t in rows]:
        base = pii.base_spans(t or "")
        assert pii._named(base) == brute.personal_data(t)[0]
    field = pii.train([t for _, t in rows if t])
    got = {r.doc_id: r for r in pii.found(docs, field).collect()}
    for i, t in rows:
        named, count = brute.personal_data(t)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[k] for k in range(4))
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert set(filter(None, named.split(","))) <= set(r.spans.split(","))


def test_field_search_is_the_best_segmentation():
    rng = np.random.default_rng(1)
    field = pii.Field(rng.normal(size=(5, pii.FEATURES)), rng.normal(size=(5, 5)))
    text = "ring 555 0199 now or 10.0.0.1"
    w = pii.Window(text, [m.span() for m in pii._TOKEN.finditer(text)])
    scores = field.scores(w, field.segments(w))
    n = len(w.tokens)

    def every(at, prev):
        if at == n:
            yield 0.0, []
            return
        for j in range(at + 1, min(n, at + pii.LONGEST) + 1):
            if (at, j) in scores:
                for y in range(5):
                    here = field.moves[prev, y] + scores[at, j][y]
                    if np.isfinite(here):
                        for rest, tail in every(j, y):
                            yield here + rest, ([(at, y, j)] if y else []) + tail

    best = max(every(0, 0), key=lambda x: x[0])
    assert field.best(w) == best[1]


def test_personal_data_awkward_and_added_spans(spark, awkward, nothing):
    kinds = ("write to jo.{k}@site{k}.example.com please do", "you may call +1 (212) 555-01{k:02d} any day",
             "it came from 10.0.{k}.9 last night", "they paid 4111 1111 1111 1111 for it", "version 3.{k} of the page")
    samples = [kinds[k % 5].format(k=k) for k in range(200)]
    field = pii.train(samples)
    base, every = pii.all_spans("call 0044 20 7946 0958 today", field)
    assert base == [] and [k for _, k, _ in every] == [3]
    assert pii.all_spans("version 4.0 of page 12", field) == ([], [])
    assert pii.redact("mail a@b.cd now", field) == "mail <EMAIL> now"
    assert len(pii.found(awkward, field).collect()) == len(awkward_rows())
    assert pii.found(nothing, pii.fit(nothing)).collect() == []
    assert pii.redacted(awkward, field).schema.names == awkward.schema.names


def test_added_spans_are_found_at_every_place_of_a_dense_run():
    field = pii.Field.empty()  # a segment that reads as one address outweighs ordinary tokens, others do not
    field.weights[:, 0], field.weights[1, 10] = [1, -5, -20, -20, -20], 20
    hidden = "jo [at] example [dot] com"
    for before in range(50, 80):  # numbers keep one window open; its 64th token lies before, in or after the span
        text = f"{'7 ' * before}{hidden}{' 7' * 10}"
        at = 2 * before
        assert pii.all_spans(text, field) == ([], [(at, 0, at + len(hidden))]), before
        assert pii.redact(text, field) == text.replace(hidden, "<EMAIL>")
    w, = pii.windows("7 " * 5000, [])
    assert len(w.tokens) == 5000


def test_language_model(docs, rows):
    train = docs.where(fold("doc_id", 10) != 0)
    learned = {r.doc_id for r in train.select("doc_id").collect()}
    want = brute.unigram([t for _, t in rows], [t for i, t in rows if i in learned])
    for frequent in (50, lm.FREQUENT):
        got = {r.doc_id: r for r in lm.scores(docs, train, frequent).collect()}
        for (i, t), (n, known, total, base) in zip(rows, want):
            r = got[i]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
            assert r.base_score == pytest.approx(base, rel=1e-9)
    bits = -sum(got[i].score for i, _ in rows if i not in learned) / np.log10(2)
    assert bits / sum(len(t.encode()) for i, t in rows if i not in learned) < 3.2  # code length per byte


def brute_tree(training):
    """Score of a text by the recursion over contexts kept in plain dictionaries."""
    white = b" \t\n\x0b\x0c\r"
    seen = {}

    def steps(text):
        data = b" " + text
        for at in range(1, len(data)):
            begin = at - 1
            while begin > 0 and data[begin] not in white and at - begin < lm.DEPTH:
                begin -= 1
            for bit in range(8):
                yield data[begin:at], (1 << bit) + (data[at] >> 8 - bit), data[at] >> 7 - bit & 1

    for t in training:
        for context, decision, bit in steps(t):
            for k in range(len(context) + 1):
                node = context[len(context) - k:]
                seen.setdefault((node, decision), [0, 0])[bit] += 1
    children = {}
    for node, decision in seen:
        if node:
            children.setdefault((node[1:], decision), []).append(node)
    leaf = lambda node: len(node) == lm.DEPTH or (node and node[0] in white)

    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.cache
    def logw(node, decision):
        own = kt(*seen[node, decision])
        if leaf(node):
            return own
        return np.logaddexp(own, sum(logw(c, decision) for c in children[node, decision])) - math.log(2)

    def score(text):
        total = 0.0
        for context, decision, bit in steps(text):
            p, left = 0.0, 1.0
            for k in range(len(context) + 1):
                node = context[len(context) - k:]
                a, b = seen.get((node, decision), (0, 0))
                w = 1.0 if leaf(node) else 0.5 * math.exp(kt(a, b) - logw(node, decision)) if a + b else 0.5
                p, left = p + left * w * (b + .5) / (a + b + 1), left * (1 - w)
            total += math.log10(p if bit else 1 - p)
        return total

    return score


def test_context_tree_is_the_weighted_mixture(spark):
    texts = ["abracadabra abracadabra\tAbra", "banana bandana", " two  spaces \n", "\0nul\0", "naïve", "x" * 40,
             "unseen words abracadavra banana", "", None]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for learned in (6, 0):
        score = brute_tree([t.encode() for t in texts[:learned]])
        for size in (10, lm.FREQUENT):  # joined or held
            for training in (F.col("doc_id") < learned, docs.where(F.col("doc_id") < learned)):
                got = {r.doc_id: r.score for r in lm.scores(docs, training, size, size).collect()}
                assert got == pytest.approx({i: score((t or "").encode()) for i, t in rows}, rel=1e-9)


def test_language_model_grows_with_its_corpus(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.sha1(F.col("id").cast("string")).alias("text"))
    sizes = [lm.pair_counts(lm.unit_counts(docs.limit(n).withColumn("train", F.lit(1)))).count() for n in (1000, 2000)]
    assert sizes[1] > 1.9 * sizes[0]


def test_language_model_awkward(awkward, nothing):
    got = lm.scores(awkward, awkward).collect()
    assert len(got) == len(awkward_rows())
    assert all(r.score == 0 and r.n_tokens == 1 for r in got if r.doc_id in (4, 5))
    assert lm.scores(nothing, nothing).collect() == []
    untrained = lm.scores(awkward, nothing).where("doc_id = 7").first()
    assert untrained.train_tokens == 0 and untrained.score == pytest.approx(-9 * np.log10(256), rel=1e-5)


def test_language_identification(docs, rows, awkward, nothing):
    model = langid.fit(docs.where(fold("doc_id", 5) != 0))
    got = {r.doc_id: r for r in langid.identified(docs, model).collect()}
    truth = {r.doc_id: r.lang for r in docs.where(fold("doc_id", 5) == 0).collect()}
    assert sum(got[i].lang_pred == x for i, x in truth.items()) >= 0.9 * len(truth)
    odd = {r.doc_id: r for r in langid.identified(awkward.where("doc_id is not null"), model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (4, 5, 6, 10, 12))
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert langid.identified(nothing, langid.fit(nothing)).collect() == []
    assert {r.lang_pred for r in langid.identified(awkward, langid.fit(nothing)).collect()} == {"und"}


SAMPLES = {
    "ru": "Поздно вечером старый паром в последний раз вышел из гавани, и только несколько человек пришли его проводить. "
          "Капитан поднял руку, и серая вода сомкнулась за ними. Никто в деревне не помнил, кто посадил этот сад.",
    "uk": "Пізно ввечері старий пором востаннє вийшов із гавані, і лише кілька людей прийшли його провести. "
          "Капітан підняв руку, і сіра вода зімкнулася за ними. Ніхто в селі не пам'ятав, хто посадив цей сад.",
    "pl": "Późnym wieczorem stary prom po raz ostatni wypłynął z portu i tylko kilka osób przyszło go pożegnać. "
          "Kapitan podniósł rękę, a szara woda zamknęła się za nimi. Nikt we wsi nie pamiętał, kto zasadził ten sad.",
    "cs": "Pozdě večer starý přívoz naposledy vyplul z přístavu a jen několik lidí se přišlo rozloučit. "
          "Kapitán zvedl ruku a šedá voda se za nimi zavřela. Nikdo ve vsi si nepamatoval, kdo tu zahradu zasadil.",
}
PROBES = [("ru", "никто не пришёл проводить капитана"), ("uk", "ніхто не прийшов провести капітана"),
          ("ru", "СТАРЫЙ САД В ДЕРЕВНЕ"), ("uk", "СТАРИЙ САД У СЕЛІ"),
          ("pl", "nikt nie pamiętał kapitana"), ("cs", "nikdo si nepamatoval kapitána")]


def test_languages_of_one_script_are_told_apart(spark):
    # each sample beside itself with its letters exchanged: the same word lengths, so letters alone decide
    def other(text, first, size):
        return "".join(chr(first + (ord(c) - first + 7) % size) if first <= ord(c) < first + size else c for c in text.lower())

    greek = "αργά το βράδυ το παλιό πλοίο έφυγε από το λιμάνι για τελευταία φορά και λίγοι ήρθαν να το δουν"
    hindi = "शाम को पुरानी नाव आखिरी बार घाट से चली और उसे देखने बहुत कम लोग आए थे"
    pairs = {"ru": (SAMPLES["ru"], 0x430, 32), "el": (greek, 0x3B1, 25), "hi": (hindi, 0x915, 37)}
    for name, (text, first, size) in pairs.items():
        model = langid.Languages.learn({name: text, "other": other(text, first, size)})
        words = text.lower().split()
        probes = [" ".join(words[k:k + 4]) for k in range(0, len(words) - 4, 3)]
        assert set(model.predict(probes)[0]) == {name}
        assert set(model.predict([other(t, first, size) for t in probes])[0]) == {"other"}
    rows = spark.createDataFrame([(k, t, x) for k, (x, t) in enumerate(SAMPLES.items())], "doc_id long, text string, lang string")
    got = langid.identified(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(PROBES)], "doc_id long, text string"),
                            langid.fit(rows)).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == [x for x, _ in PROBES]


def test_packed_automata_hold_every_transition_and_no_other():
    rng = np.random.default_rng(4)
    for letters in (3, 60, 4000):
        s = rng.integers(1, letters, 3000)
        rows = langid.suffix_automaton(s)
        (owner, to), root = langid.packed(rows, letters)
        place, todo = {0: root}, [0]
        while todo:
            state = todo.pop()
            at = place[state]
            assert {int(c) for c in np.flatnonzero(owner[at:at + letters] == at)} == set(rows[state])
            for c, after in rows[state].items():
                if after not in place:
                    todo.append(after)
                assert place.setdefault(after, int(to[at + c])) == to[at + c]
        assert len(set(place.values())) == len(rows)


def test_automaton_phrases_are_greedy_longest_matches():
    model = langid.Languages.learn({"x": "abracadabra alakazam", "y": "banana split"})
    table = langid.symbol_table()
    known = {k: langid.symbols(t, table).tobytes() for k, t in (("x", "abracadabra alakazam"), ("y", "banana split"))}
    texts = ["abra banana", "zzz", "a", "split abracad", "qalakaz q"]
    parts = [langid.symbols(t, table) for t in texts]
    got = model.phrases(parts)
    for row, s in zip(got, parts):
        for k, name in enumerate(model.names):
            b, at, n = s.tobytes(), 0, 0
            while at < len(b):
                size = 0
                while at + size < len(b) and b[at:at + size + 1] in known[name]:
                    size += 1
                at += max(1, size)
                n += 1
            assert abs(row[k] - n) <= 1, (s, name)  # an unknown symbol at the end may open a phrase


def test_pieces_are_those_of_the_library(docs, rows, awkward, nothing):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = pieces.Pieces.load(pieces.default_model())
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    got = {r.doc_id: list(r.ids) for r in pieces.encoded(docs, model).collect()}
    assert all(got[i] == library.encode(t) for i, t in rows)
    rng = np.random.default_rng(5)
    odd = ["".join(rng.choice(list("etaoin shrdlu  \n.,0é中"), 80)) for _ in range(200)]
    ids, first = model.encode(flat(pa.array(odd)))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == library.encode(odd)
    back = pieces.decoded(pieces.encoded(awkward, model), model).collect()
    assert all(r.decoded == (r.text or "") for r in back) and len(back) == len(awkward_rows())
    assert all(r.same for r in pieces.digests(awkward, model).collect())
    assert pieces.digests(nothing, model).collect() == []


def test_unigram_search_is_the_best_path():
    rng = np.random.default_rng(2)
    vocabulary = sorted({"".join(rng.choice(list("ab▁c"), rng.integers(1, 5))) for _ in range(60)} | {"a", "b", "c", "▁"})
    vocabulary = [v for v in vocabulary if "▁" not in v[1:]]
    made = [("<unk>".encode(), 0.0, pieces.UNKNOWN)] + [(v.encode(), -float(rng.random() * 9), pieces.NORMAL) for v in vocabulary]
    model = pieces.Pieces.build(made)
    worth = {t.decode(): s for t, s, k in made if k == pieces.NORMAL}
    texts = ["".join(rng.choice(list("abc "), 14)) for _ in range(60)]
    ids, first = model.encode(flat(pa.array(texts)))
    for k, t in enumerate(texts):
        s = "▁" + t.replace(" ", "▁")
        best = [0.0] + [-np.inf] * len(s)
        for e in range(1, len(s) + 1):
            best[e] = max((best[b] + worth[s[b:e]] for b in range(e) if s[b:e] in worth), default=-np.inf)
        mine = [made[i] for i in ids[first[k]:first[k + 1]]]
        assert "".join(x[0].decode() for x in mine) == s
        assert sum(x[1] for x in mine) == pytest.approx(best[-1])


def test_quality(spark, data_dir, docs, awkward, nothing):
    labels = spark.read.parquet(f"{data_dir}/labels.parquet")
    x = quality.with_statistics(docs)
    model = quality.fit(x, labels.where(fold("doc_id", 5) != 0))
    held = quality.scored_statistics(x, model).join(labels.where(fold("doc_id", 5) == 0), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)
    lower = np.linalg.inv(model.factor[0])
    z = np.ones(len(quality.STATS))
    direct = (z - model.centre[0]) @ np.linalg.inv(lower @ lower.T) @ (z - model.centre[0])
    assert (((z - model.centre[0]) @ model.factor[0].T) ** 2).sum() == pytest.approx(direct)
    odd = quality.scored_statistics(quality.with_statistics(awkward), model).collect()
    assert len(odd) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in odd)
    empty = quality.fit(quality.with_statistics(nothing), labels)
    assert empty.centre is None and quality.accepted(nothing, empty).collect() == []
    repeated = labels.unionByName(labels).unionByName(spark.createDataFrame(
        [(None, 1, 0), (1, None, 0)], labels.schema))
    again = quality.fit(x, repeated.where(F.coalesce(fold("doc_id", 5), F.lit(0)) != 0))
    assert np.allclose(again.centre, model.centre)
