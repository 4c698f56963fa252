"""Vector search, archives, the registry and the pipeline."""

import base64
import hashlib
import io
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from llm_rows import awkward_rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rillstream.llm import topk, warc  # noqa: E402
from rillstream.llm.queries import CATALOG  # noqa: E402
from rillstream.session import scratch  # noqa: E402


def slow_topk(ids, v, k, asked):
    out = []
    for q in np.flatnonzero(asked):
        s = v @ v[q]
        others = [i for i in range(len(ids)) if ids[i] != ids[q]]
        best = sorted(others, key=lambda i: (-s[i], ids[i]))[:k]
        out += [(int(ids[q]), r + 1, int(ids[i]), int(s[i])) for r, i in enumerate(best)]
    return out


@pytest.mark.parametrize("spread", [1, 30, 400])
def test_dual_tree_finds_the_same_as_all_pairs(spread):
    rng = np.random.default_rng(spread)
    v = rng.integers(-spread, spread + 1, (700, 6)) + rng.integers(0, 3, (700, 1)) * 500
    ids = rng.permutation(700)
    asked = ids % 10 == 0
    got, score, _ = topk.dual_search(v[asked], ids[asked], v, ids, 7)
    mine = [(int(q), r + 1, int(got[a, r]), int(score[a, r])) for a, q in enumerate(ids[asked]) for r in range(7)]
    assert sorted(mine) == sorted(slow_topk(ids, v, 7, asked))


def test_dual_tree_prunes_clusters():
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.integers(-5, 6, (4000, 8)) + c for c in (0, 2000, -2000, 5000)])
    ids = np.arange(len(v))
    asked = ids >= 12_000
    _, _, scored = topk.dual_search(v[asked][:64], ids[asked][:64], v, ids, 5)
    assert scored < len(v) / topk.LEAF / 2


def test_topk_awkward(spark):
    rows = [(0, [0.5, 0.25]), (100, [0.5, 0.25]), (100, [0.5, 0.25]), (1, None), (2, [0.1, None]), (3, [float("nan"), 1.0]),
            (4, [float("inf"), 1.0]), (5, []), (None, [1.0, 1.0]), (6, [-0.3, 0.7]), (200, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = topk.exact_topk(df, df.where("vec_id % 100 = 0"), 2, query_block=2, data_block=2).collect()
    assert {(r.query_id, r.vec_id) for r in got if r.query_id == 0} == {(0, 100)}
    assert not any(r.query_id == 200 for r in got)  # no other vector of its dimension
    assert topk.exact_topk(df.limit(0), df, 2).collect() == []


def test_archives(spark, tmp_path):
    rows = [(1, "u1", "<p>a</p>"), (2, "u2", "<p>a</p>"), (3, None, "<p>b é</p>"), (4, "u4\nx: y", None), (5, "u5", ""),
            (6, "u6", "x" * 300_000), (None, "u", "<p>b é</p>"), (7, "u7", "<p>c</p>"), (7, "u7", "<p>c</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(3))
    where = scratch(spark, "warc-test")
    warc.archive_pages(pages, where)
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.pages_of(spark, where).collect()}

    def row(i, html, kind, to=None):
        b = (html or "").encode()
        return i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), kind, to

    assert got == {row(1, rows[0][2], "revisit", 2), row(2, rows[0][2], "response"), row(3, rows[2][2], "response"),
                   row(4, None, "revisit", 5), row(5, "", "response"), row(6, rows[5][2], "response"),
                   row(7, "<p>c</p>", "response")} | {g for g in got if g[0] is None}
    assert warc.read_archive(spark, where).where("record_type = 'response'").count() == 6
    plan = warc.read_archive(spark, where).where("record_type = 'revisit' and target_uri like 'u%'")
    assert {r.payload for r in plan.collect()} == {b""}
    assert all(r.payload is None for r in warc.read_archive(spark, where, payloads=False).collect())
    empty = scratch(spark, "warc-test")
    warc.archive_pages(pages.limit(0), empty)
    assert warc.pages_of(spark, empty).collect() == []


def test_rejected_payloads_are_not_decoded():
    class File(io.BytesIO):
        taken = 0

        def size(self):
            return len(self.getvalue())

        def read(self, n=-1):
            out = super().read(n)
            self.taken += len(out)
            return out

    rng = np.random.default_rng(0)
    body = rng.integers(0, 256, 2_000_000, dtype=np.uint8).tobytes()
    f = File(b"".join(warc.member(warc.record({"WARC-Type": t}, body)) for t in ("response", "revisit", "response")))
    found = list(warc.read_records(f, lambda h: h["WARC-Type"] == "revisit"))
    assert len(found) == 1 and found[0][1] == body and f.taken < 1.2 * len(body)


def test_plain_and_foreign_archives_are_read():
    import gzip
    recs = [warc.record({"WARC-Type": "response", "X": str(k)}, b"b" * k) for k in (0, 10, 50_000)]

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    for data in (b"".join(recs), b"".join(gzip.compress(r) for r in recs)):
        assert [len(p) for _, p, _ in warc.read_records(File(data))] == [0, 10, 50_000]
        assert [h["X"] for h, _, _ in warc.read_records(File(data), payloads=False)] == ["0", "10", "50000"]


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in CATALOG) == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        where = scratch(spark, "pipeline-test")
        stage(spark, before, data_dir).write.parquet(where)
        after = spark.read.parquet(where)
        if k < 4:
            assert after.columns == docs.columns, name
            assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "near-duplicates":
            from llm_brute import near_duplicates
            rows = sorted((r.doc_id, r.text) for r in before.collect())
            assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in near_duplicates(rows).items() if i == c}
        if name == "personal data":
            assert after.count() == before.count()
            assert not after.where(F.col("text").rlike(r"[a-z]@[a-z0-9]+\.example\.com")).count()
            hidden = after
        before = after
    text = {r.doc_id: r.text for r in hidden.collect()}
    assert {r.doc_id: r.decoded for r in before.collect()} == text


def test_pipeline_stages_awkward(spark, awkward, nothing, data_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, data_dir).collect() == [], name
        assert len(stage(spark, awkward, data_dir).collect()) <= len(awkward_rows()), name
