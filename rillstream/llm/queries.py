"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog.base import Catalog
from . import align, bpe, decontam, kmeans, langid, lm, neardup, pieces, pii, quality, suffix, topk, warc
from .folds import fold, held_out
from .tables import kept

CATALOG = Catalog()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@CATALOG.query("op3_warc")
def op3_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@CATALOG.query("op5_topk", sql="""
    WITH v AS (
      SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
      FROM embeddings
      WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
    s AS (
      SELECT q.vec_id AS query_id, d.vec_id,
             CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e) WHERE q.vec_id % 100 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
    SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 10""")
def op5_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_topk(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


@CATALOG.query("op10_quality")
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    x = kept(quality.with_statistics(docs), "quality")  # texts are read once and never shuffled
    return quality.scored_statistics(x, quality.fit(x, labels)).withColumn("held_out", held_out("doc_id", 5)).select(
        "doc_id", "held_out", "score", "predicted")


@CATALOG.query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    return decontam.marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@CATALOG.query("op8_neardup")
def op8_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@CATALOG.query("op9_lm")
def op9_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return lm.scores(docs, fold("doc_id", 10) != 0, ends=lm.WHOLE).select(
        "doc_id", held_out("doc_id", 10).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@CATALOG.query("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    return suffix.deduplicate(table(spark, sf_dir, "documents"))


@CATALOG.query("op4_pii")
def op4_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.found(docs, pii.fit(docs))


@CATALOG.query("op6_langid")
def op6_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold("doc_id", 5) != 0))
    return langid.identified(docs, model).select(
        "doc_id", held_out("doc_id", 5).alias("held_out"), "lang_pred", "score")


@CATALOG.query("op1_sentencepiece")
def op1_sentencepiece(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), pieces.Pieces.load(pieces.default_model()))


def clustering_sql(k: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """All rounds as one chain of common table expressions, distances by brute force."""
    parts = [f"""
    v AS MATERIALIZED (
      SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
      WHERE len(embedding) = {dim} AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
    c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), e) - 1 AS c, e FROM v WHERE vec_id IS NOT NULL
      QUALIFY c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
    a{r} AS MATERIALIZED (
      SELECT v.vec_id, v.e, min({{'d': list_sum([CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT) FOR p IN list_zip(v.e, q.e)]), 'c': q.c}}) AS n
      FROM v CROSS JOIN c{r} q GROUP BY v.rid, v.vec_id, v.e)""")
        if r < rounds:
            parts.append(f"""
    s{r} AS (
      SELECT c, pos, sum(x) AS s, count(*) AS k FROM (
        SELECT n.c AS c, unnest(e) AS x, unnest(range({dim})) AS pos FROM a{r}) GROUP BY c, pos),
    m{r} AS (
      SELECT c, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY pos) AS e FROM s{r} GROUP BY c),
    c{r + 1} AS MATERIALIZED (
      SELECT p.c, coalesce(m.e, p.e) AS e FROM c{r} p LEFT JOIN m{r} m ON m.c = p.c)""")
    return "WITH " + ",".join(parts) + f"""
    SELECT vec_id, CAST(a.n.c AS INTEGER) AS cluster, CAST(a.n.d AS BIGINT) AS distance,
           CAST(sum(a.n.d) OVER (PARTITION BY a.n.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.n.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(q.e, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN c{rounds} q ON q.c = a.n.c"""


@CATALOG.query("op11_clustering", sql=clustering_sql())
def op11_clustering(spark, sf_dir):
    return kmeans.report(*kmeans.clustered(table(spark, sf_dir, "embeddings")))


@CATALOG.query("op12_token_counts")
def op12_token_counts(spark, sf_dir):
    return bpe.counted(table(spark, sf_dir, "documents"), bpe.Merges.load(bpe.default_file()))


@CATALOG.query("op13_alignment")
def op13_alignment(spark, sf_dir):
    return align.aligned(table(spark, sf_dir, "documents"), align.Tokenizers.load(*align.default_files()))
