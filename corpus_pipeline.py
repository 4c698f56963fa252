"""Training-corpus pipeline: quality filter, near-duplicates, decontamination, personal data, tokenising.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages documents are written
as Parquet and read again. All stages but the last return the columns of documents. Null texts count as empty and are
judged like other texts, rows with a null doc_id are never duplicates of or contaminated by anything, extra columns
pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstream.llm import decontam, neardup, pieces, pii, quality
from rillstream.llm.folds import fold
from rillstream.llm.tables import kept
from rillstream.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quadratic discriminant rejects; it learns from labels outside fold 0 of 5."""
    labels = _table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    x = kept(quality.with_statistics(docs), "quality")
    return quality.accepted(docs, quality.fit(x, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document of smallest doc_id, one row if a doc_id repeats."""
    stay = neardup.near_duplicates(docs).where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id")
    named = docs.where(F.col("doc_id").isNotNull()).join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    found = decontam.contaminated(docs, _table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    return pii.redacted(docs, pii.fit(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids, n_tokens and the text decoded from the ids; the text itself goes."""
    model = pieces.Pieces.load(pieces.default_model())
    rows = pieces.encoded(docs, model, decoded="decoded")
    return rows.withColumn("n_tokens", F.size("ids").cast("long")).drop("text")


STAGES = [
    ("quality", quality_filter),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("sentencepiece", sentencepiece),
]

#: The classifier, the random field and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(configure(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = kept(docs, f"stage-{k}")
    return docs
