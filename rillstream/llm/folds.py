"""Fixed folds: crc32 of doc_id as text, so that they are the same in every engine and run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; a null id counts as the text "" (fold 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def held_out(doc_id: Column | str, folds: int) -> Column:
    return fold(doc_id, folds) == 0
