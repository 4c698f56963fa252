"""Intermediate tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch


#: Rows of a small table that go into one task when its size is known.
ROWS_PER_TASK = 200_000


def kept(df: DataFrame, label: str, at_most: int | None = None) -> DataFrame:
    """The same rows, written as Parquet below the shared folder and read again.

    ``at_most`` bounds their number where it is known: small tables then take few tasks and files.
    """
    spark = df.sparkSession
    if at_most is not None:
        df = df.coalesce(max(1, -(-at_most // ROWS_PER_TASK)))
    where = scratch(spark, label)
    df.write.parquet(where)
    return spark.read.schema(df.schema).parquet(where)
