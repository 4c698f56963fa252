"""Snapshots, dimension loads, sinks and connector options."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.changes import upsert_state
from ..streaming.store import History, KeyedStore

BatchFn = Callable[[DataFrame, int], None]


def snapshot(
    spark: SparkSession, uri: str, fmt: str = "parquet", version: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table snapshot read once; ``version`` selects one where the format has versions."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if version is not None:
        reader = reader.option("versionAsOf", version)
    return reader.load(uri)


def follow_options(fmt: str, version: int | None = None) -> dict[str, str]:
    """Reader options to start from a snapshot and go on with the log."""
    if fmt == "delta":
        return {"startingVersion": str(version)} if version is not None else {}
    return {"latestFirst": "false"}


def snapshot_and_follow(
    spark: SparkSession, uri: str, fmt: str, schema: T.StructType, version: int | None = None
) -> DataFrame:
    """A stream that first delivers what the table holds, then what is appended."""
    reader = spark.readStream.format(fmt).options(**follow_options(fmt, version))
    if fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(uri)


def dimension_load(spark: SparkSession, path: str, key: Sequence[str], seq: str | None = None, fmt="parquet"):
    """A static dimension with one current row per key."""
    dim = spark.read.format(fmt).load(path)
    return dimension_state(dim, key, seq)


def dimension_state(dim: DataFrame, key: Sequence[str], seq: str | None = None) -> DataFrame:
    if seq is None:
        rest = [c for c in dim.columns if c not in key]
        one = dim.groupBy(*key).agg(F.max(F.struct(*rest)).alias("__r"))
        return one.select(*key, "__r.*").select(*dim.columns)
    return upsert_state(dim, key, seq)


# -- sinks --------------------------------------------------------------------

def truncate_sink(path: str) -> BatchFn:
    """Replace the table on the first epoch, append later ones; retried epochs replace themselves."""
    def write(batch: DataFrame, epoch: int) -> None:
        out = batch.withColumn("epoch", F.lit(epoch))
        mode = "static" if epoch == 0 else "dynamic"
        out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("epoch").parquet(path)
    return write


def upsert_sink(store: KeyedStore, seq: str | None = None) -> BatchFn:
    """Upsert (op, columns) changes by record key; deletes remove, new columns are added.

    A batch may change a key several times when ``seq`` names the column that orders its
    changes; without it a key must occur once per batch.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        store.write(batch if seq is None else upsert_state(batch, store.keys, seq).drop(seq), epoch)
    return write


def jdbc_options(url: str, table: str, user: str, password: str, staging: str | None = None) -> dict[str, str]:
    """Options for ``df.write.format('jdbc')`` into a staging table that the database merges."""
    return {
        "url": url, "dbtable": staging or f"{table}_staging", "user": user, "password": password,
        "truncate": "true", "batchsize": "10000", "isolationLevel": "READ_COMMITTED",
    }


def history_write(df: DataFrame, history: History, epoch: int) -> None:
    """Store rows clustered by key and time under their epoch; the same epoch replaces itself."""
    history.write(df, epoch)


def for_each_chunk(stream: DataFrame, fn: BatchFn, checkpoint: str):
    """Call ``fn`` with every new chunk of output and run until the input is used up."""
    return (
        stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def metrics_sink(df: DataFrame, path: str) -> None:
    """A metrics table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
