"""Declarative streaming: lateness, time windows, distinct counts, alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..params import AccessParams


def with_lateness(stream: DataFrame, ts: str, bound: str, unit: str | None = None, name: str = "event_time") -> DataFrame:
    """Declare how late rows may be.

    Watermarks need a TIMESTAMP: a NTZ time is cast (UTC session) and with
    ``unit='seconds'`` an epoch column is converted; both under ``name``.
    """
    kind = stream.schema[ts].dataType
    if unit == "seconds":
        stream, ts = stream.withColumn(name, F.timestamp_seconds(ts)), name
    elif not isinstance(kind, T.TimestampType):
        stream, ts = stream.withColumn(name, F.col(ts).cast("timestamp")), name
    return stream.withWatermark(ts, bound)


def late_rows(batch: DataFrame, ts: str, max_seen, bound: str) -> tuple[DataFrame, DataFrame, object]:
    """(kept, late, new maximum): rows older than the maximum seen before this batch
    minus the bound go to the side output instead of vanishing.

    ``max_seen`` is one timestamp, None before the first batch.
    """
    new_max = batch.agg(F.max(ts)).first()[0]
    if max_seen is None:
        return batch, batch.limit(0), new_max
    too_old = F.coalesce(F.col(ts) < F.lit(max_seen) - F.expr(f"INTERVAL {bound}"), F.lit(False))
    best = max_seen if new_max is None else max(max_seen, new_max)
    return batch.filter(~too_old), batch.filter(too_old), best


class LateSplitter:
    """Lateness with a side output, as a step of a stream that may be stopped at any time.

    The newest time seen is kept in a table, a row per epoch. An epoch compares its rows with the row of the one
    before, and writes its kept rows, late rows and newest time under its own number: a retried epoch sees the same
    newest time as at first and replaces whatever it had written.
    """

    def __init__(self, spark: SparkSession, root: str, ts: str, bound: str):
        self.spark, self.root, self.ts, self.bound = spark, root, ts, bound

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        kept, late, newest = late_rows(batch, self.ts, self._seen(epoch - 1, batch.schema[self.ts].dataType), self.bound)
        self._write(kept, "kept", epoch)
        self._write(late, "late", epoch)
        row = self.spark.createDataFrame([(newest,)], T.StructType([T.StructField("newest", batch.schema[self.ts].dataType)]))
        self._write(row, "newest", epoch)

    def _write(self, rows: DataFrame, part: str, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{part}/epoch={epoch}")

    def _seen(self, epoch: int, kind: T.DataType):
        try:
            return self.spark.read.schema(T.StructType([T.StructField("newest", kind)])).parquet(
                f"{self.root}/newest/epoch={epoch}").first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None  # the first epoch

    def rows(self, schema: T.StructType) -> DataFrame:
        """All rows so far, with ``late``."""
        full = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
        read = lambda part, flag: self.spark.read.schema(full).parquet(f"{self.root}/{part}").drop("epoch").withColumn(
            "late", F.lit(flag))
        return read("kept", False).unionByName(read("late", True))


def stream_hop(stream: DataFrame, key: str, ts: str, value: str, size: str, slide: str) -> DataFrame:
    """Hopping-window average, deviation and count; the stream carries a watermark on ``ts``."""
    stats = stream.groupBy(key, F.window(ts, size, slide).alias("w")).agg(
        (F.sum(value).cast("double") / F.count(value)).alias("avg_amt"),
        F.count(key).alias("trans"),
        F.coalesce(F.stddev_samp(F.col(value).cast("double")), F.lit(0.0)).alias("stddev_amt"))
    return stats.select(
        key, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "avg_amt", "trans", "stddev_amt")


def stream_distinct(stream: DataFrame, keys: Sequence[str], ts: str, size: str, cols: Sequence[str], name: str = "n"):
    """Exact distinct count per key and window on a stream.

    Distinct values are first deduplicated in keyed state, which spreads a hot
    key over (key, value) groups; the remaining rows are only counted.
    """
    unique = stream.select(*keys, F.window(ts, size).alias("w"), *cols).dropDuplicates([*keys, "w", *cols])
    counts = unique.groupBy(*keys, "w").agg(F.count(F.lit(1)).alias(name))
    return counts.select(
        *keys, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), name)


def stream_alerts(stream: DataFrame, files: DataFrame, ts: str, params: AccessParams, bound: str) -> dict[str, DataFrame]:
    """Enumeration and hot-folder alerts of an access stream joined to the file table."""
    parents = files.filter(F.col("parent_id").isNotNull()).select(F.col("id").alias("file_id"), "parent_id")
    rows = with_lateness(stream.join(parents, "file_id"), ts, bound)
    at = ts if ts in stream.columns and isinstance(stream.schema[ts].dataType, T.TimestampType) else "event_time"
    enum = stream_distinct(rows, ["user_id"], at, f"{params.enumeration_window} seconds", ["parent_id"], "folder_count")
    hot = stream_distinct(rows, ["parent_id"], at, f"{params.hot_folder_window} seconds", ["user_id"], "user_count")
    return {
        "enumeration": enum.filter(F.col("folder_count") >= params.enumeration_folders),
        "hot_folder": hot.filter(F.col("user_count") >= params.hot_folder_users),
    }


def stream_static(stream: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows joined to the dimension as it is when their micro-batch runs."""
    return stream.join(dim, list(on), how)


def run_available(writer: DataStreamWriter, timeout: int | None = None) -> StreamingQuery:
    """Process all input there is, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(timeout)
    return query


def run_batches(
    stream: DataFrame, fn: Callable[[DataFrame, int], object], checkpoint: str, first_epoch: int = 0
) -> StreamingQuery:
    """Run a maintainer over a stream until the available input is used up.

    ``first_epoch`` shifts the epoch numbers when earlier ones hold a preload.
    """
    def each(batch: DataFrame, epoch: int) -> None:
        fn(batch, epoch + first_epoch)
    return run_available(stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint))


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Append final rows of a stream to a Parquet table until the input is used up."""
    return run_available(
        stream.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint))
