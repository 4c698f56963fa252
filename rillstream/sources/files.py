"""Typed CSV scans and replay datasets (history plus ordered batches)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..skew import halvings, position

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# Rows aimed at per slice when numbering all rows of a table, most slices, and sampled positions per slice.
NUMBERING_ROWS = 1_000_000
NUMBERING_SLICES = 8192
SAMPLED = 64


def read_csv(
    spark: SparkSession, path, schema: T.StructType, null_policy: str = "null", drop_null: Sequence[str] = ("ts",)
) -> DataFrame:
    """Header CSV with a declared schema.

    An empty field is NULL, or 0 for numeric columns under ``null_policy='zero'``.
    Rows without a value in ``drop_null`` are skipped.
    """
    raw = spark.read.schema(schema).options(header=True, timestampNTZFormat=TIME_FORMAT).csv(path)
    return clean_nulls(raw, schema, null_policy, drop_null)


def clean_nulls(raw: DataFrame, schema: T.StructType, null_policy: str, drop_null: Sequence[str]) -> DataFrame:
    if null_policy == "zero":
        zeros = {
            f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
            for f in schema if isinstance(f.dataType, T.NumericType)
        }
        raw = raw.withColumns(zeros)
    elif null_policy != "null":
        raise ValueError("null_policy must be 'null' or 'zero'")
    needed = [c for c in drop_null if c in schema.names]
    return raw.dropna(subset=needed) if needed else raw


def global_row_number(df: DataFrame, ts: str, tie: Sequence[str], name: str = "rn") -> DataFrame:
    """0-based position in (ts, tie) order without a single-task sort.

    Rows are cut into slices of about NUMBERING_ROWS rows, equally deep however times bunch, since the bounds are
    (ts, tie) positions: many rows of one time fall into several slices. Slice counts give each slice its offset;
    rows are numbered inside their slice only.
    """
    bounds = _bounds(df, [ts, *tie])
    at = F.struct(ts, *tie)
    rows = df.crossJoin(F.broadcast(bounds)).select(  # one row
        *df.columns, position(F.col("__bounds"), F.col("__steps"), at).alias("__slice"))
    counts = rows.groupBy("__slice").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__slice",
        F.coalesce(
            F.sum("__n").over(Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__off"),
    )
    inside = Window.partitionBy("__slice").orderBy(ts, *tie)
    return (
        rows.withColumn("__rn", F.row_number().over(inside))
        .join(offsets, "__slice")
        .select(*df.columns, (F.col("__off") + F.col("__rn") - 1).alias(name))
    )


def _bounds(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row: the ascending positions that cut ``df`` into slices of about equal depth.

    They are every SAMPLED-th of a sample of distinct positions, picked by hash, so each run finds the same. The sample
    has about SAMPLED * NUMBERING_SLICES positions at most, whatever the table's size.
    """
    spark, key = df.sparkSession, df.select(*order)
    n, places = key.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*order))).first()
    slices = min(NUMBERING_SLICES, -(-n // NUMBERING_ROWS))
    sample = []
    if slices > 1:
        share = min(1.0, SAMPLED * slices / max(places, 1))
        drawn = F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
        sample = [tuple(r) for r in key.filter(drawn).distinct().orderBy(*order).collect()]
    step = max(1, -(-len(sample) // max(slices, 1)))
    kind = T.ArrayType(key.select(F.struct(*order).alias("k")).schema["k"].dataType)
    bounds = spark.createDataFrame([(sample[step::step],)], T.StructType([T.StructField("__bounds", kind)]))
    return bounds.withColumn("__steps", halvings(F.col("__bounds"), NUMBERING_SLICES))


def split_replay(
    df: DataFrame,
    ts: str,
    tie: Sequence[str],
    preload_rows: int,
    batch_rows: int | None = None,
    n_steps: int | None = None,
) -> DataFrame:
    """Add ``batch_id``: -1 for the preload, then 0, 1, ... in event order.

    With ``n_steps`` the last step also has the rows that are left over.
    """
    if not batch_rows and not n_steps:
        raise ValueError("give batch_rows or n_steps")
    n_stream = max(0, df.count() - preload_rows)
    if batch_rows:
        size = max(1, batch_rows)
        steps = max(1, -(-n_stream // size))
        steps = min(steps, n_steps) if n_steps else steps
    else:
        size, steps = max(1, n_stream // n_steps), n_steps
    numbered = global_row_number(df, ts, tie, "__pos")
    after = F.col("__pos") - F.lit(preload_rows)
    batch = F.when(after < 0, F.lit(-1)).otherwise(F.least(F.floor(after / F.lit(size)), F.lit(steps - 1)))
    return numbered.withColumn("batch_id", batch.cast("bigint")).drop("__pos")


def replay_schedule(split: DataFrame, ts: str) -> DataFrame:
    """Per batch: rows, window start (end of the previous batch) and end (running maximum)."""
    per = split.filter("batch_id >= 0").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    w = Window.orderBy("batch_id")  # one row per replay step
    ends = per.withColumn("win_end", F.max("__hi").over(w))
    return ends.select(
        "batch_id", "n_rows", F.coalesce(F.lag("win_end").over(w), F.col("__lo")).alias("win_start"), "win_end")


def write_replay(split: DataFrame, path: str, ts: str) -> None:
    """Store a split replay: one directory per batch, the preload under batch_id=-1.

    Range partitioning on (batch, time) spreads a large preload over many files.
    """
    split.repartitionByRange("batch_id", ts).write.mode("overwrite").partitionBy("batch_id").parquet(path)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path)


def replay_steps(
    spark: SparkSession, path: str, schema: T.StructType, preload: int = 0, steps: int | None = None
) -> tuple[DataFrame, Iterator[tuple[int, DataFrame]]]:
    """(history, batches in order). History is the preload and the first ``preload`` batches."""
    stored = _stored(spark, path, schema)
    history = stored.filter(F.col("batch_id") < preload).drop("batch_id")
    last = stored.agg(F.max("batch_id")).first()[0]
    end = last + 1 if steps is None else min(last + 1, preload + steps)

    def batches() -> Iterator[tuple[int, DataFrame]]:
        for step in range(preload, end):
            yield step, stored.filter(F.col("batch_id") == step).drop("batch_id")

    return history, batches()


def replay(
    spark: SparkSession, path: str, landing: str, schema: T.StructType, preload: int = 0, steps: int | None = None
) -> tuple[DataFrame, Callable[[Callable[[DataFrame, int], object], str], StreamingQuery]]:
    """(history, run): ``run(fn, checkpoint)`` streams the stored steps, one trigger each, to ``fn(rows, step)``.

    A marker file per step drives the stream, and epoch n reads the n-th step from its directory: a step is exactly
    one epoch however many files it has, and their order does not rest on file times. After a failure the stream goes
    on with the step that did not finish.
    """
    stored = _stored(spark, path, schema)
    history = stored.filter(F.col("batch_id") < preload).drop("batch_id")
    last = stored.agg(F.max("batch_id")).first()[0]
    end = last + 1 if steps is None else min(last + 1, preload + steps)
    marks = spark.range(preload, max(end, preload)).select(F.col("id").alias("step"), F.lit(1).alias("one"))
    marks.repartition("step").write.mode("overwrite").partitionBy("step").parquet(landing)

    def run(fn: Callable[[DataFrame, int], object], checkpoint: str) -> StreamingQuery:
        def each(_, epoch: int) -> None:
            step = preload + epoch
            fn(stored.filter(F.col("batch_id") == step).drop("batch_id"), step)

        stream = spark.readStream.schema("one int, step bigint").option("maxFilesPerTrigger", 1).parquet(landing)
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    return history, run
