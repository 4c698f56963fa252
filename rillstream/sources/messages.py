"""Message payloads: decoding broker values into rows and encoding rows back.

Transport is Spark's own (``readStream.format('kafka')`` and so on); everything
here maps a frame with a ``value`` column to a frame of typed columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_malformed"


def kafka_options(servers: str, topic: str, starting: str = "earliest", **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **extra}


def _text(df: DataFrame) -> Column:
    return F.col("value").cast("string")


def decode_json(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One JSON object per message; other columns (key, offset, ...) are dropped.

    Malformed and empty messages give no row; ``dead_letter_split`` returns them.
    """
    full = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    parsed = F.from_json(_text(df), full, {"columnNameOfCorruptRecord": "__bad"})
    rows = df.filter(F.trim(_text(df)) != "").select(F.inline(F.array(parsed)))
    return rows.filter(F.col("__bad").isNull()).drop("__bad")


# -- Debezium -----------------------------------------------------------------

def _wire_type(kind: T.DataType, flavor: str) -> T.DataType:
    """How a value of this type travels in a Debezium JSON envelope."""
    if isinstance(kind, T.DateType):
        return T.IntegerType()  # days since the epoch
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return T.LongType()  # milliseconds since the epoch
    if isinstance(kind, (T.DecimalType, T.BinaryType, T.VariantType, T.TimeType)):
        return T.StringType()  # exact text, base64, JSON text, HH:MM:SS
    if isinstance(kind, T.BooleanType) and flavor == "mysql":
        return T.StringType()  # true/false or the 0/1 of a TINYINT(1)
    return kind


def _from_wire(c: Column, kind: T.DataType, flavor: str) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_millis(c).cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.unbase64(c)
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(c)
    if isinstance(kind, (T.DecimalType, T.TimeType)):
        return c.cast(kind)
    if isinstance(kind, T.BooleanType) and flavor == "mysql":
        return F.when(c.isNotNull(), c.isin("1", "true"))
    return c


def _to_wire(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_millis(c.cast("timestamp"))
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.VariantType):
        return F.to_json(c)
    if isinstance(kind, (T.DecimalType, T.TimeType)):
        return c.cast("string")
    return c


def decode_debezium(df: DataFrame, schema: T.StructType, flavor: str = "postgres") -> DataFrame:
    """Envelope to (op, seq, before, after), with or without the schema wrapper.

    ``seq`` orders changes of one key: the broker offset when present, else the
    source position, else the event time. A MySQL position starts anew in each log
    file and is shared by the rows of one event, so there it is the number of the
    file, the position and the row together. Unparseable or empty (tombstone)
    messages are not changes; split them off first with ``dead_letter_split``.
    """
    if flavor not in ("postgres", "mysql"):
        raise ValueError("flavor must be 'postgres' or 'mysql'")
    wire = T.StructType([T.StructField(f.name, _wire_type(f.dataType, flavor)) for f in schema])
    source = T.StructType([
        T.StructField("lsn", T.LongType()), T.StructField("file", T.StringType()), T.StructField("pos", T.LongType()),
        T.StructField("row", T.LongType()), T.StructField("ts_ms", T.LongType())])
    envelope = T.StructType([
        T.StructField("before", wire), T.StructField("after", wire), T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()), T.StructField("source", source)])
    wrapped = T.StructType([T.StructField("payload", envelope), *envelope.fields])
    parsed = F.from_json(_text(df), wrapped)
    # A generator keeps the filter below from being pushed into a second parse.
    kept = [c for c in ("offset",) if c in df.columns]
    rows = df.select(*kept, F.inline(F.array(parsed)))
    pick = lambda name: F.coalesce(F.col(f"payload.{name}"), F.col(name))
    seq = [pick("source.lsn"), pick("source.pos"), pick("ts_ms")]
    if flavor == "mysql" and "offset" not in df.columns:
        number = F.regexp_extract(F.coalesce(pick("source.file"), F.lit("")), r"(\d+)$", 1)
        place = F.concat(
            F.when(number == "", F.lit("0")).otherwise(number), F.lpad(pick("source.pos").cast("string"), 19, "0"),
            F.lpad(F.coalesce(pick("source.row"), F.lit(0)).cast("string"), 9, "0")).cast(T.DecimalType(38, 0))
        seq = [place, pick("ts_ms").cast(T.DecimalType(38, 0))]
    if "offset" in df.columns:
        seq.insert(0, F.col("offset").cast("bigint"))

    def image(name: str) -> Column:
        body = pick(name)
        fields = [_from_wire(body[f.name], f.dataType, flavor).alias(f.name) for f in schema]
        return F.when(body.isNotNull(), F.struct(*fields)).alias(name)

    return rows.select(
        pick("op").alias("op"), F.coalesce(*seq).alias("seq"), image("before"), image("after")
    ).filter(F.col("op").isNotNull())


def debezium_changes(decoded: DataFrame) -> DataFrame:
    """Decoded envelopes as a flat changelog: the new row, or the old one of a delete."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return decoded.select("op", "seq", row.alias("__r")).select("op", "seq", "__r.*")


OPS = {"insert": "c", "update": "u", "delete": "d"}


def encode_debezium(changes: DataFrame, key_fields: Sequence[str]) -> DataFrame:
    """(op, columns) changes as Debezium JSON messages with a JSON key."""
    cols = [f for f in changes.schema if f.name not in ("op", "seq")]
    row = F.struct(*[_to_wire(F.col(f.name), f.dataType).alias(f.name) for f in cols])
    code = F.col("op")
    for long, short in OPS.items():
        code = F.when(F.col("op") == long, F.lit(short)).otherwise(code)
    deleted = code == "d"
    seq = [F.col("seq").cast("bigint").alias("ts_ms")] if "seq" in changes.columns else []
    payload = F.struct(
        F.when(deleted, row).alias("before"), F.when(~deleted, row).alias("after"), code.alias("op"), *seq)
    return changes.select(
        F.to_json(F.struct(*key_fields)).alias("key"), F.to_json(F.struct(payload.alias("payload"))).alias("value"))


def encode_keyed(changes: DataFrame, key: Sequence[str], seq: str | None = None) -> DataFrame:
    """One message per key: the row as JSON, or a NULL value (tombstone) when deleted."""
    if seq is not None:
        rest = [c for c in changes.columns if c not in key]
        changes = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__l")).select(*key, "__l.*")
    cols = [f for f in changes.schema if f.name not in ("op", seq)]
    row = F.to_json(F.struct(*[_to_wire(F.col(f.name), f.dataType).alias(f.name) for f in cols]))
    return changes.select(
        F.to_json(F.struct(*key)).alias("key"),
        F.when(~F.col("op").isin("delete", "d"), row).alias("value"))


# -- Avro ---------------------------------------------------------------------

def avro_options(registry: str, topic: str) -> dict[str, str]:
    """Options of a schema-registry backed Avro topic."""
    return {"schema.registry.url": registry, "subject": f"{topic}-value", "mode": "PERMISSIVE"}


def avro_body(df: DataFrame) -> DataFrame:
    """Registry-framed values without the 5-byte header: (schema_id, value)."""
    framed = F.col("value")
    return df.select(
        F.conv(F.hex(F.substring(framed, 2, 4)), 16, 10).cast("int").alias("schema_id"),
        F.expr("substring(value, 6)").alias("value"))


def decode_avro(df: DataFrame, schema_json: str) -> DataFrame:
    """Decode framed Avro values; needs Spark's external Avro module on the class path."""
    from pyspark.sql.avro.functions import from_avro

    body = avro_body(df)
    return body.select(from_avro("value", schema_json, {"mode": "PERMISSIVE"}).alias("__r")).select("__r.*")


# -- CSV blocks and pushed changelogs -----------------------------------------

def decode_csv_block(df: DataFrame, schema: T.StructType, options: dict[str, str] | None = None) -> DataFrame:
    """Values that hold many newline-separated records without a header."""
    lines = df.select(F.explode(F.split(_text(df), "\r?\n")).alias("__line")).filter(F.trim("__line") != "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return lines.select(F.from_csv("__line", ddl, options or {}).alias("__r")).select("__r.*")


def ingest(df: DataFrame, update_format: str, schema: T.StructType) -> DataFrame:
    """Pushed JSON rows as (op, columns): ``raw`` rows are inserts, ``insert_delete``
    rows name their operation."""
    if update_format == "raw":
        return decode_json(df, schema).select(F.lit("insert").alias("op"), "*")
    if update_format != "insert_delete":
        raise ValueError("update_format must be 'raw' or 'insert_delete'")
    both = T.StructType([T.StructField("insert", schema), T.StructField("delete", schema)])
    m = df.select(F.from_json(_text(df), both).alias("m"))
    op = F.when(F.col("m.insert").isNotNull(), "insert").when(F.col("m.delete").isNotNull(), "delete")
    return m.select(op.alias("op"), F.coalesce("m.insert", "m.delete").alias("__r")).filter(
        "op IS NOT NULL").select("op", "__r.*")


def dead_letter_split(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed messages with their context columns)."""
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("__r", F.from_json(_text(df), marked, options))
    broken = F.col("__r").isNull() | F.col(f"__r.{CORRUPT}").isNotNull()
    good = parsed.filter(~broken).select(*[F.col(f"__r.{f.name}").alias(f.name) for f in schema])
    bad = parsed.filter(broken).select(*df.columns, F.lit("malformed JSON").alias("error"))
    return good, bad


def encode_feature(df: DataFrame, schema: T.StructType, headers: dict[str, str]) -> DataFrame:
    """Fixed-schema feature records with constant message headers."""
    row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    entries = [F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value")) for k, v in headers.items()]
    return df.select(F.to_json(row).alias("value"), F.array(*entries).alias("headers"))
