"""Source decoding, changelog and table-maintenance queries."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from .. import fixtures as fx
from ..operators import changes as ch
from ..operators import relational as rel
from ..plans import features, reports
from ..session import scratch
from ..sources import files, messages, tables
from ..streaming.store import History, KeyedStore
from .base import Catalog

CATALOG = Catalog()
q = CATALOG.query
o = fx.oracle

ORDER = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("price", T.DecimalType(15, 2))])
TXN = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("cc_num", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("category", T.StringType()),
    T.StructField("amt", T.DecimalType(38, 2)), T.StructField("shipping_lat", T.DoubleType()),
    T.StructField("shipping_long", T.DoubleType())])


def _dbl(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# -- sources ------------------------------------------------------------------

@q("csv_scan_typed", o("txn", "SELECT event_id, cc_num, date_trunc('second', ts) AS ts, category, "
   "CAST(CASE WHEN event_id % 7 = 0 THEN 0 ELSE amt END AS DOUBLE) AS amt FROM txn WHERE event_id % 11 <> 0"))
def csv_scan_typed(spark, d):
    """Writes the transactions as header CSV with empty amounts and times, scans them typed."""
    path = scratch(spark, "csv")
    raw = fx.txn(spark, d).select(
        "event_id", "cc_num", F.when(F.col("event_id") % 11 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts"),
        "category", F.when(F.col("event_id") % 7 != 0, F.col("amt")).alias("amt"))
    raw.write.option("header", True).csv(path)
    schema = T.StructType([f for f in TXN if f.name in raw.columns])
    return _dbl(files.read_csv(spark, path, schema, "zero"), "amt")


def _split(spark, d):
    txn = fx.txn(spark, d)
    size = max(1, txn.count() // 20)
    return files.split_replay(txn, "ts", ["event_id"], 10 * size, size)


_SPLIT = """
sized AS (SELECT greatest(1, count(*) // 20) AS size FROM txn),
numbered AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn FROM txn),
split AS (SELECT event_id, ts, CASE WHEN rn < 10 * size THEN -1 ELSE (rn - 10 * size) // size END AS batch_id
          FROM numbered, sized)
"""


@q("replay_split", o("txn", _SPLIT + "SELECT event_id, CAST(batch_id AS BIGINT) AS batch_id FROM split"))
def replay_split(spark, d):
    return _split(spark, d).select("event_id", "batch_id")


@q("replay_window_schedule", o("txn", _SPLIT + """,
per AS (SELECT batch_id, count(*) AS n_rows, min(ts) AS lo, max(ts) AS hi FROM split WHERE batch_id >= 0 GROUP BY batch_id),
ends AS (SELECT *, max(hi) OVER (ORDER BY batch_id) AS win_end FROM per)
SELECT CAST(batch_id AS BIGINT) AS batch_id, n_rows, coalesce(lag(win_end) OVER (ORDER BY batch_id), lo) AS win_start, win_end FROM ends"""))
def replay_window_schedule(spark, d):
    return files.replay_schedule(_split(spark, d), "ts")


@q("json_raw_decode", "SELECT event_id, user_id, event_type, value FROM events")
def json_raw_decode(spark, d):
    raw = fx.table(spark, d, "events").select(
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).cast("binary").alias("value"))
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    return messages.decode_json(raw, schema)


def _envelopes(spark, d):
    """order_changes as Debezium messages with a broker offset."""
    changes = fx.order_changes(spark, d).withColumn(
        "op", F.when(F.col("op") == "c", "insert").when(F.col("op") == "u", "update").otherwise("delete"))
    return messages.encode_debezium(changes, ["o_orderkey"])


@q("debezium_json_decode", o("order_changes",
   "SELECT op, CAST(seq AS BIGINT) AS seq, o_orderkey, o_custkey, o_orderstatus, CAST(price AS DOUBLE) AS price FROM order_changes"))
def debezium_json_decode(spark, d):
    return _dbl(messages.debezium_changes(messages.decode_debezium(_envelopes(spark, d), ORDER)), "price")


@q("avro_decode_options", "SELECT event_id, CAST(7 + event_id % 3 AS INTEGER) AS schema_id, event_type AS body FROM events")
def avro_decode_options(spark, d):
    """Registry framing taken off event payloads: a zero byte, the schema id, the body."""
    framed = F.concat(
        F.unhex(F.lpad(F.hex(7 + F.col("event_id") % 3), 10, "0")), F.col("event_type").cast("binary"),
        F.lit("|").cast("binary"), F.col("event_id").cast("string").cast("binary"))
    body = messages.avro_body(fx.table(spark, d, "events").select(framed.alias("value")))
    parts = F.split(F.col("value").cast("string"), "[|]")
    return body.select(parts[1].cast("bigint").alias("event_id"), "schema_id", parts[0].alias("body"))


@q("csv_multirecord_decode", o("interactions", "SELECT interaction_id, user_id, video_id, interaction_type, watch_time FROM interactions"))
def csv_multirecord_decode(spark, d):
    """Blocks of up to 500 newline-separated records."""
    cols = ["interaction_id", "user_id", "video_id", "interaction_type", "watch_time"]
    lines = fx.interactions(spark, d).select(
        F.floor(F.col("interaction_id") / 500).alias("block"), F.concat_ws(",", *cols).alias("line"))
    blocks = lines.groupBy("block").agg(F.array_join(F.collect_list("line"), "\n").alias("value"))
    schema = T.StructType([T.StructField(c, T.StringType() if c == "interaction_type" else T.LongType()) for c in cols])
    return messages.decode_csv_block(blocks.select("value"), schema)


@q("snapshot_source", o("txn_ml", "SELECT event_id, cc_num, unix_time, CAST(amt AS DOUBLE) AS amt, is_fraud FROM txn_ml"))
def snapshot_source(spark, d):
    path = scratch(spark, "snapshot")
    rows = fx.txn_ml(spark, d)
    rows.write.parquet(path)
    return _dbl(tables.snapshot(spark, path, schema=rows.schema), "amt").select(
        "event_id", "cc_num", "unix_time", "amt", "is_fraud")


@q("changelog_ingest", o("order_changes",
   "SELECT CASE WHEN op = 'd' THEN 'delete' ELSE 'insert' END AS op, o_orderkey, o_orderstatus FROM order_changes"))
def changelog_ingest(spark, d):
    row = F.struct("o_orderkey", "o_orderstatus")
    pushed = fx.order_changes(spark, d).select(F.when(
        F.col("op") == "d", F.to_json(F.struct(row.alias("delete")))).otherwise(
        F.to_json(F.struct(row.alias("insert")))).alias("value"))
    schema = T.StructType([f for f in ORDER if f.name in ("o_orderkey", "o_orderstatus")])
    return messages.ingest(pushed, "insert_delete", schema)


@q("dimension_load", o("cust", "SELECT cc_num, name, lat, long FROM cust"))
def dimension_load(spark, d):
    return tables.dimension_state(fx.cust(spark, d), ["cc_num"])


@q("debezium_json_encode", o("order_changes", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, op, o_orderstatus, CAST(price AS DOUBLE) AS price FROM order_changes"""))
def debezium_json_encode(spark, d):
    """Encoded messages read back field by field."""
    m = _envelopes(spark, d)
    side = F.when(F.get_json_object("value", "$.payload.op") == "d", "before").otherwise("after")
    field = lambda name: F.when(side == "before", F.get_json_object("value", f"$.payload.before.{name}")).otherwise(
        F.get_json_object("value", f"$.payload.after.{name}"))
    return m.select(
        F.get_json_object("key", "$.o_orderkey").cast("bigint").alias("o_orderkey"),
        F.get_json_object("value", "$.payload.op").alias("op"), field("o_orderstatus").alias("o_orderstatus"),
        field("price").cast("double").alias("price"))


_LAST_ORDER = ("SELECT * FROM order_changes QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1")


@q("keyed_upsert_encode", o("order_changes", f"SELECT o_orderkey, op = 'd' AS tombstone, "
   f"CASE WHEN op = 'd' THEN '' ELSE o_orderstatus END AS o_orderstatus FROM ({_LAST_ORDER})"))
def keyed_upsert_encode(spark, d):
    m = messages.encode_keyed(fx.order_changes(spark, d), ["o_orderkey"], "seq")
    return m.select(
        F.get_json_object("key", "$.o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("value").isNull().alias("tombstone"),
        F.coalesce(F.get_json_object("value", "$.o_orderstatus"), F.lit("")).alias("o_orderstatus"))


@q("feature_topic_encode", o("fs_txn", "SELECT tid, CAST(amount AS DOUBLE) AS amount, 'projectId,featureGroupId,subjectId' AS header_keys FROM fs_txn"))
def feature_topic_encode(spark, d):
    schema = T.StructType([T.StructField("tid", T.StringType()), T.StructField("amount", T.DoubleType())])
    m = messages.encode_feature(
        fx.fs_txn(spark, d), schema, {"projectId": "1", "featureGroupId": "2", "subjectId": "3"})
    return m.select(
        F.get_json_object("value", "$.tid").alias("tid"), F.get_json_object("value", "$.amount").cast("double").alias("amount"),
        F.array_join("headers.key", ",").alias("header_keys"))


@q("dead_letter_split", "SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'bad' ELSE 'good' END AS side, count(*) AS n, "
   "CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY ALL")
def dead_letter_split(spark, d):
    body = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
    raw = fx.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("{oops"), body)).otherwise(body).alias("value"))
    schema = T.StructType([f for f in ORDER if f.name != "price"])
    good, bad = messages.dead_letter_split(raw, schema)
    sides = good.select(F.lit("good").alias("side"), "o_orderkey").unionByName(
        bad.select(F.lit("bad").alias("side"), "o_orderkey"))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@q("truncate_sink", "SELECT event_id, event_type FROM events")
def truncate_sink(spark, d):
    """Old content is replaced by the first epoch; a repeated epoch changes nothing."""
    path = scratch(spark, "truncate")
    rows = fx.table(spark, d, "events").select("event_id", "event_type")
    sink = tables.truncate_sink(path)
    sink(rows, 0)  # content of an earlier run
    parts = [rows.filter("event_type IN ('view', 'click')"), rows.filter("event_type NOT IN ('view', 'click')")]
    for epoch in (0, 1, 1):
        sink(parts[epoch], epoch)
    return spark.read.parquet(path).drop("epoch")


@q("upsert_sink", o("order_changes", f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(price AS DOUBLE) AS price "
   f"FROM ({_LAST_ORDER}) WHERE op <> 'd'"))
def upsert_sink(spark, d):
    store = KeyedStore(spark, scratch(spark, "upsert"), ORDER, ["o_orderkey"], buckets=8)
    sink = tables.upsert_sink(store, "seq")
    op = F.when(F.col("op") == "c", "insert").when(F.col("op") == "u", "update").otherwise("delete")
    changes = fx.order_changes(spark, d).withColumn("op", op)
    for epoch in (0, 1):  # a batch holds all changes of its orders, in any order
        sink(changes.filter(F.col("o_orderkey") % 2 == epoch), epoch)
    return _dbl(store.current(), "price")


@q("history_write", o("txn", "SELECT event_id, cc_num, ts, CAST(amt AS DOUBLE) AS amt FROM txn"))
def history_write(spark, d):
    """Preload and later rows under their epochs; writing an epoch twice changes nothing."""
    txn = fx.txn(spark, d)
    history = History(spark, scratch(spark, "history"), TXN, ["cc_num"], "ts", buckets=8)
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    tables.history_write(txn.filter(F.col("ts") < cut), history, 0)
    for _ in range(2):
        tables.history_write(txn.filter(F.col("ts") >= cut), history, 1)
    return _dbl(history.read(), "amt").select("event_id", "cc_num", "ts", "amt")


@q("feature_table", o("txn_ml", "SELECT event_id, CAST(amt AS DOUBLE) AS amt, unix_time, is_fraud FROM txn_ml"))
def feature_table(spark, d):
    rows = fx.txn_ml(spark, d).select("event_id", "amt", "unix_time", "is_fraud")
    return features.feature_table(rows, scratch(spark, "features"))


@q("metrics_sink", "SELECT event_type AS detector, count(*) AS n FROM events GROUP BY event_type")
def metrics_sink(spark, d):
    path = scratch(spark, "metrics")
    tables.metrics_sink(rel.count_by(fx.table(spark, d, "events"), ["event_type"]), path)
    return spark.read.schema("detector string, n bigint").option("header", True).csv(path)


@q("adhoc_query", o("txn cust", "SELECT name, count(*) AS n FROM txn JOIN cust USING (cc_num) WHERE amt > 20 GROUP BY name"))
def adhoc_query(spark, d):
    return rel.adhoc(
        spark, {"rill_txn": fx.txn(spark, d), "rill_cust": fx.cust(spark, d)},
        "SELECT name, count(*) AS n FROM rill_txn JOIN rill_cust USING (cc_num) WHERE amt > 20 GROUP BY name")


# -- changelogs ---------------------------------------------------------------

@q("pk_upsert_latest", o("order_changes",
   f"SELECT o_orderkey, op, seq::BIGINT AS seq, CAST(price AS DOUBLE) AS price FROM ({_LAST_ORDER})"))
def pk_upsert_latest(spark, d):
    out = ch.upsert_state(fx.order_changes(spark, d), ["o_orderkey"], "seq")
    return _dbl(out.select("o_orderkey", "op", "seq", "price"), "price")


@q("cdc_apply", o("order_changes",
   f"SELECT o_orderkey, o_custkey, o_orderstatus, CAST(price AS DOUBLE) AS price FROM ({_LAST_ORDER}) WHERE op <> 'd'"))
def cdc_apply(spark, d):
    decoded = messages.debezium_changes(messages.decode_debezium(_envelopes(spark, d), ORDER))
    return _dbl(ch.cdc_apply(decoded, ["o_orderkey"], "seq"), "price")


@q("zset_apply", """
WITH ch AS (
  SELECT event_type, user_id, 1 AS w FROM events UNION ALL SELECT event_type, user_id, -1 FROM events WHERE event_id % 3 = 0),
net AS (SELECT event_type, user_id, sum(w) AS n FROM ch GROUP BY ALL HAVING sum(w) > 0)
SELECT event_type, user_id FROM net, unnest(range(CAST(n AS BIGINT))) AS r(i)""")
def zset_apply(spark, d):
    e = fx.table(spark, d, "events").select("event_id", "event_type", "user_id")
    weights = e.select("event_type", "user_id", F.lit(1).alias("w")).unionByName(
        e.filter("event_id % 3 = 0").select("event_type", "user_id", F.lit(-1).alias("w")))
    return ch.zset_apply(weights, ["event_type", "user_id"])


_VERSIONS = """
base AS (SELECT o_orderkey, o_orderstatus, CAST(price AS DOUBLE) AS price FROM order_changes WHERE op = 'c'),
v2 AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN price * 2 ELSE price END AS price
       FROM base WHERE o_orderkey % 5 <> 0),
v1 AS (SELECT * FROM base WHERE o_orderkey % 4 <> 0)
"""


def _versions(spark, d):
    base = _dbl(fx.order_changes(spark, d).filter("op = 'c'").select("o_orderkey", "o_orderstatus", "price"), "price")
    v2 = base.filter("o_orderkey % 5 <> 0").withColumn(
        "price", F.when(F.col("o_orderkey") % 3 == 0, F.col("price") * 2).otherwise(F.col("price")))
    return base.filter("o_orderkey % 4 <> 0"), v2


@q("view_diff", o("order_changes", _VERSIONS + """
SELECT CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS op,
  coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus,
  coalesce(b.price, a.price) AS price
FROM v1 a FULL JOIN v2 b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.price <> b.price OR a.o_orderstatus <> b.o_orderstatus"""))
def view_diff(spark, d):
    return ch.view_diff(*_versions(spark, d), ["o_orderkey"])


@q("replica_compare", o("order_changes", _VERSIONS + """
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'missing_right' WHEN a.o_orderkey IS NULL THEN 'missing_left' ELSE 'differs' END AS problem
FROM v1 a FULL JOIN v2 b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.price <> b.price"""))
def replica_compare(spark, d):
    return ch.replica_compare(*_versions(spark, d), ["o_orderkey"], ["price"])


@q("replica_count", o("order_changes", _VERSIONS + """
SELECT 'left' AS replica, count(*) AS n, (SELECT count(*) FROM v1) = (SELECT count(*) FROM v2) AS converged FROM v1
UNION ALL SELECT 'right', count(*), (SELECT count(*) FROM v1) = (SELECT count(*) FROM v2) FROM v2"""))
def replica_count(spark, d):
    a, b = _versions(spark, d)
    return ch.replica_count({"left": a, "right": b})


@q("constraint_check", """
SELECT 'primary_key' AS rule, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key,
  CAST(count(*) AS VARCHAR) || ' rows' AS detail
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'foreign_key', CAST(l_orderkey AS VARCHAR), 'l_partkey=' || CAST(l_partkey AS VARCHAR) FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 50 <> 0)
UNION ALL
SELECT 'not_null', CAST(l_orderkey AS VARCHAR), 'discounted' FROM lineitem WHERE l_discount = 0""")
def constraint_check(spark, d):
    items = fx.table(spark, d, "lineitem").withColumn("discounted", F.nullif("l_discount", F.lit(0.0)))
    parts = fx.table(spark, d, "part").filter("p_partkey % 50 <> 0")
    return ch.constraint_check(
        items, not_null=["discounted"], pk=["l_orderkey", "l_linenumber"],
        fk={"l_partkey": (parts, "p_partkey")}, row_key="l_orderkey")


@q("schema_evolve", "SELECT o_orderkey, o_orderstatus, '' AS channel, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0 "
   "UNION ALL SELECT o_orderkey, o_orderstatus, 'web', o_totalprice FROM orders WHERE o_orderkey % 2 = 1")
def schema_evolve(spark, d):
    """The second epoch brings a column the table did not have."""
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").withColumn("op", F.lit("insert"))
    store = KeyedStore(spark, scratch(spark, "evolve"), orders.drop("op").schema, ["o_orderkey"], buckets=8)
    store.write(orders.filter("o_orderkey % 2 = 0"), 0)
    store.write(orders.filter("o_orderkey % 2 = 1").withColumn("channel", F.lit("web")), 1)
    return store.current().withColumn("channel", F.coalesce("channel", F.lit("")))


@q("wide_type_roundtrip", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, "
   "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey % 2 = 0 AS even, "
   "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS price, '{\"k\":' || CAST(o_custkey AS VARCHAR) || '}' AS doc, "
   "hex(encode(o_orderstatus)) AS bin FROM orders")
def wide_type_roundtrip(spark, d):
    typed = fx.table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", F.to_date("o_orderdate").alias("day"),
        (F.col("o_orderkey") % 2 == 0).alias("even"), F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.parse_json(F.to_json(F.struct(F.col("o_custkey").alias("k")))).alias("doc"),
        F.col("o_orderstatus").cast("binary").alias("bin"))
    back = ch.roundtrip(
        typed, lambda x: messages.encode_debezium(x.withColumn("op", F.lit("insert")), ["o_orderkey"]),
        lambda m: messages.debezium_changes(messages.decode_debezium(m.withColumn("offset", F.lit(0)), typed.schema)))
    return back.drop("op", "seq").withColumns({
        "day": F.col("day").cast("string"), "price": F.col("price").cast("double"),
        "doc": F.to_json("doc"), "bin": F.hex("bin")})


@q("cdc_reporting", """
SELECT o_orderkey AS order_number, o_orderdate AS order_date, l_quantity AS quantity, c_name AS first_name,
  c_mktsegment AS last_name, p_name AS product
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
JOIN part ON p_partkey = l_partkey WHERE o_orderkey % 5 <> 0""")
def cdc_reporting(spark, d):
    """Order report over a CDC snapshot in which every fifth order was deleted."""
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    log = orders.select("*", F.lit("c").alias("op"), F.lit(1).alias("seq")).unionByName(
        orders.filter("o_orderkey % 5 = 0").select("*", F.lit("d").alias("op"), F.lit(2).alias("seq")))
    now = ch.cdc_apply(log, ["o_orderkey"], "seq")
    lines = fx.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"))
    sold = now.join(lines, "o_orderkey").select(
        F.col("o_orderkey").alias("order_number"), F.col("o_orderdate").alias("order_date"), "quantity",
        F.col("o_custkey").alias("purchaser"), "product_id")
    customers = fx.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"))
    products = fx.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return reports.order_report(sold, customers, products)


@q("cdc_stock", "SELECT p_partkey AS id, p_name AS name, p_type AS description, CAST(sum(l_quantity) AS DOUBLE) AS quantity "
   "FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL")
def cdc_stock(spark, d):
    products = fx.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"))
    on_hand = fx.table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.sum("l_quantity").alias("quantity"))
    return reports.stock_report(products, on_hand)
