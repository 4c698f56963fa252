"""Changelogs, message codecs and table maintenance on hand-built cases."""

import datetime as dt
import json
from decimal import Decimal

from brute import at, schema
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstream.operators import changes as ch
from rillstream.sources import files, messages, tables
from rillstream.streaming.store import KeyedStore

ROW = schema("id bigint, name string")


def test_upsert_count(spark):
    """10,000 inserts of ids i + batch leave 199 rows, each from the last batch."""
    pushed = spark.range(10_000).selectExpr("id % 100 + id div 100 AS id", "id AS seq", "id div 100 AS batch")
    state = ch.upsert_state(pushed, ["id"], "seq").collect()
    assert len(state) == 199
    assert all(r.batch == min(99, r.id) for r in state)


def envelope(op, before=None, after=None, lsn=0, wrap=True):
    body = {"op": op, "before": before, "after": after, "source": {"lsn": lsn}}
    return json.dumps({"schema": {}, "payload": body} if wrap else body)


def test_cdc_cases(spark):
    values = [
        (envelope("r", after={"id": 1, "name": "snap"}, lsn=1),),
        (envelope("u", after={"id": 2, "name": "unseen"}, lsn=5),),  # update of an unseen key
        (envelope("d", before={"id": 1, "name": "snap"}, lsn=3),),
        (envelope("c", after={"id": 1, "name": "again"}, lsn=4),),  # delete, then insert again
        (envelope("c", after={"id": 1, "name": "again"}, lsn=4),),  # delivered twice
        (envelope("u", after={"id": 3, "name": "new"}, lsn=9, wrap=False),),  # out of order
        (envelope("c", after={"id": 3, "name": "old"}, lsn=7),),
        (envelope("c", after={"id": 4, "name": "gone"}, lsn=10),),
        (envelope("d", before={"id": 4, "name": "gone"}, lsn=11),),
        ("{broken",),
        (None,),  # tombstone
    ]
    raw = spark.createDataFrame(values, "value string")
    changes = messages.debezium_changes(messages.decode_debezium(raw, ROW))
    state = {r.id: r.name for r in ch.cdc_apply(changes, ["id"], "seq").collect()}
    assert state == {1: "again", 2: "unseen", 3: "new"}


def test_zset_cases(spark):
    rows = [("a", 1), ("a", 1), ("b", 1), ("b", -1), ("b", -1), ("c", 1), ("c", -1), ("c2", 1)]
    out = ch.zset_apply(spark.createDataFrame(rows, "v string, w int"), ["v"])
    assert sorted(r.v for r in out.collect()) == ["a", "a", "c2"]


def test_view_diff_and_apply(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], ROW)
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None)], ROW)
    diff = ch.view_diff(old, new, ["id"])
    assert {(r.op, r.id, r.name) for r in diff.collect()} == {("update", 2, "b"), ("delete", 3, "c"), ("insert", 4, None)}
    assert {tuple(r) for r in ch.apply_changes(old, diff, ["id"]).collect()} == {(1, "a"), (2, "b"), (4, None)}
    assert ch.replica_compare(new, new, ["id"], ["name"]).isEmpty()


def test_constraints(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, None, 9), (3, "z", None)], "id int, v string, ref int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    got = {(r.rule, r.key, r.detail) for r in ch.constraint_check(df, ["v"], ["id"], {"ref": (parent, "id")}, "id").collect()}
    assert got == {("not_null", "2", "v"), ("primary_key", "1", "2 rows"), ("foreign_key", "2", "ref=9")}


def test_evolve(spark):
    df = spark.createDataFrame([(1, "n")], "id bigint, extra string")
    out = ch.evolve(df, ROW)
    assert out.columns == ["id", "name", "extra"] and out.first().name is None


def test_debezium_flavors(spark):
    """Dates as epoch days, times as epoch milliseconds, decimals as text."""
    schema = T.StructType.fromDDL("id int, d date, ts timestamp_ntz, amt decimal(10,2), ok boolean, r float")
    after = {"id": 1, "d": 19752, "ts": 1706605080000, "amt": "10.50", "ok": True, "r": 0.5}
    raw = spark.createDataFrame([(bytearray(envelope("c", after=after).encode()),)], "value binary")
    tiny = spark.createDataFrame([(envelope("c", after={**after, "ok": 1}),)], "value string")
    assert messages.debezium_changes(messages.decode_debezium(tiny, schema, "mysql")).first().ok is True
    for flavor in ("mysql", "postgres"):
        r = messages.debezium_changes(messages.decode_debezium(raw, schema, flavor)).first()
        assert (r.d, r.ts, r.amt, r.ok, r.r) == (dt.date(2024, 1, 30), at("2024-01-30 08:58:00"), Decimal("10.50"), True, 0.5)


def test_wide_types_roundtrip(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    df = spark.sql("""
        SELECT 1L AS id, true AS f1, 'foo' AS f2, 7Y AS f3, 10.50BD AS f4, 1e-5D AS f5, TIME'08:58:00' AS f6,
          TIMESTAMP_NTZ'2024-01-30 08:58:00' AS f7, DATE'2024-01-30' AS f8, X'626172' AS f9,
          parse_json('{"id":1,"f4":10.5}') AS f10, '0e7f1c1e-3f6c-4b8a-9f5e-000000000001' AS f11
        UNION ALL SELECT 2L, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""")
    df = df.withColumn("f4", F.col("f4").cast("decimal(5,2)"))
    encode = lambda x: messages.encode_debezium(x.withColumn("op", F.lit("insert")), ["id"])
    decode = lambda m: messages.debezium_changes(
        messages.decode_debezium(m.withColumn("offset", F.lit(1)), df.schema)).drop("op", "seq")
    back = ch.roundtrip(df, encode, decode)
    assert [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    text = lambda x: sorted(
        tuple(map(str, r)) for r in x.withColumns({"f10": F.to_json("f10"), "f6": F.col("f6").cast("string")}).collect())
    assert text(back) == text(df)


def test_keyed_encoding_and_tombstones(spark):
    changes = spark.createDataFrame([("insert", 1, "a", 1), ("update", 1, "b", 2), ("delete", 2, "x", 1)], "op string, id int, name string, seq int")
    out = {json.loads(r.key)["id"]: r.value and json.loads(r.value) for r in messages.encode_keyed(changes, ["id"], "seq").collect()}
    assert out == {1: {"id": 1, "name": "b"}, 2: None}


def test_avro_framing_and_options(spark):
    raw = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x01\x02payload"),)], "value binary")
    r = messages.avro_body(raw).first()
    assert r.schema_id == 258 and bytes(r.value) == b"payload"
    assert messages.avro_options("http://registry", "t")["subject"] == "t-value"
    assert messages.kafka_options("b:9092", "t")["startingOffsets"] == "earliest"
    assert tables.jdbc_options("jdbc:x", "t", "u", "p")["dbtable"] == "t_staging"
    assert tables.follow_options("delta", 10) == {"startingVersion": "10"}


def test_csv_blocks(spark):
    raw = spark.createDataFrame([("1,a\n2,b\r\n\n",), ("3,\"c,d\"",)], "value string")
    out = messages.decode_csv_block(raw, ROW).collect()
    assert sorted((r.id, r.name) for r in out) == [(1, "a"), (2, "b"), (3, "c,d")]


def test_ingest_formats(spark):
    raw = spark.createDataFrame([('{"id":1,"name":"a"}',)], "value string")
    assert [tuple(r) for r in messages.ingest(raw, "raw", ROW).collect()] == [("insert", 1, "a")]
    both = spark.createDataFrame([('{"insert":{"id":1,"name":"a"}}',), ('{"delete":{"id":2}}',)], "value string")
    assert {tuple(r) for r in messages.ingest(both, "insert_delete", ROW).collect()} == {("insert", 1, "a"), ("delete", 2, None)}


def test_dead_letters_keep_context(spark):
    raw = spark.createDataFrame([(1, '{"id":1,"name":"a"}'), (2, '{"id":"x"}'), (3, "nope")], "offset bigint, value string")
    good, bad = messages.dead_letter_split(raw, ROW)
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert sorted(r.offset for r in bad.collect()) == [2, 3]


def test_csv_null_policies(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,ts,amt\n1,2024-01-01 00:00:00,\n2,,5\n3,2024-01-02 10:00:00,2.5\n")
    schema = T.StructType.fromDDL("id bigint, ts timestamp_ntz, amt double")
    nulls = {r.id: r.amt for r in files.read_csv(spark, str(tmp_path), schema).collect()}
    zeros = {r.id: r.amt for r in files.read_csv(spark, str(tmp_path), schema, "zero").collect()}
    assert nulls == {1: None, 3: 2.5} and zeros == {1: 0.0, 3: 2.5}


def test_replay_split_shapes(spark, monkeypatch):
    monkeypatch.setattr(files, "NUMBERING_ROWS", 7)  # several slices even for a tiny table
    rows = [(i, at("2024-01-01") + dt.timedelta(minutes=(i * 7919) % 100)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    order = [i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))]
    got = {r.id: r.rn for r in files.global_row_number(df, "ts", ["id"]).collect()}
    assert got == {i: n for n, i in enumerate(order)}
    by_rows = files.split_replay(df, "ts", ["id"], 40, batch_rows=25).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in by_rows} == {-1: 40, 0: 25, 1: 25, 2: 10}
    by_steps = files.split_replay(df, "ts", ["id"], 40, n_steps=7).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in by_steps} == {-1: 40, **{i: 8 for i in range(6)}, 6: 12}  # the last step takes what is left over


def test_numbering_slices_are_equally_deep(spark, monkeypatch):
    """A burst of one time stamp beside a sparse year, with rows without a time: no slice over twice the mean."""
    monkeypatch.setattr(files, "NUMBERING_ROWS", 1000)
    burst, sparse = at("2024-06-01"), at("2024-01-01")
    df = spark.range(20_000).select("id", F.when(F.col("id") % 997 == 5, None).when(
        F.col("id") < 18_000, F.lit(burst)).otherwise(F.lit(sparse) + F.make_dt_interval(
            hours=(F.col("id") % 8000).cast("int"))).cast("timestamp_ntz").alias("ts"))
    bounds = files._bounds(df, ["ts", "id"])
    depth = [r["count"] for r in df.crossJoin(bounds).groupBy(
        files.position(F.col("__bounds"), F.col("__steps"), F.struct("ts", "id"))).count().collect()]
    assert len(depth) == 20 and max(depth) < 2 * 1000
    got = {r.id: r.rn for r in files.global_row_number(df, "ts", ["id"]).collect()}
    rows = sorted(df.collect(), key=lambda r: (r.ts is not None, r.ts or burst, r.id))
    assert got == {r.id: n for n, r in enumerate(rows)}


def test_upsert_store_is_idempotent_and_evolves(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ROW, ["id"], buckets=4)
    make = lambda rows, ddl="op string, id bigint, name string": spark.createDataFrame(rows, ddl)
    store.write(make([("insert", 1, "a"), ("insert", 2, "b")]), 0)
    for _ in range(2):  # a retried epoch
        store.write(make([("update", 1, "c"), ("delete", 2, None), ("insert", 3, "d")]), 1)
    assert {tuple(r) for r in store.current().collect()} == {(1, "c"), (3, "d")}
    assert {tuple(r) for r in store.current(upto=0).collect()} == {(1, "a"), (2, "b")}
    store.write(make([("insert", 4, "e", 9)], "op string, id bigint, name string, extra int"), 2)
    assert {tuple(r) for r in store.current().collect()} == {(1, "c", None), (3, "d", None), (4, "e", 9)}
    merged = store.compact(str(tmp_path / "m"), 2)
    assert {tuple(r) for r in merged.current().collect()} == {(1, "c", None), (3, "d", None), (4, "e", 9)}


def test_synth_plans(spark):
    from rillstream.sources.synth import FieldPlan, TablePlan, synth

    schema = T.StructType.fromDDL("id bigint, user_id bigint, parent bigint, kind string, ts timestamp_ntz, ip string, who string")
    plan = TablePlan(2000, {
        "id": FieldPlan(bounds=(100, 1100)), "user_id": FieldPlan("zipf", (0, 50)), "parent": FieldPlan("uniform", (0, 10), null_pct=30),
        "kind": FieldPlan(values=["read", "write"]), "ip": FieldPlan("ipv4"), "who": FieldPlan("name"),
        "ts": FieldPlan(bounds=("2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z"), scale=1000)})
    df = synth(spark, schema, [plan, TablePlan(5, {"user_id": FieldPlan(values=[42])})], seed=3)
    rows = df.collect()
    assert sorted(map(str, rows)) == sorted(map(str, df.repartition(5).collect()))  # a function of the row number
    main = rows[:2000]
    assert {r.id for r in main} == set(range(100, 1100))
    counts = [sum(r.user_id == u for r in main) for u in (0, 20)]
    assert counts[0] > 5 * counts[1] and max(r.user_id for r in main) < 50
    assert 0.2 < sum(r.parent is None for r in main) / 2000 < 0.4
    assert {r.kind for r in main} == {"read", "write"}
    assert min(r.ts for r in main) == at("2026-01-01") and max(r.ts for r in main) == at("2026-01-01 00:33:19")
    assert all(len(r.ip.split(".")) == 4 for r in main)
    assert [r.user_id for r in rows[2000:]] == [42] * 5


def test_null_keys_and_ordered_changes(spark, tmp_path):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "id bigint, name string")
    new = spark.createDataFrame([(None, "z"), (1, "b")], "id bigint, name string")
    assert {tuple(r) for r in ch.apply_changes(old, ch.view_diff(old, new, ["id"]), ["id"]).collect()} == {(None, "z"), (1, "b")}
    assert ch.replica_compare(new, new, ["id"], ["name"]).isEmpty()
    many = spark.createDataFrame([("a", 25_001), ("b", 2)], "v string, w bigint")
    assert {(r.v, r["count"]) for r in ch.zset_apply(many, ["v"]).groupBy("v").count().collect()} == {("a", 25_001), ("b", 2)}


def test_positions_of_a_log_are_ordered_across_files_and_rows(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    def message(v, file, pos, row):
        return ('{"op":"u","after":{"id":1,"v":"%s"},"source":{"file":"log.%06d","pos":%d,"row":%d}}' % (v, file, pos, row),)
    raw = spark.createDataFrame([message("last", 10, 4, 1), message("old", 9, 9000, 0), message("mid", 10, 4, 0)], "value string")
    out = ch.upsert_state(messages.debezium_changes(messages.decode_debezium(raw, schema, "mysql")), ["id"], "seq")
    assert [r.v for r in out.collect()] == ["last"]
    bad = spark.createDataFrame([("{oops",), ("",), (None,), ('{"id":3,"v":"x"}',)], "value string")
    assert [r.id for r in messages.decode_json(bad, schema).collect()] == [3]
