"""Fixture views over the driver's tables.

Each view is a list of expressions valid in both Spark SQL and the oracle's SQL,
so both sides see the same rows. Only integer arithmetic and division by a
double constant are used, which gives the same bits everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_CATEGORY = (
    "CASE event_type WHEN 'purchase' THEN 'gift card' WHEN 'view' THEN 'grocery' "
    "WHEN 'click' THEN 'travel' ELSE 'games' END AS category"
)

TXN = [
    "event_id",
    "user_id AS cc_num",
    "ts",
    _CATEGORY,
    "CAST(value AS DECIMAL(38,2)) AS amt",
    "25.0e0 + (event_id * 37 % 2500) / 100.0e0 AS shipping_lat",
    "-126.0e0 + (event_id * 61 % 5900) / 100.0e0 AS shipping_long",
]
CUST = [
    "c_custkey AS cc_num",
    "c_name AS name",
    "25.0e0 + (c_custkey * 13 % 2500) / 100.0e0 AS lat",
    "-126.0e0 + (c_custkey * 29 % 5900) / 100.0e0 AS long",
]
# Positions near home, so that "far" and "impossible travel" are rare.
NEAR = [
    "event_id",
    "user_id AS cc_num",
    "ts",
    _CATEGORY,
    "CAST(value AS DECIMAL(38,2)) AS amt",
    "25.0e0 + (user_id * 13 % 2500) / 100.0e0 + (event_id * 37 % 90) / 100.0e0 AS shipping_lat",
    "-126.0e0 + (user_id * 29 % 5900) / 100.0e0 + (event_id * 61 % 90) / 100.0e0 AS shipping_long",
]
INTERACTIONS = [
    "event_id AS interaction_id",
    "user_id",
    "event_id % 97 AS video_id",
    "1 + event_id % 11 AS category_id",
    "event_type AS interaction_type",
    "10 + event_id % 241 AS watch_time",
    "ts AS interaction_date",
]
ORDER_BASE = ["o_orderkey", "o_custkey", "o_orderstatus", "CAST(o_totalprice AS DECIMAL(15,2)) AS price"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*TXN)


def near_txn(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*NEAR)


def cust(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*CUST)


def labels_card(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*LABELS).filter("label IS NOT NULL")


LABELS = [
    "c_custkey AS cc_num",
    "CASE WHEN c_custkey % 10 = 0 THEN 'fraud' WHEN c_custkey % 10 IN (1, 2) THEN 'borderline' END AS label",
]
DEMO = CUST + [
    "10000 + c_custkey % 900 AS zip",
    "1000 + c_custkey * 17 % 50000 AS city_pop",
]


def as_ml(txn: DataFrame) -> DataFrame:
    return txn.select(
        "event_id",
        F.col("ts").alias("trans_date_trans_time"),
        "cc_num",
        "category",
        "amt",
        F.unix_timestamp("ts").alias("unix_time"),
        F.expr("CAST(CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS BIGINT)").alias("is_fraud"),
    )


def txn_ml(spark, sf_dir) -> DataFrame:
    return as_ml(txn(spark, sf_dir))


def demo(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        *DEMO, "date_add(DATE'1950-01-01', CAST(c_custkey * 31 % 18000 AS INT)) AS dob"
    )


def fs_txn(spark, sf_dir) -> DataFrame:
    return txn(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("tid"),
        F.col("ts").alias("date_time"),
        F.col("cc_num").cast("string").alias("cc_num"),
        "category",
        F.col("amt").alias("amount"),
        F.col("shipping_lat").alias("latitude"),
        F.col("shipping_long").alias("longitude"),
        F.expr("CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END").alias("fraud_label"),
    )


def profiles(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS cc_num",
        "c_name AS name",
        "lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || '/' || CAST(25 + c_custkey % 5 AS STRING)"
        " AS cc_expiration_date",
        "CAST(date_add(DATE'1950-01-01', CAST(c_custkey * 31 % 18000 AS INT)) AS TIMESTAMP_NTZ) AS birthdate",
    )


def interactions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*INTERACTIONS)


def files(spark, sf_dir) -> DataFrame:
    region = table(spark, sf_dir, "region").selectExpr(
        "CAST(r_regionkey AS BIGINT) AS id", "CAST(NULL AS BIGINT) AS parent_id")
    nation = table(spark, sf_dir, "nation").selectExpr(
        "CAST(100 + n_nationkey AS BIGINT) AS id", "CAST(n_regionkey AS BIGINT) AS parent_id")
    leaf = table(spark, sf_dir, "customer").selectExpr(
        "1100 + c_custkey AS id", "CAST(100 + c_nationkey AS BIGINT) AS parent_id")
    return region.union(nation).union(leaf)


def editors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr(
        "CAST(2 * r_regionkey AS BIGINT) AS group_id", "CAST(r_regionkey AS BIGINT) AS file_id")


def viewers(spark, sf_dir) -> DataFrame:
    """One group per supplier; it views the folder of the supplier's nation and the one seven places on."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS group_id", "explode(array(0, 7)) AS k", "s_nationkey AS nation"
    ).selectExpr("group_id", "CAST(100 + (nation + k) % 25 AS BIGINT) AS file_id")


def users(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("user_id AS id").distinct().selectExpr(
        "id", "concat('user-', id) AS name", "id % 17 = 0 AS is_banned")


def members(spark, sf_dir) -> DataFrame:
    """Every user is in up to three of the groups, whose number grows with the suppliers."""
    n = table(spark, sf_dir, "supplier").count()  # a scalar from file metadata
    return users(spark, sf_dir).selectExpr(
        "id AS user_id", f"explode(array(id % {n}, (3 * id + 1) % {n}, (7 * id + 2) % {n})) AS group_id"
    ).distinct()


def writing_members(spark, sf_dir) -> DataFrame:
    """``members``, and every user in up to three of the ten groups that the editors are among."""
    ten = users(spark, sf_dir).selectExpr(
        "id AS user_id", "explode(array(id % 10, (3 * id + 1) % 10, (7 * id + 2) % 10)) AS group_id")
    return members(spark, sf_dir).unionByName(ten).distinct()


def access_log(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "customer").count()  # a scalar from file metadata
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", f"1100 + event_id * 31 % {n} AS file_id",
        "CASE WHEN event_id % 2 = 0 THEN 'read' ELSE 'write' END AS access_request", "ts")


def order_changes(spark, sf_dir) -> DataFrame:
    """Create for every order, update for every third, delete for every fifth."""
    return table(spark, sf_dir, "orders").selectExpr(*ORDER_BASE).selectExpr(
        "*", "explode(array(1, 2, 3)) AS seq"
    ).filter("seq = 1 OR (seq = 2 AND o_orderkey % 3 = 0) OR (seq = 3 AND o_orderkey % 5 = 0)").selectExpr(
        "CASE seq WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op", "CAST(seq AS BIGINT) AS seq",
        "o_orderkey", "o_custkey", "o_orderstatus",
        "CAST(CASE WHEN seq = 2 THEN price * 2 ELSE price END AS DECIMAL(15,2)) AS price")


def _select(exprs: list[str], source: str) -> str:
    return f"SELECT {', '.join(exprs)} FROM {source}"


# The same views as oracle text. STRING/VARCHAR, date arithmetic and generators
# are the only places where the two dialects differ.
ORACLE_VIEWS: dict[str, str] = {
    "txn": _select(TXN, "events"),
    "near_txn": _select(NEAR, "events"),
    "cust": _select(CUST, "customer"),
    "labels_card": f"SELECT * FROM ({_select(LABELS, 'customer')}) WHERE label IS NOT NULL",
    "demo": _select(
        DEMO + ["DATE '1950-01-01' + CAST(c_custkey * 31 % 18000 AS INTEGER) AS dob"], "customer"),
    "txn_ml": (
        "SELECT event_id, ts AS trans_date_trans_time, cc_num, category, amt, "
        "CAST(floor(epoch(ts)) AS BIGINT) AS unix_time, "
        "CAST(CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS BIGINT) AS is_fraud FROM txn"),
    "fs_txn": (
        "SELECT CAST(event_id AS VARCHAR) AS tid, ts AS date_time, CAST(cc_num AS VARCHAR) AS cc_num, "
        "category, amt AS amount, shipping_lat AS latitude, shipping_long AS longitude, "
        "CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS fraud_label FROM txn"),
    "profiles": (
        "SELECT CAST(c_custkey AS VARCHAR) AS cc_num, c_name AS name, "
        "lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '/' || CAST(25 + c_custkey % 5 AS VARCHAR)"
        " AS cc_expiration_date, "
        "CAST(DATE '1950-01-01' + CAST(c_custkey * 31 % 18000 AS INTEGER) AS TIMESTAMP) AS birthdate "
        "FROM customer"),
    "interactions": _select(INTERACTIONS, "events"),
    "files": (
        "SELECT CAST(r_regionkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id FROM region "
        "UNION ALL SELECT 100 + n_nationkey, n_regionkey FROM nation "
        "UNION ALL SELECT 1100 + c_custkey, 100 + c_nationkey FROM customer"),
    "editors": "SELECT CAST(2 * r_regionkey AS BIGINT) AS group_id, CAST(r_regionkey AS BIGINT) AS file_id FROM region",
    "viewers": (
        "SELECT s_suppkey AS group_id, CAST(100 + (s_nationkey + k) % 25 AS BIGINT) AS file_id "
        "FROM supplier CROSS JOIN (VALUES (0), (7)) AS s(k)"),
    "users": (
        "SELECT DISTINCT user_id AS id, 'user-' || CAST(user_id AS VARCHAR) AS name, "
        "user_id % 17 = 0 AS is_banned FROM events"),
    "members": (
        "SELECT id AS user_id, id % n AS group_id FROM users, suppliers UNION SELECT id, (3 * id + 1) % n "
        "FROM users, suppliers UNION SELECT id, (7 * id + 2) % n FROM users, suppliers"),
    "writing_members": (
        "SELECT user_id, group_id FROM members UNION SELECT id, id % 10 FROM users "
        "UNION SELECT id, (3 * id + 1) % 10 FROM users UNION SELECT id, (7 * id + 2) % 10 FROM users"),
    "suppliers": "SELECT count(*) AS n FROM supplier",
    "access_log": (
        "SELECT event_id, user_id, 1100 + event_id * 31 % (SELECT count(*) FROM customer) AS file_id, "
        "CASE WHEN event_id % 2 = 0 THEN 'read' ELSE 'write' END AS access_request, ts FROM events"),
    "order_changes": (
        "SELECT CASE seq WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op, seq, o_orderkey, o_custkey, "
        "o_orderstatus, CAST(CASE WHEN seq = 2 THEN price * 2 ELSE price END AS DECIMAL(15,2)) AS price "
        f"FROM ({_select(ORDER_BASE, 'orders')}) CROSS JOIN (VALUES (1), (2), (3)) AS v(seq) "
        "WHERE seq = 1 OR (seq = 2 AND o_orderkey % 3 = 0) OR (seq = 3 AND o_orderkey % 5 = 0)"),
}
_NEEDS = {"txn_ml": ["txn"], "fs_txn": ["txn"], "members": ["users", "suppliers"],
          "writing_members": ["users", "suppliers", "members"]}


def oracle(views: str, body: str, recursive: bool = False) -> str:
    """Oracle text: the named fixture views as CTEs in front of ``body``.

    ``body`` may begin with further CTEs written as ``name AS (...), ... SELECT``.
    """
    ordered: list[str] = []
    for name in views.split():
        for need in [*_NEEDS.get(name, []), name]:
            if need not in ordered:
                ordered.append(need)
    ctes = [f"{name} AS ({ORACLE_VIEWS[name]})" for name in ordered]
    word = "WITH RECURSIVE " if recursive else "WITH "
    joiner = "\n" if body.lstrip().upper().startswith(("SELECT", "(")) else ",\n"
    return word + ",\n".join(ctes) + joiner + body.strip() if ctes else body.strip()
