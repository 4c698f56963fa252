"""Changelogs and table maintenance.

A changelog is a DataFrame with an ``op`` column, an ordering column and the
table's columns. Current state is always an aggregation per key (combined map
side), never a window sort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

INSERT, DELETE, UPDATE = "insert", "delete", "update"
COPIES = 10_000  # copies of a row made from one array


def upsert_state(changes: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """Last write per key."""
    rest = [c for c in changes.columns if c not in key]
    last = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__last"))
    return last.select(*key, "__last.*").select(*changes.columns)


def cdc_apply(changes: DataFrame, key, seq: str, op: str = "op", deletes=("d", DELETE)) -> DataFrame:
    """Snapshot after create/read/update/delete changes."""
    return upsert_state(changes, key, seq).filter(~F.col(op).isin(*deletes)).drop(op, seq)


def zset_apply(changes: DataFrame, cols: Sequence[str], weight: str = "w") -> DataFrame:
    """Multiset after weighted inserts (+) and deletes (-); rows keep their multiplicity."""
    net = changes.groupBy(*cols).agg(F.sum(weight).cast("bigint").alias("__n")).filter("__n > 0")
    # in bounded arrays, however large the multiplicity
    chunk = net.select(*cols, "__n", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(COPIES))).alias("__at"))
    copies = F.array_repeat(F.lit(1), F.least(F.lit(COPIES), F.col("__n") - F.col("__at")).cast("int"))
    return chunk.select(*cols, F.explode(copies).alias("__one")).drop("__one")


def _differs(a: str, b: str, cols: Sequence[str]) -> Column:
    tests = [~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    return reduce(lambda x, y: x | y, tests, F.lit(False))


def view_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changes that turn ``old`` into ``new``: op, then the new values (old ones on delete)."""
    cols = [c for c in new.columns if c not in key]
    a = old.select(*new.columns).withColumn("__in", F.lit(True)).alias("a")
    b = new.withColumn("__in", F.lit(True)).alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key])
    gone, fresh = F.col("b.__in").isNull(), F.col("a.__in").isNull()
    op = F.when(fresh, INSERT).when(gone, DELETE).when(_differs("a", "b", cols), UPDATE)
    values = [F.when(gone, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in new.columns]
    return a.join(b, on, "full").select(op.alias("op"), *values).filter("op IS NOT NULL")


def apply_changes(old: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``old`` after ``changes`` as produced by ``view_diff``."""
    named = changes.select(*[F.col(k).alias(f"__c_{k}") for k in key])
    kept = old.join(named, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in key]), "left_anti")
    return kept.unionByName(changes.filter(F.col("op") != DELETE).drop("op"))


def replica_compare(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys missing on one side or differing in a column; empty means equal."""
    x = a.select(*key, *cols).withColumn("__in", F.lit(True)).alias("a")
    y = b.select(*key, *cols).withColumn("__in", F.lit(True)).alias("b")
    on = reduce(lambda p, q: p & q, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key])
    problem = (
        F.when(F.col("b.__in").isNull(), "missing_right")
        .when(F.col("a.__in").isNull(), "missing_left")
        .when(_differs("a", "b", cols), "differs")
    )
    return x.join(y, on, "full").select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in key], problem.alias("problem")
    ).filter("problem IS NOT NULL")


def replica_count(dfs: dict[str, DataFrame], expected: int | None = None) -> DataFrame:
    """Rows per replica and whether all agree (with ``expected`` when given)."""
    counts = reduce(
        lambda a, b: a.unionByName(b),
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("replica"), "n") for name, df in dfs.items()],
    )
    bounds = counts.agg(F.min("n").alias("__lo"), F.max("n").alias("__hi"))
    target = F.col("__hi") if expected is None else F.lit(expected)
    return counts.join(F.broadcast(bounds)).select(
        "replica", "n", ((F.col("__lo") == target) & (F.col("__hi") == target)).alias("converged"))


def apply_bans(users: DataFrame, verdicts: DataFrame, key: str = "id") -> DataFrame:
    """Delete + insert pairs that ban the listed users; unknown or banned ones are skipped."""
    hit = users.filter(~F.coalesce(F.col("is_banned"), F.lit(False))).join(
        verdicts.select(key).distinct(), key, "left_semi")
    pair = F.array(
        F.struct(F.lit(DELETE).alias("op"), F.lit(-1).alias("w"), F.lit(False).alias("is_banned")),
        F.struct(F.lit(INSERT).alias("op"), F.lit(1).alias("w"), F.lit(True).alias("is_banned")))
    rest = [c for c in users.columns if c != "is_banned"]
    return hit.select(*rest, F.inline(pair)).select("op", "w", *users.columns)


def constraint_check(
    df: DataFrame,
    not_null: Sequence[str] = (),
    pk: Sequence[str] = (),
    fk: dict[str, tuple[DataFrame, str]] | None = None,
    row_key: str | None = None,
) -> DataFrame:
    """Violations as rows (rule, key, detail)."""
    ident = F.col(row_key or (pk[0] if pk else df.columns[0])).cast("string")
    found = [
        df.filter(F.col(c).isNull()).select(
            F.lit("not_null").alias("rule"), ident.alias("key"), F.lit(c).alias("detail"))
        for c in not_null
    ]
    if pk:
        found.append(
            df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
                F.lit("primary_key").alias("rule"),
                F.concat_ws("|", *[F.col(c).cast("string") for c in pk]).alias("key"),
                F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("detail")))
    for col, (parent, parent_col) in (fk or {}).items():
        missing = df.filter(F.col(col).isNotNull()).join(
            parent.select(F.col(parent_col).alias(col)), col, "left_anti")
        found.append(missing.select(
            F.lit("foreign_key").alias("rule"), F.col(row_key or col).cast("string").alias("key"),
            F.concat(F.lit(col + "="), F.col(col).cast("string")).alias("detail")))
    return reduce(lambda a, b: a.unionByName(b), found)


def evolve(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with the target's columns first; absent ones NULL, new ones kept."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in target if f.name not in df.columns]
    widened = df.select("*", *missing)
    extra = [c for c in df.columns if c not in target.names]
    return widened.select(*target.names, *extra)


def roundtrip(df: DataFrame, encode: Callable[[DataFrame], DataFrame], decode: Callable[[DataFrame], DataFrame]):
    return decode(encode(df))


def commit_epoch(batch_id: int, writes: Iterable[Callable[[int], None]], log) -> None:
    """Run several idempotent writes under one epoch, then mark the epoch complete.

    Every write replaces its own epoch data, so a retried epoch ends in the same
    state. Readers ask the tables for rows up to ``log.last()``.
    """
    for write in writes:
        write(batch_id)
    log.mark(batch_id)
