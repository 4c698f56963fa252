"""Straightforward re-computations used as references in the tests."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import types as T


def trailing(rows, key, ts, horizon: timedelta, pick=lambda r: True):
    """For each row, the rows of its key within [ts - horizon, ts] that ``pick`` accepts."""
    return [
        [x for x in rows if x[key] == r[key] and r[ts] - horizon <= x[ts] <= r[ts] and pick(x)] for r in rows
    ]


def previous(rows, key, ts, tie):
    out = []
    for r in rows:
        before = [x for x in rows if x[key] == r[key] and (x[ts], x[tie]) < (r[ts], r[tie])]
        out.append(max(before, key=lambda x: (x[ts], x[tie])) if before else None)
    return out


def closure(seed, files):
    children = {}
    for fid, parent in files:
        if parent is not None:
            children.setdefault(parent, set()).add(fid)
    known, todo = set(seed), list(seed)
    while todo:
        g, f = todo.pop()
        for c in children.get(f, ()):
            if (g, c) not in known:
                known.add((g, c))
                todo.append((g, c))
    return known


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def txn_row(event_id, cc, when, category="grocery", amt="1.00", lat=0.0, long=0.0):
    when = at(when) if isinstance(when, str) else when
    return (event_id, cc, when, category, None if amt is None else Decimal(amt), lat, long)


TXN_DDL = (
    "event_id bigint, cc_num bigint, ts timestamp_ntz, category string, amt decimal(38,2), "
    "shipping_lat double, shipping_long double"
)
CUST_DDL = "cc_num bigint, name string, lat double, long double"


_KINDS = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp_ntz": T.TimestampNTZType(), "decimal(38,2)": T.DecimalType(38, 2),
}


def schema(ddl: str) -> T.StructType:
    """A schema from DDL text without a running session."""
    fields = [part.strip().split(" ", 1) for part in ddl.replace("(38,2)", "(38;2)").split(",")]
    return T.StructType([T.StructField(n, _KINDS[k.replace(";", ",")]) for n, k in fields])
