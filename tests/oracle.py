"""Compare registered queries with their oracle text, value by value and strictly typed."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
DATA = "/root/testdata"


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if v != v else float(f"{v:.10g}") + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(
        tuple((type(c := _cell(r[i])).__name__, c) for i in order) for r in rows
    )


SCALAR = {"bigint", "int", "double", "string", "boolean", "timestamp_ntz"}


def compare(spark, name, entry, sf_dir, con=None) -> list[str]:
    con = con or connect(sf_dir)
    df = entry.run(spark, sf_dir)
    problems = [f"{c}: {t}" for c, t in df.dtypes if t not in SCALAR]
    got = _bag(df.columns, df.collect())
    cur = con.execute(entry.sql)
    cols = [d[0] for d in cur.description]
    want = _bag(cols, cur.fetchall())
    wide = [f"oracle {d[0]}: {d[1]}" for d in cur.description
            if str(d[1]).upper().split("(")[0] in {"HUGEINT", "DECIMAL", "DATE"}]
    problems += wide
    if sorted(cols) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(cols)}")
    elif got != want:
        problems.append(
            f"{sum(got.values())} vs {sum(want.values())} rows; only spark {list((got - want))[:2]}; "
            f"only oracle {list((want - got))[:2]}")
    if not want:
        problems.append("oracle result is empty")
    return problems


def main(argv):
    from rillstream.catalog import all_entries
    from rillstream.session import local_session

    sf = argv[0] if argv else "0.01"
    wanted = set(argv[1:])
    spark = local_session(cpus=8)
    con = connect(f"{DATA}/sf{sf}")
    bad = 0
    for name, entry in all_entries().items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            if entry.sql is None:
                problems, n = [], entry.run(spark, f"{DATA}/sf{sf}").count()
                note = f"rows only: {n}"
            else:
                problems, note = compare(spark, name, entry, f"{DATA}/sf{sf}", con), ""
        except Exception as e:  # report and go on
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], ""
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - t0:.1f}s {note}", *problems, sep="\n      "
              if problems else " ", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
