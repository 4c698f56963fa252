"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Batch queries are timed end to end (plan, run, write to the no-op sink), best of
``BENCH_RUNS``. ``card_alerts_step`` is one incremental step: insert a batch of
1,000 rows into a preloaded history, refresh the alerts of the touched cards and
count all alerts, as in the published per-step latency; the second figure repeats
it on a history ten times as long.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rillstream import fixtures as fx  # noqa: E402
from rillstream.catalog import all_entries  # noqa: E402
from rillstream.catalog.cards import ALERTS  # noqa: E402
from rillstream.catalog.changes import TXN  # noqa: E402
from rillstream.session import local_session, scratch  # noqa: E402
from rillstream.streaming.cards import CardAlertMaintainer  # noqa: E402

HEADLINE = [
    "fraud_alert_details", "flagged_card_exact", "flagged_card_two_bucket", "flagged_card_one_bucket",
    "feature_enrich_1day", "feature_view", "combined_features", "windowed_features", "engagement_rolling",
    "engagement_rolling_user", "top_k", "user_can_read", "unauthorized_access", "access_alerts",
    "calibrate_thresholds", "detector_score", "cdc_apply", "pk_upsert_latest", "view_diff", "html_to_text",
]


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def run_query(spark, entry, sf_dir) -> float:
    return timed(lambda: entry.run(spark, sf_dir).write.format("noop").mode("overwrite").save())


def history_rows(spark, sf_dir, copies: int):
    """The transactions, repeated back in time: copy k lies 31 * k days earlier, so no
    copy shares a 30-day window with itself and event ids stay unique."""
    txn = fx.txn(spark, sf_dir)
    n = txn.count()
    back = F.make_dt_interval(days=(F.col("k") * 31).cast("int"))
    return txn.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumns({
        "ts": F.col("ts") - back, "event_id": F.col("event_id") + F.col("k") * F.lit(n)}).drop("k")


def step_latency(spark, sf_dir, copies: int, steps: int = 3, size: int = 1000) -> float:
    """Average seconds per step: insert, refresh and count."""
    rows = history_rows(spark, sf_dir, copies)
    n = fx.table(spark, sf_dir, "events").count()
    first = n - steps * size
    newest = F.col("event_id") < n
    m = CardAlertMaintainer(spark, scratch(spark, "bench"), TXN, fx.cust(spark, sf_dir), ALERTS, buckets=16)
    m(rows.filter(~newest | (F.col("event_id") < first)), 0)
    spent = 0.0
    for step in range(steps):
        lo = first + step * size
        batch = rows.filter(F.col("event_id").between(lo, lo + size - 1))
        spent += timed(lambda: (m(batch, step + 1), m.result.current().count()))
    return spent / steps


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = set(sys.argv[1:])
    spark = local_session("bench", cpus, shuffle=int(cpus) if cpus.isdigit() else 8)
    entries = all_entries()
    queries: dict[str, float] = {}
    run_query(spark, entries["group_count"], sf_dir)  # start the executors
    for name in HEADLINE:
        if only and name not in only:
            continue
        queries[name] = round(min(run_query(spark, entries[name], sf_dir) for _ in range(runs)), 3)
        print(name, queries[name], file=sys.stderr, flush=True)
    for label, copies in (("card_alerts_step", 1), ("card_alerts_step_10x_history", 10)):
        if only and label not in only:
            continue
        queries[label] = round(step_latency(spark, sf_dir, copies), 3)
        print(label, queries[label], file=sys.stderr, flush=True)
    rows = fx.table(spark, sf_dir, "events").count()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "events": rows,
        "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
