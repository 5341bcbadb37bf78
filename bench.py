"""Headline timings: one JSON line on stdout.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores; BENCH_QUERIES a comma list.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline import build_session  # noqa: E402
from tideline.plans import all_queries, logs  # noqa: E402
from tideline.plans.streams import Arriving  # noqa: E402
from tideline.sources.log import read_files  # noqa: E402
from tideline.streaming import rebuild  # noqa: E402

HEADLINES = [
    "parse_bare",
    "flatten_change",
    "decode_decimal",
    "mask_email",
    "reject_ledger",
    "doc_state_orders",
    "doc_state_customers",
    "latest_per_key",
    "merge_latest",
    "cascade_delete",
    "fk_orphans",
    "reconcile_counts",
    "reconcile_rows",
    "reconcile_ranges",
    "counters_all",
    "net_counters",
    "top_customers",
    "rate_30s",
    "rate_extrapolated",
    "resample",
    "p95_index",
    "latency_percentiles",
    "bench_levels",
    "stream_apply",
    "counters_exactly_once",
]


def run(spark, query, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def stream_lines(spark, sf_dir: str) -> dict[str, float]:
    """A warm micro-batch by the engine's own clock, a fold of what it left, and a rebuild of the same tables."""
    log = Arriving(spark, sf_dir)
    log.arrive("c")
    log.apply()
    log.arrive("u")
    query = log.apply()
    batch_ms = max(p["durationMs"]["triggerExecution"] for p in query.recentProgress)
    began = time.perf_counter()
    log.tables.fold()
    folded = time.perf_counter()
    rebuild(read_files(spark, log.path), log.tables)
    return {"warm_micro_batch": batch_ms / 1000, "fold": folded - began, "rebuild": time.perf_counter() - folded}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()
    # The derived log is written once; its time is a line of its own.
    began = time.perf_counter()
    logs.every_topic_log(spark, sf_dir)
    times = {"write_log": round(time.perf_counter() - began, 3)}
    run(spark, queries["doc_state_orders"], sf_dir)  # starts the JVM's compiled paths
    times |= {name: round(run(spark, queries[name], sf_dir), 3) for name in names}

    times |= {name: round(seconds, 3) for name, seconds in stream_lines(spark, sf_dir).items()}

    events = logs.both_log(spark, sf_dir).count()
    state = [times[n] for n in ("doc_state_orders", "counters_all") if n in times]
    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "log_events": events,
    }
    if len(state) == 2:
        line["events_per_sec_parse_state_counters"] = round(events / sum(state))
    print(json.dumps(line))


if __name__ == "__main__":
    main()
