"""Follow a Kafka change log into state tables.

spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 tideline/job.py \\
    --servers HOST:PORT --root SHARED_FOLDER [--interval "5 seconds"] \\
    [--rules default|python|scala] [--fold-every 200] [--buckets 256]
"""

from __future__ import annotations

import argparse

from tideline.rules import Rules
from tideline.schema import CUSTOMERS, ORDERS
from tideline.session import build_session
from tideline.sources.log import stream_kafka
from tideline.streaming import ChangeSink, StateTables, start
from tideline.streaming.progress import ProgressLog

RULES = {"default": Rules, "python": Rules.python_job, "scala": Rules.scala_job}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True)
    parser.add_argument("--root", required=True, help="folder every executor can reach")
    parser.add_argument("--interval", default="5 seconds")
    parser.add_argument("--starting", default="earliest", choices=["earliest", "latest"])
    parser.add_argument("--rules", default="default", choices=sorted(RULES))
    parser.add_argument("--max-per-batch", type=int, default=50_000_000, help="log records per micro-batch")
    parser.add_argument("--shuffle-partitions", default="200", help="enough for 128-256 MB of state each")
    parser.add_argument("--fold-every", type=int, default=200, help="batches between folds; 0 never folds")
    parser.add_argument("--buckets", type=int, default=256, help="of the stored state; a fold rewrites those that changed")
    parser.add_argument("--wrapped", action="store_true", help="envelopes sit under payload")
    args = parser.parse_args(arguments)

    spark = build_session("change-log", **{"spark.sql.shuffle.partitions": args.shuffle_partitions})
    log = stream_kafka(
        spark, args.servers, [CUSTOMERS, ORDERS], starting=args.starting, max_per_batch=args.max_per_batch
    )
    sink = ChangeSink(
        StateTables.at(spark, f"{args.root}/tables", args.buckets), rules=RULES[args.rules](), fold_every=args.fold_every or None
    )
    progress = ProgressLog(spark, f"{args.root}/progress")
    try:
        start(log, sink, f"{args.root}/checkpoint", args.interval, args.wrapped).awaitTermination()
    finally:
        progress.close()


if __name__ == "__main__":
    main()
