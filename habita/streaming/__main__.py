"""Command line: run the streaming job.

    python -m habita.streaming --source kafka --bootstrap host:9092 --topic listings \\
        --lake s3://bucket/lake/raw --checkpoints s3://bucket/checkpoints \\
        --jdbc-url jdbc:postgresql://dw:5432/db --jdbc-table proprietes \\
        --jdbc-property user=... --jdbc-property password=...

Without ``--jdbc-url`` the serving table is a Parquet directory (``--serving``).
"""

from __future__ import annotations

import argparse

from ..session import get_spark
from ..sinks.warehouse import JdbcTarget, ParquetTarget
from .job import run_until_any_stops, start_listing_job


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="habita.streaming")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--bootstrap"), p.add_argument("--topic"), p.add_argument("--path")
    p.add_argument("--max-per-trigger", type=int, help="offsets or files per micro-batch; 500 in the original job")
    p.add_argument("--max-bytes", type=int, help="bytes per micro-batch of a file source")
    p.add_argument("--lake", required=True)
    p.add_argument("--checkpoints", required=True)
    p.add_argument("--serving", help="Parquet serving table path (when no JDBC target)")
    p.add_argument("--key-buckets", type=int, default=None)
    p.add_argument("--jdbc-url"), p.add_argument("--jdbc-table", default="proprietes")
    p.add_argument("--jdbc-property", action="append", default=[], help="key=value, repeatable")
    p.add_argument("--trigger", default="30 seconds", help="processing-time interval, or 'available-now'")
    p.add_argument("--mode", choices=["compat", "lenient"], default="compat")
    p.add_argument("--separate-queries", action="store_true", help="lake and warehouse as two queries")
    p.add_argument("--echo", action="store_true", help="also print raw payloads (debug)")
    p.add_argument("--on-error", choices=["fail", "skip"], default="fail")
    return p.parse_args(argv)


def main(argv=None) -> list:
    a = parse_args(argv)
    spark = get_spark(app_name="habita-streaming")
    if a.jdbc_url:
        target = JdbcTarget(a.jdbc_url, a.jdbc_table, dict(kv.split("=", 1) for kv in a.jdbc_property))
    else:
        target = ParquetTarget(a.serving or f"{a.lake.rstrip('/')}_serving", key_buckets=a.key_buckets)
    trigger = {"availableNow": True} if a.trigger == "available-now" else {"processingTime": a.trigger}
    queries = start_listing_job(
        spark, lake_path=a.lake, target=target, checkpoint_root=a.checkpoints,
        fanout=not a.separate_queries, echo=a.echo, mode=a.mode, trigger=trigger, on_error=a.on_error,
        source=a.source, bootstrap=a.bootstrap, topic=a.topic, path=a.path,
        max_per_trigger=a.max_per_trigger, max_bytes=a.max_bytes)
    if trigger.get("availableNow"):
        for q in queries:
            q.awaitTermination()
    else:
        run_until_any_stops(spark)
    return queries


if __name__ == "__main__":
    main()
