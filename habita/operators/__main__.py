"""Command line: extract listings of one site from stored pages and publish
them as wire messages (what a crawl run published to the topic).

    python -m habita.operators --site intendance --list-pages lists.parquet \\
        --detail-pages details.parquet --out wire/ [--kafka-bootstrap h:9092 --topic t]

Pages are tables ``(page_id, url, html)``. ``--site api`` reads stored API
responses ``(doc_id, response)`` from ``--responses`` instead.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from ..session import get_spark
from ..sources.wire import write_wire_files, write_wire_kafka
from ..sources.api import flatten_api
from .sites import RULES, extract_site


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="habita.operators")
    p.add_argument("--site", choices=sorted(RULES) + ["api"], required=True)
    p.add_argument("--list-pages")
    p.add_argument("--detail-pages")
    p.add_argument("--responses", help="API responses table (doc_id, response) for --site api")
    p.add_argument("--out", help="directory for newline-delimited JSON messages")
    p.add_argument("--kafka-bootstrap"), p.add_argument("--topic")
    p.add_argument("--scraped-at", help="crawl instant (ISO text); default: now")
    a = p.parse_args(argv)
    spark = get_spark(app_name=f"habita-extract-{a.site}")
    ts = F.lit(a.scraped_at) if a.scraped_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if a.site == "api":
        items = flatten_api(spark.read.parquet(a.responses)).withColumn(
            "bedrooms", F.col("bedrooms").cast("string")).withColumn("scraped_at", ts)
    else:
        items = extract_site(a.site, spark.read.parquet(a.list_pages), spark.read.parquet(a.detail_pages), ts)
    if a.kafka_bootstrap:
        write_wire_kafka(items, a.kafka_bootstrap, a.topic)
    if a.out:
        write_wire_files(items, a.out)


if __name__ == "__main__":
    main()
