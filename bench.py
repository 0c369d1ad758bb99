"""Benchmark of the headline queries.

Runs each query to completion (``noop`` sink: every row is computed, nothing is
collected) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; ``$BENCH_WARMUP`` warm-up passes (default 2: the
regex-heavy extraction reaches JVM steady state only after a few runs, as a
long-lived cluster executor would), then the median of ``$BENCH_RUNS`` runs per
query. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_market_summary",   # parse + clean + latest per URL + mart
    "clean_listings",            # parse + clean throughput
    "reject_reasons",            # one-pass reject accounting
    "dedup_latest_per_url",      # A1 on the whole stream
    "upsert_insert_if_absent",   # D1 keyed load plan
    "insert_by_filter",          # D1 against a stored table (Bloom filters, then the keys)
    "page_cards",                # HTML card extraction
    "page_detail_join",          # card ⨝ detail (J1)
    "site_intendance_extract",   # per-site card + detail rules over rendered pages
    "api_flatten",               # nested JSON flatten
    "source_union",              # U1 + clean
    "stream_to_lake",            # micro-batches into the Parquet lake
]


def main() -> None:
    from habita.session import get_spark
    from habita.plans.registry import queries

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    spark = get_spark(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "8g")})
    qs = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for _ in range(warmup):         # warm-up: JIT, file listing, python workers
        for name in HEADLINE:
            run(name)
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)

    n_orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).count()
    n_pages = spark.read.parquet(os.path.join(sf_dir, "pages.parquet")).count()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "throughput": {
            "wire_msgs_per_sec_clean": round(n_orders / times["clean_listings"], 1),
            "wire_msgs_per_sec_flagship": round(n_orders / times["flagship_market_summary"], 1),
            "pages_per_sec_cards": round(n_pages / times["page_cards"], 1),
            "listings_per_sec_site_extract": round(n_orders / times["site_intendance_extract"], 1),
            "wire_msgs_per_sec_stream_to_lake": round(n_orders / times["stream_to_lake"], 1),
        },
        "runs": runs,
        "warmup_passes": warmup,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
