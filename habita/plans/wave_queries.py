"""Registered queries on crawl waves: state that leaves, late rows, restarts.

The wire messages of ``orders`` arrive in one wave per year (or two) of crawl. Waves are
published one after the other and the streaming job drains each in a run of its
own from the same checkpoint, as a scheduled job does; so a run starts with the
watermark of the last one, and what left the state in between is gone. A wave
is written by many tasks, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.clean import clean_listings
from ..session import scratch_path
from ..sinks import files
from ..sources.wire import parse_wire
from ..streaming.job import clean_stream, start_lake, watermark_dedup
from ..streaming.prices import price_changes
from ..streaming.windows import arrivals_per_window, crawl_sessions, open_windows, rocksdb_state, window_accounts
from . import common

DRAIN = {"availableNow": True}
DELAY = "100 days"              # how long a wave may lag behind the newest crawl instant
WINDOW = "30 days"
SESSION_GAP = "200 days"
PRICE_TTL_DAYS = 400
LATE_WAVES = 2                  # sellers that deliver late do so by so many waves
WAVES_AT_ONCE = 32              # files a task writes side by side; more waves than that are sorted
# what the windows, sessions and changes are made of; the rest of a message is not parsed
WAVE_FIELDS = [*common.FILTER_FIELDS, "source"]
IS_LATE = "o_custkey % 11 = 0"


def _waves(spark: SparkSession, sf_dir: str, name: str, late: bool, years: int):
    """Messages by wave, written once; yields the input path after each wave is published."""
    base = scratch_path(spark, name)
    year = F.year("o_orderdate") + (F.when(F.expr(IS_LATE), LATE_WAVES).otherwise(0) if late else 0)
    wave = year - year % years
    by_wave = common.wire(spark, sf_dir, wave.alias("wave"))
    with files.unsorted_writes(spark, WAVES_AT_ONCE):
        by_wave.write.partitionBy("wave").text(f"{base}/staged")
    waves = [n for n in files.names_in(spark, f"{base}/staged") if n.startswith("wave=")]      # one per year or two
    for w in waves:
        files.move(spark, f"{base}/staged/{w}", f"{base}/in/{w.replace('=', '-')}")
        yield base
    if not waves:
        raise ValueError("no messages")


def _drain_waves(spark: SparkSession, sf_dir: str, name: str, table, late: bool, years: int = 1, fields=WAVE_FIELDS) -> str:
    """Run the streaming query ``table(clean)`` once per wave into a lake; the base folder (in, lake, ckpt)."""
    base = None
    for base in _waves(spark, sf_dir, name, late, years):
        clean = clean_stream(spark, source="files", path=f"{base}/in/*", fields=fields)
        with rocksdb_state(spark):
            start_lake(table(clean), f"{base}/lake", f"{base}/ckpt", trigger=DRAIN).awaitTermination()
    return base


def _text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def stream_window_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals per source and 30 days; closed windows from the sink, open ones from the state, late rows counted."""
    base = _drain_waves(spark, sf_dir, "waves-window", lambda clean: arrivals_per_window(clean, DELAY, WINDOW), late=True)
    read = clean_listings(parse_wire(spark.read.text(f"{base}/in/*"), fields=WAVE_FIELDS))
    accounts = window_accounts(spark.read.parquet(f"{base}/lake"), open_windows(spark, f"{base}/ckpt"),
                               read.groupBy("source").agg(F.count(F.lit(1)).alias("n_listings")))
    return accounts.select("source", _text("start"), "n_listings", "status")


def stream_crawl_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spells of repeated sightings per URL that have closed."""
    base = _drain_waves(spark, sf_dir, "waves-session", lambda clean: crawl_sessions(clean, DELAY, SESSION_GAP), late=False, years=2)
    return spark.read.parquet(f"{base}/lake").select("listing_url", _text("first_seen"), _text("closed_at"), "n_seen")


def stream_dedup_evicting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 with a delay far shorter than the data: a URL counts again after its state has left, late rows never do."""
    crawl = F.date_trunc("year", F.try_to_timestamp("scraped_at"))
    base = _drain_waves(spark, sf_dir, "waves-dedup", lambda clean: watermark_dedup(clean, DELAY, event=crawl), late=True, fields=None)
    return spark.read.parquet(f"{base}/lake").groupBy("listing_url").agg(F.count(F.lit(1)).alias("n_counted"), F.min(F.year("event_time")).alias("first_year"))


def price_changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 across batches: listings and price changes per URL, one run per wave from one checkpoint."""
    base = _drain_waves(spark, sf_dir, "waves-price", lambda clean: price_changes(clean, DELAY, PRICE_TTL_DAYS), late=False, years=2)
    return spark.read.parquet(f"{base}/lake").select("listing_url", _text("seen_at"), "old_price", "new_price")


WAVE_QUERIES = {"stream_window_arrivals": stream_window_arrivals, "stream_crawl_sessions": stream_crawl_sessions,
                "stream_dedup_evicting": stream_dedup_evicting, "price_changes": price_changes_stream}
