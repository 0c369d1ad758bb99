"""Event-time windows with state that leaves.

Windows close when the watermark passes their end; closed state is handed to
the sink and dropped, rows that arrive for a closed window are late. State lives
in RocksDB on the executors' disks, so what is open is bounded by the delay and
not by memory.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Public class name and settings of the state store.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (a query takes the session's settings when it starts)."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def with_event_time(clean: DataFrame, col: str | Column = "scraped_at") -> DataFrame:
    """Event time: the naive ISO crawl instant, or any timestamp column."""
    return clean.withColumn("event_time", F.try_to_timestamp(F.col(col)) if isinstance(col, str) else col)


def arrivals_per_window(clean: DataFrame, delay: str, width: str, keys=("source",), event: str | Column = "scraped_at") -> DataFrame:
    """Listings that arrived per tumbling window and key: ``start, <keys>, n_listings``, once a window is closed."""
    counted = (with_event_time(clean, event).withWatermark("event_time", delay)
               .groupBy(F.window("event_time", width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n_listings")))
    return counted.select(F.col("w.start").alias("start"), *keys, "n_listings")


def crawl_sessions(clean: DataFrame, delay: str, gap: str, key: str = "listing_url", event: str | Column = "scraped_at") -> DataFrame:
    """Spells in which a key was seen again and again, less than ``gap`` apart: ``key, first_seen, closed_at, n_seen``."""
    spells = (with_event_time(clean.where(F.col(key).isNotNull()), event).withWatermark("event_time", delay)
              .groupBy(F.session_window("event_time", gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n_seen")))
    return spells.select(key, F.col("w.start").alias("first_seen"), F.col("w.end").alias("closed_at"), "n_seen")


def open_windows(spark: SparkSession, checkpoint: str, keys=("source",)) -> DataFrame:
    """What the state of a stopped ``arrivals_per_window`` query holds: windows that are not closed yet."""
    state = spark.read.format("statestore").load(checkpoint)
    window = state.schema["key"].dataType.fieldNames()[0]
    return state.select(F.col(f"key.`{window}`.start").alias("start"), *[F.col(f"key.`{k}`").alias(k) for k in keys],
                        F.col("value.count").alias("n_listings"))


def window_accounts(closed: DataFrame, still_open: DataFrame, read: DataFrame, keys=("source",)) -> DataFrame:
    """Every row that was read, in one table: ``status`` closed, open or late (rows that came after their window had closed).

    ``read``: ``<keys>, n_listings`` of all rows the query took in. Late rows leave no
    trace in the windows, so their number is what neither closed nor open windows account for.
    """
    columns = [*keys, "start", "n_listings"]
    kept = closed.select(*columns, F.lit("closed").alias("status")).unionByName(still_open.select(*columns, F.lit("open").alias("status")))
    signed = read.select(*keys, "n_listings").unionByName(kept.select(*keys, (-F.col("n_listings")).alias("n_listings")))
    late = signed.groupBy(*keys).agg(F.sum("n_listings").alias("n_listings")).where("n_listings <> 0")
    return kept.unionByName(late.select(*keys, F.lit(None).cast("timestamp").alias("start"), "n_listings", F.lit("late").alias("status")))
