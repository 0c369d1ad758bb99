"""Registered streaming queries: staged wire files -> stream -> sink -> table.

Each query stages the wire messages derived from ``orders`` as text files in
the shared folder, drains them with an ``availableNow`` trigger (several
micro-batches: ``maxBytesPerTrigger``), and returns the sink's contents. The
oracle is the batch answer: streaming must equal batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from ..sinks import files
from ..sinks.warehouse import ParquetTarget
from ..streaming.job import clean_stream, start_lake, start_warehouse, watermark_dedup
from . import common

MICRO_BATCHES = 6                 # that a staged backlog is drained in
LEAST_BYTES = 1 << 20             # of a micro-batch
DRAIN = {"availableNow": True}
# the crawl history spans under ten years: a URL re-sent within it is a copy
WATERMARK_DELAY = "3650 days"
# serving table partitioned by key bucket: conflict checks prune to the batch's
# buckets (size the count to the table: ~1 GB of stored rows per bucket)
KEY_BUCKETS = 16


def _stage(spark: SparkSession, sf_dir: str, name: str) -> str:
    base = scratch_path(spark, name)
    common.wire(spark, sf_dir).select("value").write.text(f"{base}/in")
    return base


def _stream(spark: SparkSession, base: str) -> DataFrame:
    """The staged backlog in several micro-batches, whatever its size (a deployment bounds a batch by what its cores do in a trigger)."""
    bound = max(LEAST_BYTES, -(-files.total_bytes(spark, f"{base}/in") // MICRO_BATCHES))
    return clean_stream(spark, source="files", path=f"{base}/in", max_bytes=bound)


def stream_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stage(spark, sf_dir, "stream-to-lake")
    q = start_lake(_stream(spark, base), f"{base}/lake", f"{base}/ckpt", trigger=DRAIN)
    q.awaitTermination()
    lake = spark.read.parquet(f"{base}/lake").drop("processed_at")
    return lake.select(*[common.image_text().alias(c) if c == "image_urls"
                         else (F.col(c).cast("double").alias(c) if c == "square_footage" else F.col(c))
                         for c in lake.columns])


def stream_batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + D1 across micro-batches: each URL lands in the serving table once."""
    base = _stage(spark, sf_dir, "stream-dw")
    target = ParquetTarget(f"{base}/dw", key_buckets=KEY_BUCKETS)
    q = start_warehouse(_stream(spark, base), target, f"{base}/ckpt", trigger=DRAIN)
    q.awaitTermination()
    return (target.read(spark).groupBy("listing_url", "source")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def stream_watermark_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-wide dedup by URL with bounded, watermarked state."""
    base = _stage(spark, sf_dir, "stream-wm")
    deduped = watermark_dedup(_stream(spark, base), WATERMARK_DELAY).drop("event_time")
    q = start_lake(deduped, f"{base}/lake", f"{base}/ckpt", trigger=DRAIN)
    q.awaitTermination()
    return (spark.read.parquet(f"{base}/lake").groupBy("listing_url", "source")
            .agg(F.count(F.lit(1)).alias("n_rows")))
