"""Registered queries that go through a sink and read back what it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import clean_listings
from ..schemas import RAW_FIELDS
from ..session import scratch_path
from ..sinks.feeds import write_csv_feed
from ..sinks.lake import append_lake, compact, refresh_curated
from ..sinks.warehouse import ParquetTarget, load_batch, register_view
from ..sources.wire import parse_wire, to_wire, write_wire_files
from ..streaming.job import start_fanout, start_warehouse
from . import common
from .stream_queries import DRAIN, KEY_BUCKETS, _stage, _stream

INSTANT = "2024-05-01 10:00:00"     # injected processing instant


def _shown(df: DataFrame, cast: bool = True) -> DataFrame:
    return df.select(*[common.image_text().alias(c) if c == "image_urls"
                       else (F.col(c).cast("double").alias(c) if cast and c == "square_footage" else F.col(c)) for c in df.columns])


def curated_zone_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lake -> latest row per URL -> curated zone, read back."""
    base = scratch_path(spark, "curated")
    append_lake(common.clean(spark, sf_dir, keep=()), f"{base}/lake")
    return refresh_curated(spark, f"{base}/lake", f"{base}/curated").select(
        "listing_url", "listing_id", "scraped_at", "price", "title", "offer_type")


def lake_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake rewritten into files of a given number of rows, read back."""
    base = scratch_path(spark, "compact")
    append_lake(common.clean(spark, sf_dir, keep=()).drop("processed_at"), f"{base}/lake")
    compact(spark, f"{base}/lake", f"{base}/large", partition_cols=("source",))
    return _shown(spark.read.parquet(f"{base}/large").select(*spark.read.parquet(f"{base}/lake").columns))


def csv_feed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: every message's fields as CSV, read back by a reader of doubled quotes
    (CSV has one form for an empty text and a missing one)."""
    path = scratch_path(spark, "feed")
    write_csv_feed(common.parsed(spark, sf_dir), path)
    back = (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
            .schema(", ".join(f"{c} string" for c in RAW_FIELDS)).csv(path))
    return back.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in RAW_FIELDS])


def wire_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: parsed messages serialised to files, read and parsed again."""
    path = scratch_path(spark, "wire")
    write_wire_files(common.parsed(spark, sf_dir), path)
    return _shown(parse_wire(spark.read.text(path)).select(*RAW_FIELDS), cast=False)


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[ParquetTarget, dict]:
    target = ParquetTarget(scratch_path(spark, "dw"), key_buckets=KEY_BUCKETS)
    return target, load_batch(common.clean(spark, sf_dir, keep=()), target)


def serving_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL over the serving table's view."""
    target, _ = _loaded(spark, sf_dir)
    register_view(spark, target, "proprietes")
    return spark.sql("SELECT source, count(*) AS n_rows, min(scraped_at) AS first_seen, max(price) AS max_price FROM proprietes GROUP BY source")


def fanout_both_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query feeds the lake and the serving table."""
    base = _stage(spark, sf_dir, "stream-fanout")
    target = ParquetTarget(f"{base}/dw", key_buckets=KEY_BUCKETS)
    start_fanout(_stream(spark, base), f"{base}/lake", target, f"{base}/ckpt", trigger=DRAIN).awaitTermination()
    count = lambda df, sink: df.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("sink", F.lit(sink))     # noqa: E731
    return count(spark.read.parquet(f"{base}/lake"), "lake").unionByName(count(target.read(spark), "store"))


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loads of all micro-batches report, added up."""
    base = _stage(spark, sf_dir, "stream-metrics")
    seen: list[dict] = []
    start_warehouse(_stream(spark, base), ParquetTarget(f"{base}/dw", key_buckets=KEY_BUCKETS), f"{base}/ckpt",
                    trigger=DRAIN, metrics_sink=seen.append).awaitTermination()
    rows = [(m["read"], m["no_key"], m["written"]) for m in seen] or [(0, 0, 0)]        # one row per micro-batch
    return spark.createDataFrame(rows, "n_read long, n_no_key long, n_written long").agg(
        *[F.sum(c).alias(c) for c in ("n_read", "n_no_key", "n_written")])


class _RefusesOnce(ParquetTarget):
    """A store that is down while the batch of one crawl is loaded."""
    down = False

    def append(self, df: DataFrame) -> None:
        if self.down:
            raise ConnectionError("store down")
        super().append(df)


def load_skips_failing_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch, an empty one, one that fails and is dropped (the original policy), one that follows; what each reports and the store holds."""
    target = _RefusesOnce(scratch_path(spark, "dw"), key_buckets=KEY_BUCKETS)
    rows = common.clean(spark, sf_dir, keep=())
    said = []
    for k, crawl in enumerate(("scraped_at < '1994-07-01'", "false", "scraped_at >= '1996-07-01'", "scraped_at >= '1994-07-01' and scraped_at < '1996-07-01'")):
        target.down = k == 2
        m = load_batch(rows.where(crawl), target, batch_id=k, on_error="skip")
        said.append((k, m["read"], 0 if m["error"] else m["written"], m["error"] is not None))
    said.append((-1, target.read(spark).count(), 0, False))
    return spark.createDataFrame(said, "batch_id int, n_read long, n_written long, failed boolean")


def processed_at_injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processing instant as the caller gives it."""
    c = clean_listings(common.parsed(spark, sf_dir, fields=["listing_id", "price", "city"]), processed_at=F.lit(INSTANT).cast("timestamp"), keep=["msg_id"])
    return c.select("msg_id", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"))


SINK_QUERIES = {f.__name__: f for f in (curated_zone_refresh, lake_compact, csv_feed_roundtrip, wire_roundtrip, serving_view_sql,
                                        fanout_both_sinks, load_metrics, load_skips_failing_batch, processed_at_injected)}
