"""Shared building blocks of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.clean import clean_listings
from ..operators.dedup import latest_per_url
from ..session import read_table
from ..sources.adapters import orders_to_wire
from ..sources.wire import lenient_schema, parse_wire


# the key each driver table is spread on (hash partitioning is deterministic
# under task retries without the local sort a round-robin repartition needs)
SPREAD_KEYS = {"o_orderkey", "page_id", "c_custkey", "p_partkey", "event_id"}


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Spread the rows when a scan yields fewer partitions than cores.

    The test tables are single row-group files (one scan task); regex and
    JSON work would then run on one core. At cluster scale the scan already
    has thousands of splits and this is a no-op, so no shuffle is added.
    """
    try:
        target = spark.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 -- sessions without RDD access: leave the plan as is
        return df
    if current < target:
        keys = [c for c in df.columns if c in SPREAD_KEYS]
        return df.repartition(target, *keys[:1]) if keys else df.repartition(target)
    return df


def wire(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """``msg_id, value`` (with ``extra`` columns of ``orders``: those and ``value``)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return orders_to_wire(spread(orders, spark), *extra)


def parsed(spark: SparkSession, sf_dir: str, lenient: bool = False, fields=None) -> DataFrame:
    w = wire(spark, sf_dir)
    if lenient:
        return parse_wire(w, keep=["msg_id"], schema=lenient_schema(), fields=fields)
    return parse_wire(w, keep=["msg_id"], fields=fields)


# fields every clean needs: the F1-F4 filters and the dedup key/order
FILTER_FIELDS = ["listing_id", "price", "city", "listing_url", "scraped_at"]


def clean(spark: SparkSession, sf_dir: str, mode: str = "compat", keep=("msg_id",),
          fields=None) -> DataFrame:
    if fields is not None:
        fields = list(dict.fromkeys([*FILTER_FIELDS, *fields]))
    return clean_listings(parsed(spark, sf_dir, lenient=(mode == "lenient"), fields=fields),
                          mode=mode, keep=list(keep))


def latest(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    """Cleaned listings, latest message per URL (processed_at dropped: it is
    the per-batch instant and not part of the listing).

    ``cols`` prunes before the dedup: only those columns (plus the key and the
    order column) cross the shuffle, and Catalyst narrows the JSON parse to
    the fields still needed. Ties on scraped_at are broken by the kept columns.
    """
    c = clean(spark, sf_dir, keep=(), fields=cols).drop("processed_at")
    if cols is not None:
        c = c.select("listing_url", "scraped_at", *[x for x in cols if x not in ("listing_url", "scraped_at")])
    return latest_per_url(c)


def image_text(col: str = "image_urls"):
    return F.col(col).cast("string")
