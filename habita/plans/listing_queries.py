"""Registered queries over wire messages derived from ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.casts import legacy_float, legacy_int
from ..functions.normalise import stream_offer_type, stream_property_type
from ..operators.clean import bedroom_outliers, digits_only_cleanup, reject_counts
from ..operators.dedup import insert_if_absent_marked, latest_per_url
from ..operators.marts import (price_quartiles, count_listings, distinct_sources, location_marts,
                               market_summary, price_per_m2, price_quantiles)
from ..session import read_table
from ..sources.wire import is_json_object, parse_wire
from . import common


MART_COLS = ["source", "property_type", "offer_type", "price", "bedrooms", "square_footage"]
LOCATION_COLS = ["city", "neighborhood", "property_type", "offer_type", "price", "square_footage"]


def flagship_market_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """wire -> parse -> compat clean -> latest per URL -> market summary."""
    return market_summary(common.latest(spark, sf_dir, MART_COLS))


def wire_parse_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = common.parsed(spark, sf_dir)
    return p.select(*[common.image_text().alias("image_urls") if c == "image_urls" else F.col(c)
                      for c in p.columns])


def events_props_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = common.spread(read_table(spark, sf_dir, "events").select("event_id", "event_type", "props"),
                       spark)
    return ev.select("event_id", "event_type",
                     F.inline(F.array(F.from_json("props", "k bigint"))))


def property_type_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = common.parsed(spark, sf_dir, fields=["listing_id", "property_type"]).where(F.col("listing_id").isNotNull())
    return (p.select(F.col("property_type").alias("raw_property_type"),
                     stream_property_type("property_type").alias("property_type"))
             .groupBy("raw_property_type", "property_type").agg(F.count(F.lit(1)).alias("n_rows")))


def offer_type_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = common.parsed(spark, sf_dir, fields=["listing_id", "offer_type"]).where(F.col("listing_id").isNotNull())
    return (p.select(F.col("offer_type").alias("raw_offer_type"),
                     stream_offer_type("offer_type").alias("offer_type"),
                     stream_offer_type("offer_type", lenient=True).alias("offer_type_lenient"))
             .groupBy("raw_offer_type", "offer_type", "offer_type_lenient")
             .agg(F.count(F.lit(1)).alias("n_rows")))


def typed_casts_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = common.parsed(spark, sf_dir, fields=["bedrooms", "square_footage", "wc_interne", "price"])
    return p.select("msg_id", "bedrooms", "square_footage", "wc_interne",
                    legacy_int("bedrooms").alias("bedrooms_int"),
                    legacy_float("square_footage").cast("double").alias("surface_float"),
                    legacy_int("wc_interne").alias("wc_int"),
                    F.col("price").cast("long").alias("price_long"))


def price_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = common.clean(spark, sf_dir, mode="lenient", fields=["offer_type", "title"])
    return c.select("msg_id", "price", "offer_type", "title")


def clean_listings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = common.clean(spark, sf_dir).drop("processed_at")
    return c.select(*[common.image_text().alias("image_urls") if x == "image_urls"
                      else (F.col(x).cast("double").alias(x) if x == "square_footage" else F.col(x))
                      for x in c.columns])


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse_wire(common.wire(spark, sf_dir), keep=["value"], fields=["listing_id", "price", "city", "source"])
    # a parsed listing_id proves the text was an object: only the others are
    # re-checked, so most messages are parsed once
    valid = F.when(F.col("listing_id").isNotNull(), F.lit(True)).otherwise(is_json_object(F.col("value")))
    return reject_counts(p.withColumn("valid_json", valid))


def digits_only_cleanup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 per distinct raw combination (with its message count)."""
    p = common.parsed(spark, sf_dir).where(F.col("listing_id").isNotNull())
    out = digits_only_cleanup(p).withColumn("surface_digits", F.col("surface_digits").cast("double"))
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n_rows"))


def bedroom_outliers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = common.clean(spark, sf_dir, fields=["bedrooms"])
    return c.select("msg_id", F.col("bedrooms").alias("bedrooms_raw"),
                    bedroom_outliers(F.col("bedrooms")).alias("bedrooms"))


def dedup_latest_per_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.latest(spark, sf_dir, ["listing_id", "price", "title", "offer_type"]).select(
        "listing_url", "listing_id", "scraped_at", "price", "title", "offer_type")


def count_listings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_listings(common.latest(spark, sf_dir, []))


def distinct_sources_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_sources(common.latest(spark, sf_dir, ["source"]))


def image_urls_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = common.clean(spark, sf_dir, fields=["image_urls"])
    return c.select("msg_id", common.image_text().alias("image_urls_text"),
                    F.coalesce(F.size("image_urls"), F.lit(-1)).alias("n_images"))


def curated_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return location_marts(common.latest(spark, sf_dir, LOCATION_COLS))


def price_per_m2_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_per_m2(common.latest(spark, sf_dir, LOCATION_COLS))


def price_quantiles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate quartiles: no SQL oracle (different sketch); checked against
    exact quantiles within the sketch's error bound in the tests."""
    return price_quantiles(common.latest(spark, sf_dir, LOCATION_COLS))


def price_quartiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_quartiles(common.latest(spark, sf_dir, LOCATION_COLS))


def upsert_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store holds the first crawl (scraped before the cutoff); the
    second crawl inserts only URLs the store does not have yet."""
    c = common.clean(spark, sf_dir, keep=(), fields=["source"]).select("listing_url", "scraped_at", "listing_id", "price", "source")
    ins = insert_if_absent_marked(c, F.col("scraped_at") < "1998-01-01")
    return ins.select("listing_url", "listing_id", "scraped_at", "price", "source")
