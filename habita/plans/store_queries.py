"""Registered queries on stored tables that are kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.clean import to_serving_rows
from ..operators.hosts import keep_listed
from ..operators.sketches import COUNT_ERROR, RANK_ERROR, batch_sketches, mart_errors, merged_mart
from ..functions.html import url_host
from ..schemas import RAW_FIELDS
from ..session import read_table, scratch_path
from ..sinks import files
from ..sinks.buckets import BucketedStore
from ..sinks.lake import append_lake, cluster, refresh_curated_batches
from ..sinks.observed import load_observed
from ..sources.drift import unknown_fields
from ..sources.wire import parse_wire
from . import common

STORE_BUCKETS = 16
# three crawls by crawl instant, in the order they reach the store: an older one comes last
CRAWLS = ("scraped_at < '1994-07-01'", "scraped_at >= '1996-07-01'", "scraped_at >= '1994-07-01' and scraped_at < '1996-07-01'")
FIRST_CRAWL = "1994-07-01"


def _served(df: DataFrame) -> DataFrame:
    return df.select("listing_url", "listing_id", "scraped_at", "price", "source")


def _by_crawl(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """The rows of the crawls with the ``crawl`` they belong to, parsed and cleaned once and kept by crawl."""
    numbered = F.coalesce(*[F.when(F.expr(c), F.lit(k)) for k, c in enumerate(CRAWLS)]).alias("crawl")
    kept = rows.select("*", numbered).where("crawl is not null")
    with files.unsorted_writes(spark, len(CRAWLS)):
        kept.write.partitionBy("crawl").parquet(path)
    return spark.read.schema(kept.schema).parquet(path)


def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 as a stored operation: three crawls upserted into key buckets, the table read back."""
    store = BucketedStore(scratch_path(spark, "store"), STORE_BUCKETS)
    rows = to_serving_rows(common.clean(spark, sf_dir, keep=()))
    for crawl in CRAWLS:
        store.upsert(rows.where(crawl))
    return _served(store.read(spark))


def insert_by_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second crawl inserted where the buckets' Bloom filters and then the stored keys do not know the URL."""
    store = BucketedStore(scratch_path(spark, "store"), STORE_BUCKETS)
    rows = to_serving_rows(common.clean(spark, sf_dir, keep=()))
    for crawl in (F.col("scraped_at") < FIRST_CRAWL, F.col("scraped_at") >= FIRST_CRAWL):
        store.insert(rows.where(crawl))
    return _served(store.read(spark))


def curated_refresh_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone refreshed after each of three lake batches, only the new batch and changed partitions each time."""
    base = scratch_path(spark, "curated-batches")
    rows = _by_crawl(spark, common.clean(spark, sf_dir, keep=()), f"{base}/crawls")
    for k in range(len(CRAWLS)):
        append_lake(rows.where(F.col("crawl") == k).drop("crawl"), f"{base}/lake/batch_id={k}")
        refresh_curated_batches(spark, f"{base}/lake", f"{base}/curated")
    return spark.read.parquet(f"{base}/curated").select("listing_url", "listing_id", "scraped_at", "price", "title", "offer_type")


def mart_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: quartiles and distinct URLs per city and type from the merged sketches of three batches, judged by exact ranks."""
    path = scratch_path(spark, "sketches")
    rows = common.clean(spark, sf_dir, keep=(), fields=["property_type", "city", "price"])
    for k, crawl in enumerate(CRAWLS):
        batch_sketches(rows.where(crawl)).write.parquet(f"{path}/batch_id={k}")
    judged = mart_errors(merged_mart(spark.read.parquet(path)), rows)
    worst = F.greatest("rank_error_q25", "rank_error_q50", "rank_error_q75")
    return judged.select("city", "property_type", "n_messages", (worst <= RANK_ERROR).alias("quartiles_hold"), (F.col("count_error") <= COUNT_ERROR).alias("count_holds"))


def load_observed_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per reject reason as the load of the lake itself observed them, and what the lake then holds."""
    path = scratch_path(spark, "observed")
    parsed = parse_wire(common.wire(spark, sf_dir), keep=["value"])
    counts = load_observed(parsed, lambda kept: append_lake(kept, path))
    counts["in_the_lake"] = spark.read.parquet(path).count()
    return spark.createDataFrame(list(counts.items()), "reason string, n_rows long")


def lake_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake rewritten along a space-filling curve of city, price and crawl instant, read back."""
    base = scratch_path(spark, "cluster")
    append_lake(common.clean(spark, sf_dir, keep=()).drop("processed_at"), f"{base}/lake")
    cluster(spark, f"{base}/lake", f"{base}/clustered", ("city", "price", "scraped_at"))
    lake = spark.read.parquet(f"{base}/clustered")
    return lake.select(*[common.image_text().alias(c) if c == "image_urls" else (F.col(c).cast("double").alias(c) if c == "square_footage" else F.col(c)) for c in lake.columns])


def wire_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: messages per source that carry a field the wire schema does not know."""
    extra = F.concat(F.when(F.expr("o_orderkey % 7 = 0"), F.concat(F.lit(',"agence":"A'), F.expr("o_custkey % 5"), F.lit('"'))).otherwise(F.lit("")),
                     F.when(F.expr("o_orderkey % 11 = 0"), F.concat(F.lit(',"etage":'), F.expr("o_orderkey % 9"))).otherwise(F.lit("")),
                     F.when(F.expr("o_custkey % 13 = 0"), F.lit(',"geo":{"lat":6.1,"lon":1.2}')).otherwise(F.lit("")))
    # a Generate node: the long expression of a message is written into the plan once
    messages = common.wire(spark, sf_dir, extra.alias("extra")).select(F.inline(F.array(F.struct("value", "extra"))))
    value = F.when(F.col("value").endswith("}"), F.concat(F.expr("substring(value, 1, length(value) - 1)"), "extra", F.lit("}"))).otherwise(F.col("value"))
    return unknown_fields(messages.select(value.alias("value"))).select("source", "field", "n_rows")


def page_host_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages whose host is on a list as long as the customer table."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    above = pages.where("page_id % 3 = 0").select(F.regexp_replace(F.lower(url_host("url")), "^[^.]*[.]", "").alias("domain"))
    shops = read_table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey", F.lit(".Example")).alias("domain"))
    return keep_listed(pages, "url", above.unionByName(shops))


STORE_QUERIES = {f.__name__: f for f in (upsert_stored, insert_by_filter, curated_refresh_batches, mart_from_sketches, load_observed_reasons,
                                         lake_cluster, wire_drift, page_host_list)}


def store_oracles(with_listings, lake_rows: str) -> dict[str, str]:
    cols = "listing_url, listing_id, scraped_at, price, source"
    host = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:@]*)', 1))"
    extra = ("CASE WHEN o_orderkey % 7 = 0 THEN ',\"agence\":\"A' || (o_custkey % 5) || '\"' ELSE '' END || "
             "CASE WHEN o_orderkey % 11 = 0 THEN ',\"etage\":' || (o_orderkey % 9) ELSE '' END || "
             "CASE WHEN o_custkey % 13 = 0 THEN ',\"geo\":{\"lat\":6.1,\"lon\":1.2}' ELSE '' END")
    known = ", ".join(f"'{f}'" for f in RAW_FIELDS)
    return {
        "lake_cluster": lake_rows,
        "wire_drift": with_listings(
            "SELECT source, field, count(*) AS n_rows FROM (SELECT json_extract_string(j, '$.source') AS source, unnest(json_keys(j)) AS field FROM ("
            f"SELECT CASE WHEN json_valid(v) AND json_type(v) = 'OBJECT' THEN CAST(v AS JSON) END AS j FROM (SELECT CASE WHEN value LIKE '%}}' "
            f"THEN left(value, length(value) - 1) || {extra} || '}}' ELSE value END AS v FROM wire JOIN orders ON o_orderkey = msg_id) a) b) c "
            f"WHERE field NOT IN ({known}) GROUP BY source, field"),
        "page_host_list": (
            f"WITH hosts AS (SELECT page_id, url, {host} AS host FROM pages), "
            "listed AS (SELECT regexp_replace(host, '^[^.]*[.]', '') AS d FROM hosts WHERE page_id % 3 = 0 UNION SELECT 'c' || c_custkey || '.example' FROM customer) "
            "SELECT page_id, url FROM hosts WHERE host <> '' AND EXISTS (SELECT 1 FROM listed WHERE host = d OR ends_with(host, '.' || d))"),
        "upsert_stored": with_listings(f"SELECT {cols} FROM latest WHERE listing_url IS NOT NULL"),
        "insert_by_filter": with_listings(
            f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY listing_url ORDER BY scraped_at < '{FIRST_CRAWL}' DESC, scraped_at DESC) AS rn "
            "FROM clean WHERE listing_url IS NOT NULL) x WHERE rn = 1"),
        "curated_refresh_batches": with_listings("SELECT listing_url, listing_id, scraped_at, price, title, offer_type FROM latest"),
        "mart_from_sketches": with_listings(
            "SELECT city, property_type, count(*) AS n_messages, true AS quartiles_hold, true AS count_holds FROM clean GROUP BY city, property_type"),
        "load_observed_reasons": with_listings(
            "SELECT reason, coalesce(n, 0) AS n_rows FROM (VALUES ('unparseable'), ('missing_listing_id'), ('missing_price'), ('price_not_positive'), ('missing_city'), "
            "('kept'), ('in_the_lake')) r(reason) LEFT JOIN (SELECT reason AS found, count(*) AS n FROM (SELECT CASE WHEN NOT valid_json THEN 'unparseable' "
            "WHEN listing_id IS NULL THEN 'missing_listing_id' WHEN price IS NULL THEN 'missing_price' WHEN price <= 0 THEN 'price_not_positive' "
            "WHEN city IS NULL THEN 'missing_city' ELSE 'kept' END AS reason FROM parsed UNION ALL SELECT 'in_the_lake' FROM clean) x GROUP BY reason) y ON reason = found"),
    }
