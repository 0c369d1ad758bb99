"""The query registry used by ``__spark_entry__`` and ``bench.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import listing_queries as lq
from . import page_queries as pq
from . import stream_queries as sq
from .sink_queries import SINK_QUERIES
from .store_queries import STORE_QUERIES, store_oracles
from .wave_queries import WAVE_QUERIES
from .oracle import listing_oracles, with_listings
from .oracle_pages import page_oracles, site_oracles
from .oracle_waves import wave_oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "flagship_market_summary": lq.flagship_market_summary,
        "wire_parse_permissive": lq.wire_parse_permissive,
        "events_props_parse": lq.events_props_parse,
        "property_type_normalise": lq.property_type_normalise,
        "offer_type_normalise": lq.offer_type_normalise,
        "typed_casts_legacy": lq.typed_casts_legacy,
        "price_lenient": lq.price_lenient,
        "clean_listings": lq.clean_listings_q,
        "reject_reasons": lq.reject_reasons,
        "digits_only_cleanup": lq.digits_only_cleanup_q,
        "bedroom_outliers": lq.bedroom_outliers_q,
        "dedup_latest_per_url": lq.dedup_latest_per_url,
        "count_listings": lq.count_listings_q,
        "distinct_sources": lq.distinct_sources_q,
        "image_urls_text": lq.image_urls_text,
        "curated_marts": lq.curated_marts,
        "price_per_m2": lq.price_per_m2_q,
        "price_quantiles_approx": lq.price_quantiles_q,
        "upsert_insert_if_absent": lq.upsert_insert_if_absent,
        "page_cards": pq.page_cards,
        "page_listing_keys": pq.page_listing_keys,
        "page_host_allowlist": pq.page_host_allowlist,
        "page_title": pq.page_title,
        "page_ad_text": pq.page_ad_text,
        "page_detail_join": pq.page_detail_join,
        "price_digits": pq.price_digits_q,
        "price_digits_dotted": pq.price_digits_dotted_q,
        "location_split": pq.location_split_q,
        "type_from_title_a": pq.type_from_title_a,
        "type_from_title_b": pq.type_from_title_b,
        "type_from_title_c": pq.type_from_title_c,
        "offer_from_text_a": pq.offer_from_text_a,
        "offer_from_text_b": pq.offer_from_text_b,
        "offer_from_text_c": pq.offer_from_text_c,
        "first_integer": pq.first_integer_q,
        "pattern_priority": pq.pattern_priority,
        "wc_count": pq.wc_count,
        "legal_doc_first": pq.legal_doc_first_q,
        "legal_docs_all": pq.legal_docs_all_q,
        "image_union": pq.image_union,
        "api_flatten": pq.api_flatten,
        "ajax_cards": pq.ajax_cards_q,
        "source_union": pq.source_union,
        "first_per_crawl": pq.first_per_crawl_q,
        "site_intendance_extract": pq.site_intendance_extract,
        "site_intendance_ajax": pq.site_intendance_ajax,
        "site_coinafrique_extract": pq.site_coinafrique_extract,
        "site_igoe_extract": pq.site_igoe_extract,
        "site_items_to_lake": pq.site_items_to_lake,
        "stream_to_lake": sq.stream_to_lake,
        "stream_batch_dedup": sq.stream_batch_dedup,
        "stream_watermark_dedup": sq.stream_watermark_dedup,
        "price_quartiles_exact": lq.price_quartiles_exact,
        **SINK_QUERIES,
        **WAVE_QUERIES,
        **STORE_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    out = {}
    out.update(listing_oracles())
    out.update(page_oracles())
    out.update(site_oracles())
    out.update(wave_oracles())
    out.update(store_oracles(with_listings, out["stream_to_lake"]))
    return out
