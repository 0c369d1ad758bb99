"""Registered queries over ``pages``, ``customer``/``nation``/``region`` texts,
``part``-derived API documents and wire-message texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import normalise as N
from ..functions.dom import first, has_class, select_rows
from ..functions.html import host_allowed, join_stripped, resolve_url, url_host
from ..functions.text import (digits_only, first_integer, price_digits, price_digits_dotted,
                              py_strip, rooms_from_text, split_location, surface_from_text,
                              wc_from_text)
from ..operators.clean import clean_listings
from ..operators.dedup import first_per_crawl
from ..operators.extract import image_merge, join_card_detail
from ..session import read_table
from ..sources.adapters import customer_location_texts, customer_price_texts
from ..sources.api import api_documents_from_part, flatten_api
from ..sources.pages import ajax_cards, ajax_envelopes_from_pages, link_cards
from ..sources.wire import lenient_schema, parse_wire, to_wire
from . import common

# The host allow-list used by the pages query.
ALLOWED_DOMAINS = ["example.com", "example.org"]


def _pages(spark, sf_dir) -> DataFrame:
    return common.spread(read_table(spark, sf_dir, "pages"), spark)


def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_cards(_pages(spark, sf_dir)).select("page_id", "pos", "listing_url", "listing_id", "title")


def _first_link(root, url):
    link = first(a.attrs["href"] for h in root.find("h4") for a in h.children("a") if "href" in a.attrs)
    yield (link or first(a.attrs["href"] for a in root.find("a") if "href" in a.attrs),)


def page_listing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 with its fallback: the first ``h4 > a`` link, else the first link."""
    links = select_rows(_pages(spark, sf_dir), _first_link, "href string")
    return (links.select("page_id", resolve_url("url", "href").alias("listing_url"))
            .where(F.col("listing_url").isNotNull())
            .withColumn("listing_id", F.md5("listing_url")))


def page_host_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).select("page_id", "url")
    return (pages.where(host_allowed(F.col("url"), ALLOWED_DOMAINS))
            .select("page_id", "url", F.lower(url_host(F.col("url"))).alias("host")))


def _headings(root, url):
    yield first(t for e in root.find("h1") for t in e.texts()), first(t for e in root.find("title") for t in e.texts())


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page heading, else the document title (both stripped, decoded)."""
    heads = select_rows(_pages(spark, sf_dir), _headings, "h1 string, doc_title string")
    return heads.select("page_id", F.coalesce(F.nullif(py_strip("h1"), F.lit("")), py_strip("doc_title"), F.lit("")).alias("title"))


def _ad_texts(root):
    ad = first(root.find("div", has_class("ad")))
    return [] if ad is None else ad.all_texts()


def page_ad_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text node of the ``ad`` block joined by a space, stripped."""
    ads = select_rows(_pages(spark, sf_dir), lambda root, url: [(_ad_texts(root),)], "texts array<string>")
    return ads.select("page_id", py_strip(F.array_join("texts", " ")).alias("ad_text"))


def _card_and_detail(root, url):
    article = first(root.find("article"))
    yield (first(t for e in root.find("h1") for t in e.texts()), _ad_texts(root),
           [] if article is None else [t for p in article.find("p") for t in p.texts()],
           [] if article is None else article.all_texts())


def page_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + E18 + E23: card (heading, ad block) joined to detail (article) by URL."""
    found = select_rows(_pages(spark, sf_dir), _card_and_detail, "h1 string, ad array<string>, paras array<string>, body array<string>")
    canon = F.regexp_extract("url", r"^([^#]*)", 1)
    cards = found.select(
        "page_id", F.lit(0).alias("pos"), canon.alias("listing_url"), F.coalesce(py_strip("h1"), F.lit("")).alias("title"),
        first_integer(F.array_join("ad", " ")).alias("square_footage"))
    details = found.select(
        "page_id", canon.alias("listing_url"), join_stripped("paras").alias("description"),
        first_integer(F.array_join("body", " ")).alias("detail_surface"))
    return join_card_detail(cards, details).select(
        "listing_url", "title", "description", "square_footage")


def price_digits_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = customer_price_texts(common.spread(read_table(spark, sf_dir, "customer"), spark))
    return t.select("c_custkey", "price_text", price_digits("price_text").alias("price_digits"))


def price_digits_dotted_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = customer_price_texts(common.spread(read_table(spark, sf_dir, "customer"), spark))
    return t.select("c_custkey", "price_text", price_digits_dotted("price_text").alias("price_digits"))


def location_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = customer_location_texts(read_table(spark, sf_dir, "customer"),
                                read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))
    loc = py_strip("location_text")
    hood, city = split_location(loc)
    return t.select("c_custkey", "location_text", hood.alias("neighborhood"), city.alias("city"))


def _texts(spark, sf_dir, *fields) -> DataFrame:
    """Messages with an id, only the named fields parsed."""
    return common.parsed(spark, sf_dir, fields=["listing_id", *fields]).where(F.col("listing_id").isNotNull())


def type_from_title_a(spark, sf_dir):
    return _texts(spark, sf_dir, "title").select("msg_id", py_strip("title").alias("title"),
                                        N.type_from_title_a(py_strip("title")).alias("property_type"))


def type_from_title_b(spark, sf_dir):
    return _texts(spark, sf_dir, "title").select("msg_id", py_strip("title").alias("title"),
                                        N.type_from_title_b(py_strip("title")).alias("property_type"))


def type_from_title_c(spark, sf_dir):
    return _texts(spark, sf_dir, "title", "description").select(
        "msg_id", py_strip("title").alias("title"),
        N.type_from_title_c(py_strip("title"), F.col("description")).alias("property_type"))


def offer_from_text_a(spark, sf_dir):
    return _texts(spark, sf_dir, "offer_type").select("msg_id", F.col("offer_type").alias("badge"),
                                        N.offer_from_badge_a("offer_type").alias("offer_type"))


def offer_from_text_b(spark, sf_dir):
    return _texts(spark, sf_dir, "title").select("msg_id", py_strip("title").alias("title"),
                                        N.offer_from_title_b(py_strip("title")).alias("offer_type"))


def offer_from_text_c(spark, sf_dir):
    return _texts(spark, sf_dir, "offer_type").select("msg_id", F.col("offer_type").alias("badge"),
                                        N.offer_from_badge_c("offer_type").alias("offer_type"))


def first_integer_q(spark, sf_dir):
    return _texts(spark, sf_dir, "description", "bedrooms").select(
        "msg_id", first_integer("description").alias("first_int"),
        digits_only("bedrooms").alias("bedrooms_digits"))


def pattern_priority(spark, sf_dir):
    low = F.lower("description")
    return _texts(spark, sf_dir, "description").select("msg_id", surface_from_text(low).alias("surface"),
                                        rooms_from_text(low).alias("rooms"))


def wc_count(spark, sf_dir):
    return _texts(spark, sf_dir, "description").select("msg_id", wc_from_text(F.lower("description")).alias("wc"))


def legal_doc_first_q(spark, sf_dir):
    return _texts(spark, sf_dir, "description").select("msg_id", N.legal_doc_first("description").alias("legal_doc"))


def legal_docs_all_q(spark, sf_dir):
    return _texts(spark, sf_dir, "description").select("msg_id", N.legal_docs_all("description").alias("legal_doc"))


def image_union(spark, sf_dir):
    """E21 + U2: card image (one per listing) merged with the gallery."""
    t = _texts(spark, sf_dir, "listing_url", "image_urls")
    card = F.array(F.concat(F.regexp_replace("listing_url", "/annonce/", "/img/"), F.lit(".jpg")))
    merged = image_merge(card, F.col("image_urls"))
    return t.select("msg_id", merged.cast("string").alias("image_urls"))


def _api(spark, sf_dir) -> DataFrame:
    part = common.spread(read_table(spark, sf_dir, "part"), spark)
    return flatten_api(api_documents_from_part(part))


def api_flatten(spark, sf_dir):
    a = _api(spark, sf_dir)
    return a.select("listing_id", "title", "description", "price", "bedrooms", "square_footage",
                    "wc_interne", "legal_doc", "property_type", "offer_type", "address", "city",
                    "neighborhood", "listing_url", F.col("image_urls").cast("string").alias("image_urls"),
                    "source")


def ajax_cards_q(spark, sf_dir):
    env = ajax_envelopes_from_pages(_pages(spark, sf_dir))
    return ajax_cards(env).select("page_id", "pos", "listing_url", "listing_id", "title")


def source_union(spark, sf_dir):
    """The wire messages and the API listings in one stream (by name,
    missing fields NULL), cleaned together, counted per source."""
    wire = common.parsed(spark, sf_dir).drop("msg_id")
    api = _api(spark, sf_dir).withColumn("bedrooms", F.col("bedrooms").cast("string"))
    both = wire.unionByName(api, allowMissingColumns=True)
    cleaned = clean_listings(both)
    return cleaned.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.sum("price").alias("sum_price"))


def first_per_crawl_q(spark, sf_dir):
    """A5: one card per URL per crawl (crawl = the site host), first seen wins."""
    cards = link_cards(_pages(spark, sf_dir)).withColumn("crawl", F.lower(url_host(F.col("url"))))
    first = first_per_crawl(cards.select("crawl", "listing_url", "page_id", "pos", "title"), "crawl")
    return first.select("crawl", "listing_url", "page_id", "pos", "title")


CRAWLED_AT = "1970-01-01T00:00:00"


def _site_items(spark, sf_dir, site, by_ajax=False):
    """Site rules E1-E26 + J1 + A5 over pages rendered from ``orders``. ``by_ajax``: every
    second list page arrives in a 'load more' response (S7)."""
    from ..operators.sites import extract_site
    from ..sources import site_pages
    orders = common.spread(read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice"), spark)
    lists, details = getattr(site_pages, f"{site}_pages")(orders)
    ajax = None
    if by_ajax:
        ajax = lists.where("page_id % 2 = 1").select("page_id", "url", F.to_json(F.struct("html", F.lit("more").alias("loadmore"))).alias("response"))
        lists = lists.where("page_id % 2 = 0")
    return extract_site(site, lists, details, F.lit(CRAWLED_AT), ajax=ajax)


def _site_extract(spark, sf_dir, site, by_ajax=False):
    return _site_items(spark, sf_dir, site, by_ajax).select("listing_url", "listing_id", "title", "price", "address", "neighborhood", "city",
                        "property_type", "offer_type", "bedrooms", "wc_interne", "square_footage",
                        "description", "legal_doc", F.col("image_urls").cast("string").alias("image_urls"),
                        "source")


def site_items_to_lake(spark, sf_dir):
    """A site's items with their crawl instant, as wire messages, cleaned like any others."""
    items = to_wire(_site_items(spark, sf_dir, "igoe"))
    kept = clean_listings(parse_wire(items, schema=lenient_schema()), mode="lenient")
    return kept.select("listing_url", "scraped_at", "source", "price")


def site_intendance_ajax(spark, sf_dir):
    return _site_extract(spark, sf_dir, "intendance", by_ajax=True)


def site_intendance_extract(spark, sf_dir):
    return _site_extract(spark, sf_dir, "intendance")


def site_coinafrique_extract(spark, sf_dir):
    return _site_extract(spark, sf_dir, "coinafrique")


def site_igoe_extract(spark, sf_dir):
    return _site_extract(spark, sf_dir, "igoe")
